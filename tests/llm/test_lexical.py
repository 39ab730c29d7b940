"""Ranked search: equals a plain count of terms."""

import math
import re
from collections import Counter

import pytest
from llm_tables import make_docs  # noqa: F401

from rowcast.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, row long, block int, rank int"


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    own = [(i, Counter(terms(t))) for i, t in docs]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total = len(own), sum(x[2] for x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item_id, text in items:
        got = []
        for i, c, size in own:
            m = 25 + (75 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                got.append((-s, i is None, i or 0, i))
        got.sort()
        out += [(item_id, r, i, -s) for r, (s, _, _, i) in enumerate(got[:k], 1)]
    return sorted(out, key=str)


def check(spark, make_docs, docs, items, k=10):
    bench = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in items], ITEMS)
    got = lexical.search(make_docs(docs).repartition(3), bench, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


DOCS = [(1, "The cat sat on the mat"), (2, "cat cat CAT"), (3, None), (4, ""), (5, "... --- \n"), (6, "concatenate the category"),
        (7, "naïve Été été ÉTÉ"), (None, "cat cat CAT"), (8, "cat cat CAT"), (8, "cat cat CAT"), (9, "x" * 70_000 + " mat"),
        (10, "mat,mat;mat\tmat\x00mat mat_mat"), (11, "日本語 の cat"), (12, "cat "), (13, " cat"), (14, "a1b2 3 cat's K")]
ITEMS_ = [(0, "cat"), (0, "cat"), (1, "the CAT the mat"), (2, None), (3, ""), (4, "?!"), (None, "été cat"), (5, "日本語"),
          (6, "unseen words"), (7, "category"), (8, "s 3 mat mat mat k")]


def test_defined_cases(spark, make_docs):
    check(spark, make_docs, DOCS, ITEMS_)
    check(spark, make_docs, DOCS, ITEMS_, k=2)


def test_blocks_of_items(spark, make_docs, monkeypatch):
    """A benchmark beyond one automaton gives the same rows."""
    monkeypatch.setattr(lexical, "MAX_BYTES", 12)
    check(spark, make_docs, DOCS, ITEMS_)


def test_many_batches(spark, make_docs):
    words = [f"w{i}" for i in range(40)]
    docs = [(i * 7 % 1300, " ".join(words[(i * j) % 40] for j in range(1, 2 + i % 23))) for i in range(1300)]
    check(spark, make_docs, docs, [(k, " ".join(words[k::5] + words[:3])) for k in range(5)])


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], ITEMS)
    assert lexical.search(make_docs(DOCS), none).collect() == []
    assert lexical.search(make_docs([]).limit(0), spark.createDataFrame([(1, "cat", 1, 1, 1)], ITEMS)).collect() == []


@pytest.mark.parametrize("plain", [True, False])
def test_both_sums_agree(plain):
    """Sums in doubles and in 64-bit integers."""
    import numpy as np
    import pyarrow as pa

    a = lexical.Automaton([["a", "b", "a"], ["b", "c"], ["d"]])
    s = lexical.Scorer(a, np.array([3, 2, 1, 1]), 9, 100)
    s.plain = plain
    text, item, score = s.scores(*a.counted(pa.array(["a b b c", None, "z", "d a"])))
    assert sorted(zip(text.tolist(), item.tolist())) == [(0, 0), (0, 1), (3, 0), (3, 2)]
    assert (score > 0).all() and len(set(score.tolist())) == 4
