"""Near-duplicates against brute force, also with every branch of the recursion."""

import random
import re
from collections import defaultdict

import pytest

from llm_tables import SF_SMALL, make_docs  # noqa: F401
from rowcast.llm import neardup
from rowcast.llm.common import table
from rowcast.llm.components import components


def brute(docs):
    """{doc_id: (n, component, kept)} by comparing every pair."""
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}


def near_copies(seed, centres=3, copies=40, length=80):
    """Copies around centres, a chain, texts that share a passage, and others."""
    rnd, rows = random.Random(seed), []
    word = lambda: f"w{rnd.randrange(5000)}"
    passage = [word() for _ in range(60)]
    for _ in range(centres):
        base = [word() for _ in range(length)]
        for _ in range(copies):
            t = list(base)
            for _ in range(rnd.randrange(4)):
                t[rnd.randrange(len(t))] = word()
            rows.append(" ".join(t))
    chain = [word() for _ in range(100)]
    for _ in range(12):
        rows.append(" ".join(chain))
        chain[rnd.randrange(100)] = word()
        chain = chain[4:] + [word() for _ in range(4)]
    for _ in range(40):
        rows.append(" ".join(passage + [word() for _ in range(rnd.randrange(10, 90))]))
    rnd.shuffle(rows)
    return list(enumerate(rows))


def test_given_table(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("leaf,depth", [(512, 5), (6, 2)])
def test_planted_groups(make_docs, monkeypatch, leaf, depth):
    monkeypatch.setattr(neardup, "LEAF", leaf)
    monkeypatch.setattr(neardup, "DEPTH", depth)
    rows = near_copies(leaf)
    assert got(make_docs(rows)) == brute(rows)


def test_edges(spark, make_docs):
    long = " ".join(f"x{i % 9973}" for i in range(60_000))
    rows = [(5, "A b"), (3, "a  B\n"), (9, "a"), (8, ""), (7, None), (6, " \t\n"), (12, long), (11, long.upper() + " end"),
            (20, "one two three four five six"), (20, "one two three four five six"), (None, "a b"), (None, "lone words here"),
            (21, "one two three four five seven")]
    out = neardup.near_duplicates(make_docs(rows))
    have = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out.collect()]
    by = {r[0]: r[1:] for r in have if r[0] is not None}
    assert len(have) == 13 and by[5] == (1, 3, False) and by[3] == (1, 3, True) and by[9] == (1, 9, True)
    assert by[8] == (0, 8, True) and by[7] == (0, 7, True) and by[6] == (0, 6, True)
    assert by[12][1:] == (11, False) and by[11][1:] == (11, True) and by[20] == (2, 20, True) and by[21] == (2, 21, True)
    assert sorted((r[1:] for r in have if r[0] is None), key=str) == [(1, 3, False), (1, None, True)]
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert got(make_docs(rows).limit(0)) == {}
    kept = neardup.keep_first(make_docs([r for r in rows if r[0] is not None]))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6, 7, 8, 9, 11, 20, 20, 21] and "label" in kept.columns


def test_components(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(250)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, 2000)]
    up = defaultdict(lambda: None)

    def find(i):
        while up[i] is not None and up[i] != i:
            i = up[i]
        return i
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        if a != b:
            up[b] = a
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert {r.v: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()} == want
