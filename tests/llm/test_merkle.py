"""Merkle manifest: every proof against a tree built in plain Python."""

import hashlib
import random
import zlib

import pytest

from rowcast.llm import merkle

DDL = "doc_id long, source string, lang string, n_chars long, text string, id string, up string, tree string, path int"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(r):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))


def climb(levels, i):
    """Siblings (left to right, upwards) of node i of levels[0]."""
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else "", j < i))
        i //= 2
    return out


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h("".join(x[i:i + 2])) for i in range(0, len(x), 2)])
    return levels


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        own[lang] = (mine, tree([leaf(r) for r in mine]))
    top = tree([own[x][1][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        mine, levels = own[lang]
        for i, r in enumerate(mine):
            sibs = climb(levels, i) + climb(top, k)
            bad = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf((*r[:3], r[3] + 1, r[4])) if bad else leaf(r)
            for s, before in sibs:
                at = h(s + at if before else at + s)
            root = top[-1][0]
            out.append((r[0], leaf(r), levels[-1][0], root, h("".join(s for s, _ in sibs)), at, at == root))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", "y", "z", 1) for r in rows], DDL)
    got = merkle.proofs(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute(rows)))


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(i, "s", "en", i * 3, f"text {i} é") for i in range(300)]
    rows += [(None, None, None, None, None), (None, "s", None, 5, ""), (7, "s", "en", 21, "text 7 é"), (8, None, "de", None, "x"),
             (9, "s", "fr", 2, "y" * 200_000), (9, "s", "fr", 2, "z"), (1001, "s", "", 1, "empty lang"), (14, "s", "é", 1, "last")]
    check(spark, rows)


@pytest.mark.parametrize("sizes", [(1,), (2,), (5, 1, 16), (17, 64, 3, 1, 9, 2, 4)])
def test_deep_trees(spark, monkeypatch, sizes):
    """Links of two levels and copies of nodes for every eight leaves."""
    monkeypatch.setattr(merkle, "SPAN", 2)
    monkeypatch.setattr(merkle, "WIDTH", 4)
    monkeypatch.setattr(merkle, "SHARE", 8)
    rnd = random.Random(sum(sizes))
    check(spark, [(rnd.randrange(10 ** 6), "s", f"l{k}", rnd.randrange(99), "t") for k, n in enumerate(sizes) for _ in range(n)])


def test_empty_table(spark):
    assert merkle.proofs(spark.createDataFrame([], DDL)).collect() == []


def test_row_limit_of_the_session_is_put_back(spark):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "77")
    try:
        check(spark, [(i, "s", "en", 1, "t") for i in range(200)])
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "77"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
