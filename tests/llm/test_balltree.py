"""Exact top-k: equals brute force, whatever is pruned."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowcast.llm import balltree

DDL = "vec_id long, embedding array<float>, row long, v string, dim int, shard int, block int, score double"


def brute(rows, k=10):
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (i, q) in enumerate(ok):
        if i is None or i % 100:
            continue
        got = [(max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(q, v)))), j) for m, (j, v) in enumerate(ok)
               if m != n and len(v) == len(q)]
        got.sort(key=lambda t: (-t[0], t[1] is None, t[1] or 0))
        out += [(i, r, j, s) for r, (s, j) in enumerate(got[:k], 1)]
    return sorted(out, key=str)


def check(spark, rows, k=10):
    df = spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, 0.5) for i, v in rows], DDL)
    got = balltree.nearest(df.repartition(3), F.col("vec_id") % 100 == 0, k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute([(i, None if v is None else [
        None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], k)


def clusters(n, dim, seed, spread=0.05):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, dim))
    return (centres[rnd.integers(0, 12, n)] + spread * rnd.normal(size=(n, dim))).astype(np.float32)


def test_rounds_of_shards_and_blocks(spark, monkeypatch):
    """Many shards, rounds and query blocks; ids with ties and negatives."""
    monkeypatch.setattr(balltree, "SHARD_VALUES", 8 * 50)
    monkeypatch.setattr(balltree, "BLOCK_VALUES", 8 * 4)
    v = clusters(900, 8, 1)
    check(spark, [(int(i * 20 - 600), x.tolist()) for i, x in enumerate(v)])


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [2.0, 1.0]), (3, None), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 2.0]), (200, [3.0]), (7, [4.0]), (300, []), (8, []), (400, [0.5, 0.5, 0.5]),
            (500, [-1.0, 2.5]), (600, None)]
    check(spark, rows)
    check(spark, rows, k=2)


def test_large_components(spark):
    check(spark, [(100 * i, [float(2.0 ** (20 + i)), 3.0, -float(2.0 ** (30 - i))]) for i in range(25)])


def test_empty(spark):
    assert balltree.nearest(spark.createDataFrame([], DDL), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("copies", [0, 2000])
def test_search_prunes_and_is_exact(copies):
    """One shard: same result as all products; clustered points open few leaves,
    and copies of one point don't pile up."""
    x = np.floor(1024 * clusters(3000, 16, 3, 0.01).astype(float)).astype(np.int64)
    x[:copies] = x[0]
    ids = np.arange(3000)[::-1].copy()
    q, own = x[::100], np.arange(0, 3000, 100)
    low, last = np.full(30, -(1 << 63)), np.full(30, (1 << 63) - 1)
    who, score, got_ids, point = balltree.search(x, ids, np.arange(3000), q, own, low, last, 10)
    for n in range(30):
        s = x @ q[n]
        s = s[np.arange(3000) != own[n]]
        want = sorted(zip(-s, np.delete(ids, own[n])))[:10]
        assert sorted(zip(-score[who == n], got_ids[who == n])) == want
    tree = balltree.BallTree(x.astype(float))
    kth = np.array([score[who == n].min() for n in range(30)], float)
    opened = np.isfinite(tree.open_leaves(q.astype(float), np.linalg.norm(q, axis=1), kth)).mean()
    assert opened < 0.5 or copies
    # the k-th scores of earlier rounds leave only what beats them
    again = balltree.search(x, ids, np.arange(3000), q, own, score[np.r_[9:300:10]], got_ids[np.r_[9:300:10]], 10)
    assert len(again[0]) == 270
