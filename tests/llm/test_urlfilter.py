"""URL filter: exact cascades over their universe, rules and edge cases."""

import random

from pyspark.sql import functions as F

from rowcast.llm import urlfilter as U

CASES = [
    (0, "http://a.com/x?y#z", "a.com", "/x", "com/", "allow"),
    (1, "https://WWW.Example.COM/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    (2, "https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    (3, "https://m.example.com/EN/", "m.example.com", "/EN/", "com/", "allow"),
    (4, "ftp://a.b.net/fr/1", "a.b.net", "/fr/1", "net/fr/", "block"),
    (5, "ftp://a.b.net/es", "a.b.net", "/es", None, "allow"),
    (6, "http://com", "com", "", None, "allow"),
    (7, "http://notexample.com/en/x", "notexample.com", "/en/x", "com/", "allow"),
    (8, "no scheme", "", "", None, "allow"),
    (9, None, "", "", None, "allow"),
    (10, "http://a.org?u=http://b.net/es/", "a.org", "", None, "allow"),
    (11, "http://www.spam-farm.example.org/en/1", "www.spam-farm.example.org", "/en/1", None, "block"),
    (12, "http://x.www.example.com/en/#f", "x.www.example.com", "/en/", "www.example.com/en/", "allow"),
    (13, "://a.net/es/x\ny", "a.net", "/es/x\ny", "net/es/", "block"),
    (13, "://a.net/es/x\ny", "a.net", "/es/x\ny", "net/es/", "block"),
    (None, "", "", "", None, "allow"),
]


def test_rules_and_edges(spark):
    rows = [(i, u, "h", "r", "k", 1) for i, u, *_ in CASES] + [(50, "http://q.org/" + "p" * 200_000, "h", "r", "k", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, rule string, key0 string, best int")
    got = sorted((tuple(r) for r in U.judge(df).collect()), key=str)
    want = [(i, h, p, r, v) for i, _, h, p, r, v in CASES] + [(50, "q.org", "/" + "p" * 200_000, None, "allow")]
    assert got == sorted(want, key=str)
    assert U.judge(df.limit(0)).count() == 0


def test_cascade_is_exact_on_its_universe(spark, monkeypatch):
    monkeypatch.setattr(U, "BITS_PER_KEY", 3)  # many false positives, so several levels
    monkeypatch.setattr(U, "MAX_BITS", 1024)  # and several segments
    rnd = random.Random(3)
    rows = [(f"key{i}", rnd.random() < 0.3) for i in range(3000)]
    universe = spark.createDataFrame(rows, "key string, listed boolean")
    cascade = U.Cascade.build(universe)
    assert len(cascade.levels) >= 3 and cascade.levels[0][2] > 1
    wrong = universe.select("listed", cascade.contains(F.col("key")).alias("c")).where("listed <> c").count()
    assert wrong == 0
    assert U.Cascade.build(universe.where("not listed")).levels == []


def test_a_level_of_many_keys(spark):
    """A million keys: the build is linear in them."""
    import time

    universe = spark.range(1_200_000).select(F.concat(F.lit("key"), F.col("id").cast("string")).alias("key"), (F.col("id") % 6 > 0).alias("listed"))
    began = time.time()
    frame, bits, segments = U.Cascade._level(universe.where("listed").select("key"), 0)
    assert time.time() - began < 120
    level = U.Cascade([(frame, bits, segments)])
    held = universe.select("listed", level.has(F.col("key"), 0).alias("held")).groupBy("listed").agg(F.avg(F.col("held").cast("int")).alias("x"))
    got = {r.listed: r.x for r in held.collect()}
    assert got[True] == 1.0 and got[False] < 0.02
