"""Exact dedup: filter, index life cycle, brute force and edge cases."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_tables import make_docs  # noqa: F401
from rowcast.llm import exactdedup as X


def test_filter_inserts_deletes_and_overflows():
    rnd = random.Random(0)
    keys = [rnd.randbytes(32) for _ in range(2000)]
    f = X.CuckooFilter(1024)
    assert all(f.insert(k) for k in keys) and all(f.contains(k) for k in keys)
    for k in keys[:1000]:
        f.delete(k)
    assert all(f.contains(k) for k in keys[1000:])
    assert sum(f.contains(k) for k in keys[:1000]) < 20
    small = X.CuckooFilter(16)
    assert not all(small.insert(k) for k in keys)


def test_bucket_resizes_and_verifies():
    rnd = random.Random(1)
    b = X.Bucket()
    start, keys = b.filter.capacity, [rnd.randbytes(32) for _ in range(3000)]
    # the same fingerprint and place as keys[0], but another digest
    keys.append(keys[0][:8] + rnd.randbytes(24))
    for i, k in enumerate(keys):
        b.insert(k, i, i, 1)
    b.insert(keys[5], 2, 2, 4)
    assert b.filter.capacity > start and len(b.keys) == 3001 and b.lookup(keys[5]) == [2, 2, 5]
    assert b.lookup(keys[-1]) == [3000, 3000, 1] and b.lookup(keys[0]) == [0, 0, 1]
    b.delete(keys[0])
    assert b.lookup(keys[0]) is None and b.lookup(keys[-1]) is not None and b.lookup(rnd.randbytes(32)) is None


def test_index_in_batches(spark):
    def batch(ids):
        return spark.createDataFrame([(hashlib.sha256(str(i % 50).encode()).digest(), i, i) for i in ids],
                                     "digest binary, doc_id long, row long")
    index = X.CuckooIndex(X.CuckooIndex.sized(spark, 10).state, 3)
    index = index.insert(X.partials(batch(range(100, 200)))).insert(X.partials(batch(range(60, 130))))
    got = {bytes(r.digest): (r.keep_id, r.group_size) for r in index.entries().collect()}
    assert len(got) == 50 and got[hashlib.sha256(b"10").digest()] == (60, 4)
    index = index.delete(batch([10, 11, 999]))
    assert index.entries().count() == 47
    assert index.lookup(batch([10, 12, 12])).select("keep_id").collect()[0].keep_id == 62
    assert index.lookup(batch([10])).count() == 0


def test_the_index_finds_the_copies(make_docs, monkeypatch):
    """Copies from different pieces reach the bucket: all but the first are hits."""
    monkeypatch.setattr(X, "HELD", 1)
    docs = make_docs([(i, f"text {i % 40}") for i in range(2000)]).repartition(8)
    rows = docs.select("doc_id", X.digest(F.col("text")).alias("digest")).withColumn("row", F.monotonically_increasing_id())
    index = X.indexed(X.written(rows, "test-digests"))
    state = index.state.agg(*[F.sum(c).alias(c) for c in X.COUNTERS]).first()
    pieces = X.partials(rows).count()
    assert pieces > 40 and state.hits == pieces - 40
    assert {(r.keep_id, r.group_size) for r in index.entries().collect()} == {(i, 50) for i in range(40)}


def test_the_result_comes_through_the_index(make_docs, monkeypatch):
    """An index that calls every key new finds no copies, and the result says so."""
    docs = make_docs([(i, f"text {i % 3}") for i in range(30)])
    assert {r.group_size for r in X.duplicates(docs).collect()} == {10}
    monkeypatch.setattr(X.CuckooIndex, "insert", lambda self, batch: X.CuckooIndex(
        X.CuckooIndex.sized(docs.sparkSession, 1).state, 1))
    assert X.duplicates(docs).count() == 0


def test_against_brute_force(make_docs):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a b", "a  b", "a\tb", " a b", "", None, " ", "\n", "x" * 100_000, f"u{rnd.randrange(30)}"]))
            for i in range(300)] + [(7, "a b"), (7, "a b"), (None, "only null"), (None, "only null"), (None, "a b")]
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    got = X.duplicates(make_docs(rows)).select("*", F.lower(F.hex("digest")).alias("sha")).collect()
    assert len(got) == len(rows)
    for text, ids in groups.items():
        own = [r for r in got if r.sha == hashlib.sha256(text.encode()).hexdigest()]
        least = min((i for i in ids if i is not None), default=None)
        assert len(own) == len(ids) and {(r.keep_id, r.group_size) for r in own} == {(least, len(ids))}
        assert sum(r.kept for r in own) == 1 and [r.doc_id for r in own if r.kept] == [least]
    kept = X.keep_first(make_docs(rows))
    assert kept.columns == make_docs(rows).columns and kept.count() == len(groups)
    assert X.duplicates(make_docs(rows).limit(0)).count() == 0 and X.keep_first(make_docs(rows).limit(0)).count() == 0
