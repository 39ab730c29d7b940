"""Dedupe, per-key order, latency, enrichment and the file fan-out sink."""

import glob
import json

from conftest import row
from pyspark.sql import functions as F

from rowcast.operators.codec import encode
from rowcast.operators.delivery import dedupe, enrich_rows, latency_by_topic, order_for_delivery, sequence_in_key
from rowcast.operators.envelope import build_events
from rowcast.sinks.fanout import write_topics

U = "u"


def test_dedupe_collapses_hot_copies(spark):
    recs = spark.createDataFrame([(U, 1, 0, "a")] * 500 + [(U, 2, 0, "b"), (U, 2, 0, "b"), (U, 3, 0, "c")],
                                 "gtid_uuid string, gtid_seq bigint, pos bigint, value string")
    got = {r.gtid_seq: r.copies for r in dedupe(recs, copies="copies").collect()}
    assert got == {1: 500, 2: 2, 3: 1}


def test_sequence_in_key_with_hot_key(spark):
    rows = [("t", "hot", s, 0) for s in range(1, 300)] + [("t", "k2", s, 0) for s in (5, 2, 9)]
    recs = spark.createDataFrame(rows, "topic string, key string, gtid_seq bigint, pos bigint")
    got = {(r.key, r.gtid_seq): r.seq_in_key for r in sequence_in_key(recs, width=16).collect()}
    assert got[("hot", 1)] == 1 and got[("hot", 299)] == 299
    assert (got[("k2", 2)], got[("k2", 5)], got[("k2", 9)]) == (1, 2, 3)


def test_order_for_delivery_is_sorted_per_partition(spark):
    recs = spark.createDataFrame([("t", "k", s, 0) for s in range(200, 0, -1)],
                                 "topic string, key string, gtid_seq bigint, pos bigint")
    parts = order_for_delivery(recs, partitions=4).rdd.glom().collect()
    flat = [r.gtid_seq for p in parts for r in p]
    assert flat == sorted(flat)


def test_latency(spark):
    recs = spark.createDataFrame([("a", json.dumps({"meta": {"timestamp": t}})) for t in (10, 20, 30)],
                                 "topic string, value string")
    r = latency_by_topic(recs, F.lit(100)).collect()[0]
    assert (r.n, r.min_latency_us, r.max_latency_us, r.avg_latency_us, r.sum_latency_us) == (3, 70, 90, 80, 240)


def test_enrich_rows_multi_row_and_null_images(make_log, spark):
    log = make_log([
        ("s", "t", "insert", [row(1, "a", user_id=1), row(2, "b", user_id=2), row(3, "c", user_id=9)], [], U, 1, 0),
        ("s", "t", "delete", [row(4, "d", user_id=1)], [], U, 2, 0),
    ])
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "id bigint, name string")
    out = {r.gtid_seq: r for r in enrich_rows(ev, "after", dim, on=("user_id", "id"), fields=["name"]).collect()}
    assert [x.name for x in out[1].after] == ["one", "two", None]
    assert [x.event_id for x in out[1].after] == [1, 2, 3]
    assert out[2].after is None and out[2].before[0].text_col == "d"


def test_enrich_keeps_every_match_and_every_event(make_log, spark):
    log = make_log([("s", "t", "insert", [row(1, "a", user_id=1), row(2, "b", user_id=2)], [], U, 1, 0)])
    ev = build_events(log, pipeline="p", timestamp=F.lit(0)).unionByName(build_events(log, pipeline="q", timestamp=F.lit(0)))
    dim = spark.createDataFrame([(1, "one"), (1, "uno"), (2, "two")], "id bigint, name string")
    got = {r.meta.pipeline: sorted(x.name for x in r.after)
           for r in enrich_rows(ev.unionByName(ev), "after", dim, on=("user_id", "id"), fields=["name"]).collect()}
    assert got == {"p": ["one", "two", "uno"], "q": ["one", "two", "uno"]}
    assert enrich_rows(ev.unionByName(ev), "after", dim, on=("user_id", "id"), fields=["name"]).count() == 4


def test_dedupe_keeps_pipelines_and_records_without_position(spark):
    rows = [(p, U, 1, 0, "v") for p in ("a", "b", "a")] + [("a", None, None, 0, "x"), ("a", None, None, 0, "y")]
    recs = spark.createDataFrame(rows, "pipeline string, gtid_uuid string, gtid_seq bigint, pos bigint, value string")
    got = sorted((r.pipeline, r.value, r.copies) for r in dedupe(recs, copies="copies").collect())
    assert got == [("a", "v", 2), ("a", "x", 1), ("a", "y", 1), ("b", "v", 1)]


def test_write_topics_fans_out(make_log, tmp_dir):
    log = make_log([("s", "a", "insert", [row(1, "x")], [], U, 1, 0), ("s", "b", "insert", [row(2, "y")], [], U, 2, 0)])
    recs = encode(build_events(log, pipeline="p", timestamp=F.lit(0)))
    write_topics(recs, f"{tmp_dir}/out", fmt="json")
    assert sorted(p.split("/")[-1] for p in glob.glob(f"{tmp_dir}/out/topic=*")) == ["topic=s.a", "topic=s.b"]


def test_total_order(spark):
    from rowcast.operators.delivery import total_order

    recs = spark.createDataFrame([(U, s, p) for s in (3, 1, 2) for p in (2, 1)],
                                 "gtid_uuid string, gtid_seq bigint, pos bigint")
    got = [(r.gtid_seq, r.pos) for r in total_order(recs).collect()]
    assert got == sorted(got)


def test_kafka_writer_needs_the_connector(spark):
    import pytest

    from rowcast.sinks.fanout import kafka_writer

    recs = spark.createDataFrame([("t", "k", "{}", U, 1, 0)],
                                 "topic string, key string, value string, gtid_uuid string, gtid_seq bigint, pos bigint")
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_writer("localhost:1")(recs, 0)


def test_enrich_as_of_with_a_hot_key(spark):
    """90 % of the events and versions on one key, in buckets of 100 positions."""
    from rowcast.operators.delivery import enrich_as_of

    ev = spark.range(3000).select(F.col("id").alias("at"), F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    ev = ev.unionByName(spark.createDataFrame([(5, None), (None, "hot")], "at bigint, k string"))
    dim = spark.range(0, 3000, 7).select(F.lit("hot").alias("who"), F.col("id").alias("since"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("v"))
    dim = dim.unionByName(spark.createDataFrame([("9", 9, 1), ("19", 20, 1), (None, 0, 1)], "who string, since bigint, v bigint"))
    got = {(r.at, r.k): (r.since, r.v) for r in enrich_as_of(ev, dim, (F.col("k"), "who"), ("at", "since"), ["since", "v"], width=100).collect()}
    assert len(got) == 3002
    for (at, k), (since, v) in got.items():
        if k == "hot" and at is not None:
            last = at // 7 * 7
            assert (since, v) == (last, last if last % 2 == 0 else None)
        else:
            assert (since, v) == ((9, 1) if k == "9" else (None, None))


def test_sketches_merge(spark):
    from rowcast.operators.delivery import RANK_ERROR, latency_sketches, merged_sketches

    n = 50_000
    recs = spark.range(n).select(F.lit("t").alias("topic"), (F.col("id") * 7919 % n).alias("d"), (F.col("id") % 5).alias("part"))
    got = merged_sketches(latency_sketches(recs, F.col("d"), ["topic", "part"]), quantiles=(0.01, 0.5, 0.99)).first()
    assert (got.n, got.min_latency_us, got.max_latency_us) == (n, 0, n - 1)
    for q in (0.01, 0.5, 0.99):
        assert abs(got[f"p{q * 100:g}_latency_us"] / n - q) <= RANK_ERROR
