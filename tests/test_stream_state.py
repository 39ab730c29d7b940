"""transformWithState operators: stamping, rule state, exact dedupe."""

import datetime

import pytest
from pyspark.sql import functions as F

from rowcast.operators.envelope import build_events
from rowcast.plans.pipeline import PipelineSpec, finished
from rowcast.sources.changelog import row_events_only, stream_log
from rowcast.streaming.dedupe import dedupe_exact_stream
from rowcast.streaming.stamping import stamp_gtid_stream
from rowcast.streaming.stateful import StatefulRule, WindowRule, apply_window_rule
from rowcast.streaming.stream import events_stream

U = "fa632d10-864b-11ed-843e-0242c0a86002"
BINLOG = "log_file string, pos bigint, action string, gtid_uuid string, gtid_seq bigint"


def run(df, tmp_dir, name="out", **options):
    q = (df.writeStream.format("parquet").option("path", f"{tmp_dir}/{name}").option("checkpointLocation", f"{tmp_dir}/ck-{name}")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    assert not q.isActive and q.exception() is None
    return q


def entries(file, *rows):
    return [(f"log.{file:03d}", p, a, U if s else None, s) for p, a, s in rows]


def arrive(spark, tmp_dir, rows, ddl=BINLOG):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/log")


def test_files_out_of_order_wait_for_their_marker(spark, tmp_dir):
    files = {1: entries(1, (1, "insert", None), (2, "gtid", 7), (3, "insert", None)),
             2: entries(2, (11, "insert", None), (12, "xid", None)),
             3: entries(3, (21, "update", None), (22, "gtid", 8), (23, "delete", None)),
             4: entries(4, (31, "insert", None))}
    seen = []
    for n in (3, 4, 1, 2):
        arrive(spark, tmp_dir, files[n])
        run(row_events_only(stamp_gtid_stream(stream_log(spark, f"{tmp_dir}/log", BINLOG))).select("pos", "gtid_seq"), tmp_dir)
        seen.append({r.pos: r.gtid_seq for r in spark.read.schema("pos bigint, gtid_seq bigint").parquet(f"{tmp_dir}/out").collect()})
    assert seen[0] == {23: 8} and seen[1] == {23: 8} and seen[2] == {23: 8, 1: None, 3: 7}
    assert seen[3] == {1: None, 3: 7, 11: 7, 21: 7, 23: 8, 31: 8}


def test_files_of_one_log_are_stamped_in_many_tasks(spark, tmp_dir):
    """One log isn't one task, and numbers beside nulls keep all their digits."""
    big = (1 << 53) + 1
    rows = [r for n in range(1, 41) for r in entries(n, (n * 10, "insert", None), (n * 10 + 1, "gtid" if n % 2 else "xid", big + 2 * n if n % 2 else None),
                                                     (n * 10 + 2, "delete", None))]
    arrive(spark, tmp_dir, rows)
    stamped = row_events_only(stamp_gtid_stream(stream_log(spark, f"{tmp_dir}/log", BINLOG)))
    run(stamped.select("pos", "gtid_seq", F.spark_partition_id().alias("task")), tmp_dir)
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    own = lambda n: big + 2 * n if n % 2 else big + 2 * (n - 1)
    want = {10: None} | {n * 10: own(n - 1) for n in range(2, 41)} | {n * 10 + 2: own(n) for n in range(1, 41)}
    assert {r.pos: r.gtid_seq for r in got} == want and len(got) == 80
    assert len({r.task for r in got}) > 1


LOG = "schema string, table string, action string, rows array<struct<id:bigint,v:bigint>>, gtid_uuid string, gtid_seq bigint, pos bigint, ts timestamp"


def event(n, user, at=0):
    return ("s", "t", "insert", [(user, n)], U, n, n, datetime.datetime.fromtimestamp(1_700_000_000 + at))


def numbers(spark, tmp_dir, rule):
    spec = PipelineSpec("p", [rule], pk=["id"], timestamp=F.lit(0))
    run(finished(events_stream(spec, stream_log(spark, f"{tmp_dir}/log", LOG))).select("gtid_seq", "seen"), tmp_dir)
    return {r.gtid_seq: r.seen for r in spark.read.schema("gtid_seq bigint, seen bigint").parquet(f"{tmp_dir}/out").collect()}


def test_idle_keys_are_forgotten_and_start_from_a_frame(spark, tmp_dir):
    def count(e, state):  # (a function of this module couldn't be imported by the workers)
        state["seen"] = state.get("seen", 0) + 1
        return 0

    start = spark.createDataFrame([("1", 10)], "key string, seen bigint")
    rule = StatefulRule("n", ["kafka.key"], count, [("seen", "bigint")], ttl="10 seconds", event_time="ts", initial=start)
    arrive(spark, tmp_dir, [event(1, 1), event(2, 2), event(3, 1, 5)], LOG)
    assert numbers(spark, tmp_dir, rule) == {1: 11, 2: 1, 3: 12}
    arrive(spark, tmp_dir, [event(4, 9, 100)], LOG)  # the watermark passes keys 1 and 2
    numbers(spark, tmp_dir, rule)
    arrive(spark, tmp_dir, [event(5, 1, 101), event(6, 9, 101)], LOG)
    got = numbers(spark, tmp_dir, rule)
    assert got[5] == 1 and got[6] == 2 and len(got) == 6


def test_keys_of_one_group_keep_their_own_state(spark, tmp_dir, monkeypatch):
    """Keys share calls of the processor, but neither state nor time to live, and
    big numbers beside nulls keep all their digits."""
    from rowcast.streaming import stateful

    def count(e, state):
        if e["kafka"]["key"] != "3":  # key 3 has no state at all
            state["seen"] = state.get("seen", 0) + 1
        return 0

    big = (1 << 53) + 1
    monkeypatch.setattr(stateful, "KEY_GROUPS", 1)
    start = spark.createDataFrame([("1", big), ("2", None), (None, 7)], "key string, seen bigint")
    rule = StatefulRule("n", ["kafka.key"], count, [("seen", "bigint")], ttl="10 seconds", event_time="ts", initial=start)
    arrive(spark, tmp_dir, [event(1, 1), event(2, 2), event(3, 3), event(4, 1, 5), event(5, 9, 8)], LOG)
    assert numbers(spark, tmp_dir, rule) == {1: big + 1, 2: 1, 3: None, 4: big + 2, 5: 1}
    arrive(spark, tmp_dir, [event(6, 9, 16)], LOG)  # the watermark passes key 2 and 1, not 9
    numbers(spark, tmp_dir, rule)
    arrive(spark, tmp_dir, [event(7, 1, 17), event(8, 2, 17), event(9, 9, 17)], LOG)
    got = numbers(spark, tmp_dir, rule)
    assert (got[6], got[7], got[8], got[9]) == (2, 1, 1, 3) and len(got) == 9


def test_exact_dedupe_collapses_full_buckets(spark, tmp_dir, monkeypatch):
    from rowcast.streaming import dedupe

    monkeypatch.setattr(dedupe, "SHIFT", 4)
    monkeypatch.setattr(dedupe, "WIDTH", 16)
    ddl = "pipeline string, gtid_uuid string, pos bigint, v string"
    for k, rows in enumerate(([("p", U, n, f"v{n}") for n in range(40) for _ in range(2)], [("p", U, n, "late") for n in range(0, 60)],
                              [("q", U, 3, "other"), ("p", "x", 3, "server"), ("p", U, 3, "later still")])):
        arrive(spark, tmp_dir, rows, ddl)
        run(dedupe_exact_stream(stream_log(spark, f"{tmp_dir}/log", ddl)), tmp_dir)
    got = sorted((r.pipeline, r.gtid_uuid, r.pos, r.v) for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    want = [("p", U, n, f"v{n}") for n in range(40)] + [("p", U, n, "late") for n in range(40, 60)] + [("q", U, 3, "other"), ("p", "x", 3, "server")]
    assert got == sorted(want)


def test_window_rules_spread_a_hot_key(spark):
    n = 20_000
    log = spark.range(n).select(
        F.lit("s").alias("schema"), F.lit("t").alias("table"), F.lit("insert").alias("action"),
        F.array(F.struct(F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id")).alias("id"), F.col("id").alias("v"))).alias("rows"),
        F.lit(U).alias("gtid_uuid"), F.col("id").alias("gtid_seq"), F.lit(0).cast("bigint").alias("pos"))
    ev = build_events(log, pipeline="p", pk=["id"], timestamp=F.lit(0)).withColumn("_verdict", F.lit(0))
    rule = WindowRule("w", ["kafka.key"], number="nth", sums={"total": "after[0].v"}, lags={"prev": "after[0].v"},
                      verdict=F.when(F.col("nth") > 17_000, 1).otherwise(0))
    out = apply_window_rule(ev, rule, width=1000)
    hot = out.where("kafka.key = '0'").agg(F.max("nth"), F.max("total"), F.sum("_verdict"), F.max(F.col("gtid_seq") - F.col("prev"))).first()
    ids = [i for i in range(n) if i % 10 < 9]
    assert tuple(hot) == (len(ids), sum(ids), len(ids) - 17_000, 2)
    with pytest.raises(TypeError, match="batch only"):
        apply_window_rule(spark.readStream.format("rate").load().withColumns({"_verdict": F.lit(0)}), rule)
