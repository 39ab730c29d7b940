"""Streams give the batch result; restart resumes from the checkpoint."""

from pyspark.sql import functions as F

from rowcast.plans import samples
from rowcast.plans.pipeline import PipelineSpec, run_batch
from rowcast.sources import fixtures as fx
from rowcast.sources.changelog import stream_log
from rowcast.streaming.stateful import StatefulRule, apply_stateful_rule, running_totals
from rowcast.operators.position import state_text
from rowcast.streaming.statelog import read_state
from rowcast.streaming.stream import start_many, start_pipeline
from conftest import SF_SMALL


def spec():
    return PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)


def test_stream_equals_batch_and_restart(spark, tmp_dir):
    log = fx.chg_events(spark, SF_SMALL).cache()
    n = log.count()
    first, second = log.filter(F.col("gtid_seq") <= n // 2), log.filter(F.col("gtid_seq") > n // 2)
    first.repartition(3).write.parquet(f"{tmp_dir}/log")
    out, ckpt, state = f"{tmp_dir}/out", f"{tmp_dir}/ckpt", f"{tmp_dir}/state"

    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1), out, ckpt, state)
    q.awaitTermination()
    assert q.exception() is None
    # new files arrive; the restarted query reads only those
    second.repartition(2).write.mode("append").parquet(f"{tmp_dir}/log")
    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema), out, ckpt, state)
    q.awaitTermination()

    got = spark.read.option("basePath", out).parquet(out)
    want = run_batch(spec(), log)
    cols = ["gtid_seq", "topic", "key", "value"]
    assert got.count() == want.count()
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert got.select("batch_id").distinct().count() >= 3
    assert state_text(read_state(spark, state)).first().gtid == f"{fx.SOURCE_UUID}:1-{n}"


def test_many_pipelines_each_own_checkpoint(spark, tmp_dir):
    log = fx.chg_region(spark, SF_SMALL)
    log.write.parquet(f"{tmp_dir}/log")
    specs = [PipelineSpec(name="a", timestamp=F.lit(0)), PipelineSpec(name="b", timestamp=F.lit(0))]
    logs = [stream_log(spark, f"{tmp_dir}/log", log.schema) for _ in specs]
    for q in start_many(specs, logs, f"{tmp_dir}/root"):
        q.awaitTermination()
    for name in ("a", "b"):
        assert spark.read.parquet(f"{tmp_dir}/root/{name}/out").count() == 5


def test_stateful_rule_stream_matches_batch_totals(spark, tmp_dir):
    from rowcast.operators.codec import encode
    from rowcast.operators.envelope import build_events

    log = fx.chg_events(spark, SF_SMALL)
    log.repartition(4).write.parquet(f"{tmp_dir}/log")

    def count_and_sum(event, state):
        img = (event.get("after") or event.get("before"))[0]
        state["seen"] = state.get("seen", 0) + 1
        state["cents"] = state.get("cents", 0) + round(img["value"] * 100)
        return 0

    rule = StatefulRule("totals", keys=["topic", "key"], fn=count_and_sum,
                        output=[("seen", "bigint"), ("cents", "bigint")])

    def recs(df):
        ev = build_events(df, pipeline="p", timestamp=F.lit(0), pk=["user_id"])
        return ev.select(F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"), "gtid_seq", "pos",
                         "before", "after")

    s = recs(stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1))
    q = (apply_stateful_rule(s, rule).writeStream.format("memory").queryName("stateful_out")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r.key, r.gtid_seq): (r.seen, r.cents) for r in spark.table("stateful_out").collect()}

    b = recs(log)
    img = F.coalesce(F.get(F.col("after"), 0), F.get(F.col("before"), 0))
    b = b.withColumn("c", F.round(img["value"] * 100).cast("bigint"))
    want = {(r.key, r.gtid_seq): (r.seen, r.cents) for r in running_totals(b, ["topic", "key"], "c", sum_name="cents",
                                                                          width=50).collect()}
    assert len(got) == len(want)
    # per key the running values agree in source order (files arrive in order of their batch)
    for k in {k for k, _ in want}:
        w_last = max((s, v) for (kk, s), v in want.items() if kk == k)[1]
        g_last = max(v for (kk, _s), v in got.items() if kk == k)
        assert g_last == w_last


def test_stream_dedupe_and_observed_metrics(spark, tmp_dir):
    from rowcast.operators.codec import encode
    from rowcast.operators.delivery import dedupe_stream
    from rowcast.operators.envelope import build_events
    from rowcast.streaming.stream import observed

    log = fx.chg_region(spark, SF_SMALL).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    log.union(log).write.parquet(f"{tmp_dir}/log")        # every position delivered twice
    s = stream_log(spark, f"{tmp_dir}/log", log.schema)
    recs = encode(build_events(s, pipeline="p", timestamp=F.lit(0)), keep=("gtid_uuid", "gtid_seq", "pos", "ts"))
    out = observed(dedupe_stream(recs, "ts", "1 hour"), name="delivery")
    q = (out.writeStream.format("memory").queryName("dedup_out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    assert spark.table("dedup_out").count() == 5
    metrics = [p["observedMetrics"]["delivery"] for p in q.recentProgress if p.get("observedMetrics")]
    assert sum(m["records"] for m in metrics) == 5


def test_resume_filter_on_a_stream(spark, tmp_dir):
    from rowcast.operators.position import resume_filter

    log = fx.chg_events(spark, SF_SMALL).withColumn("pipeline", F.lit("p1"))
    log.write.parquet(f"{tmp_dir}/log")
    states = spark.createDataFrame([("p1", f"{fx.SOURCE_UUID}:1-500", 1)], "name string, gtid string, timestamp bigint")
    for bound in (1 << 20, 64):   # pieces alone, and whole buckets too
        s = resume_filter(stream_log(spark, f"{tmp_dir}/log", log.schema), states, coarse=bound, fine=16)
        name = f"resumed_{bound}"
        q = (s.select("gtid_seq").writeStream.format("memory").queryName(name)
             .option("checkpointLocation", f"{tmp_dir}/ck{bound}").trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.table(name)
        assert got.count() == log.filter(F.col("gtid_seq") > 500).count()


def test_stream_batch_metrics(spark, tmp_dir):
    log = fx.chg_events(spark, SF_SMALL)
    log.repartition(2).write.parquet(f"{tmp_dir}/log")
    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1),
                       f"{tmp_dir}/out", f"{tmp_dir}/ck", metrics_path=f"{tmp_dir}/metrics")
    q.awaitTermination()
    m = spark.read.parquet(f"{tmp_dir}/metrics")
    tot = m.agg(F.sum("events_in").alias("i"), F.sum("written").alias("w"), F.sum("not_delivered").alias("d")).first()
    assert tot.i == log.count() and tot.w == run_batch(spec(), log).count() and tot.i == tot.w + tot.d
    assert m.count() == 2
    dropped = {}
    for r in m.collect():
        for k, v in (r.dropped_by_rule or {}).items():
            dropped[k] = dropped.get(k, 0) + v
    assert set(dropped) <= {"generic", "another-rule"} and sum(dropped.values()) == tot.d


def test_pluggable_writer_and_kafka_order(spark, tmp_dir):
    from rowcast.sinks.fanout import order_for_kafka

    log = fx.chg_events(spark, SF_SMALL)
    log.repartition(2).write.parquet(f"{tmp_dir}/log")

    def writer(records, batch_id):
        order_for_kafka(records, 3).write.mode("overwrite").json(f"{tmp_dir}/sent/b={batch_id}")

    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1), None,
                       f"{tmp_dir}/ck", writer=writer)
    q.awaitTermination()
    sent = spark.read.json(f"{tmp_dir}/sent")
    assert sent.count() == run_batch(spec(), log).count()
    # within one batch, each key's records sit in one file, in position order
    for part in order_for_kafka(run_batch(spec(), log), 3).rdd.glom().collect():
        seen = {}
        for r in part:
            assert seen.get((r.topic, r.key), 0) < r.gtid_seq
            seen[(r.topic, r.key)] = r.gtid_seq


def test_rules_directly_on_a_stream(spark, tmp_dir):
    log = fx.chg_events(spark, SF_SMALL)
    log.write.parquet(f"{tmp_dir}/log")
    recs = run_batch(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema))
    q = (recs.writeStream.format("memory").queryName("direct_rules").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("direct_rules").select("gtid_seq", "topic", "key", "value")
    want = run_batch(spec(), log).select("gtid_seq", "topic", "key", "value")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_stateful_rule_state_ttl(spark, tmp_dir):
    from rowcast.streaming.stateful import StatefulRule, _duration_ms, apply_stateful_rule

    assert _duration_ms("2 seconds") == 2000 and _duration_ms("24 hours") == 86_400_000
    schema = "topic string, key string, gtid_seq bigint, pos bigint, ts timestamp"

    def count(event, state):
        state["seen"] = state.get("seen", 0) + 1
        return 0

    rule = StatefulRule("count", ["topic", "key"], count, [("seen", "bigint")])

    def run(rows, folder):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_dir}/in/{folder}")
        s = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in/*")
        q = (apply_stateful_rule(s, rule, state_ttl="10 seconds", event_time="ts").writeStream.format("parquet")
             .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert not q.isActive and q.exception() is None

    import datetime as dt
    t0 = dt.datetime(2024, 1, 1)
    run([("t", "k", 1, 0, t0), ("t", "k", 2, 0, t0 + dt.timedelta(seconds=5))], "a")
    run([("t", "other", 3, 0, t0 + dt.timedelta(seconds=60))], "b")   # watermark passes k's TTL
    run([("t", "k", 4, 0, t0 + dt.timedelta(seconds=61))], "c")
    seen = {r.gtid_seq: r.seen for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert seen == {1: 1, 2: 2, 3: 1, 4: 1}          # k's state was forgotten after it idled
