"""Structured Streaming pipelines (S1 stream, K1, P1, P8, P9, P10).

The per-event plan (source filter, envelope, expression rules) is narrow and
runs the same on a stream.  Delivery runs in ``foreachBatch`` so that each
micro-batch can also be ordered per key and produce its position row:

* records go to ``<out>/batch_id=<n>/topic=<t>/``, overwritten when a batch is
  replayed after a failure, so output is exactly once per batch id;
* the positions of the batch go to ``<state>/segment=<n>-<n>`` as bitmap rows
  after the records are written, overwritten on a replay like the records, and
  are merged by size later (:mod:`rowcast.streaming.statelog`);
* the streaming checkpoint is the resume point (S4).  A query with a fresh
  checkpoint and saved state resumes from the state, after a check that no saved
  position is ahead of the source (P4), and goes on with its batch numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowcast.model import ACTION_CONT, GTID_SEQ, GTID_UUID, POS, VERDICT_COL
from rowcast.operators.codec import encode
from rowcast.operators.envelope import build_events
from rowcast.operators.position import assert_not_ahead, resume_filter, state_bitmaps
from rowcast.operators.rules import Rule, verdicts
from rowcast.plans.pipeline import PipelineSpec, finished, fold, split_at_state
from rowcast.session import save_shared
from rowcast.streaming import statelog


def events_stream(spec: PipelineSpec, log: DataFrame) -> DataFrame:
    """Filtered and enveloped events of a streaming change log, with ``_verdict``,
    after the rules up to the last stateful one (if any); dropped events are kept
    so that their position is saved."""
    if spec.source_filter is not None:
        log = spec.source_filter.apply(log)
    ev = build_events(log, pipeline=spec.name, timestamp=spec.timestamp, pk=spec.pk,
                      on_error=spec.on_error, string_columns=spec.string_columns)
    head, _ = split_at_state(spec.rules)
    return fold(ev.withColumn(VERDICT_COL, F.lit(ACTION_CONT)), head, spec.on_null_verdict, keep_dropped=True)


#: Sequence numbers that one sorted run of a key covers in the file sink.
RUN_WIDTH = 1 << 16


def deliver_batch(spec: PipelineSpec, events: DataFrame, batch_id: int, out: str | None, state_path: str | None,
                  fmt: str = "parquet", ordered: bool = True, metrics_path: str | None = None,
                  writer=None, base: int = 0) -> None:
    """Deliver one micro-batch: rules, encode, per-key order, write, save position.

    The rule chain runs once: records are exchanged by a hash of topic, key and
    run of sequence numbers (no sampling job), sorted and written, and counts
    are observed on the way.  The position is a second pass over the batch's
    source that reads its position columns alone.  Nothing is kept on executors.

    With ``metrics_path``, one row per batch goes to ``<metrics>/batch=<n>``
    (overwritten on a replay): events in, records written, events not delivered,
    by rule where all rules are expressions, and the largest delay since
    ``meta.timestamp`` (P10).  With ``writer`` the records are handed over
    unordered; the writer orders them for its sink.
    """
    from pyspark.sql import Observation

    _, tail = split_at_state(spec.rules)
    by_rule = metrics_path is not None and len(tail) == len(spec.rules) and all(isinstance(r, Rule) for r in tail)
    df, obs_in, obs_out = events, None, None
    if metrics_path:
        obs_in, obs_out = Observation(f"in_{spec.name}_{batch_id}"), Observation(f"out_{spec.name}_{batch_id}")
    if by_rule:
        df = verdicts(df.drop(VERDICT_COL), tail, spec.on_null_verdict)
        counts = [F.count(F.when(F.col("_dropped_by") == r.name, 1)).alias(f"rule{i}") for i, r in enumerate(tail)]
        df = df.observe(obs_in, F.count(F.lit(1)).alias("events_in"), *counts).drop("_dropped_by")
    elif metrics_path:
        df = df.observe(obs_in, F.count(F.lit(1)).alias("events_in"))
    done = finished(df if by_rule else fold(df, tail, spec.on_null_verdict))
    recs = encode(done.withColumn("_event_us", F.col("meta.timestamp")), keep=(GTID_UUID, GTID_SEQ, POS, "_event_us"))
    if metrics_path:
        delay = F.unix_micros(F.current_timestamp()) - F.col("_event_us")
        recs = recs.observe(obs_out, F.count(F.lit(1)).alias("written"), F.max(delay).alias("max_delay_us"))
    recs = recs.drop("_event_us")
    if writer is not None:
        writer(recs, batch_id)          # e.g. sinks.fanout.kafka_writer(...)
    else:
        if ordered:
            recs = (recs.repartition("topic", "key", F.expr(f"{GTID_SEQ} div {RUN_WIDTH}"))
                    .sortWithinPartitions("topic", "key", GTID_SEQ, POS))
        recs.write.mode("overwrite").partitionBy("topic").format(fmt).save(f"{out}/batch_id={batch_id}")
    if state_path:
        statelog.append(state_bitmaps(events, F.col("meta.pipeline")), state_path, batch_id, base)
    if metrics_path:
        i, o = obs_in.get, obs_out.get
        n, written = int(i.get("events_in") or 0), int(o.get("written") or 0)
        rules = {r.name: int(i[f"rule{k}"]) for k, r in enumerate(tail) if i.get(f"rule{k}")} if by_rule else None
        row = [(spec.name, int(batch_id), n, written, n - written, o.get("max_delay_us"), rules)]
        (events.sparkSession.createDataFrame(row, "pipeline string, batch_no bigint, events_in bigint, written bigint, "
                                                  "not_delivered bigint, max_delay_us bigint, "
                                                  "dropped_by_rule map<string,bigint>")
         .write.mode("overwrite").parquet(f"{metrics_path}/batch={int(batch_id)}"))


def resumed(spec: PipelineSpec, log: DataFrame, checkpoint: str, state_path: str, source: DataFrame | None) -> tuple[DataFrame, int]:
    """S4 at a start: (what of ``log`` is to be processed, number of the first
    batch).  A checkpoint that has begun goes on by itself; a fresh one starts
    from the saved state, if there is one: P4 (with ``source``, the log as a batch
    frame), then P3.  The state is that of the batches before this query, so a
    replayed batch sees the same."""
    spark = log.sparkSession
    base = statelog.first_number(spark, checkpoint, state_path)
    saved = statelog.read_state(spark, state_path, below=base) if base else None
    if saved is None:
        return log, base
    saved = save_shared(saved, "resume-state")
    if source is not None:
        assert_not_ahead(source, saved.where(F.col("name") == spec.name))
    return resume_filter(log, saved, F.lit(spec.name), exact=POS in log.columns), base


def start_pipeline(spec: PipelineSpec, log: DataFrame, out: str | None, checkpoint: str,
                   state_path: str | None = None, available_now: bool = True, processing_time: str | None = None,
                   fmt: str = "parquet", ordered: bool = True, query_name: str | None = None,
                   metrics_path: str | None = None, writer=None, source: DataFrame | None = None) -> StreamingQuery:
    """Start one pipeline as a streaming query (one checkpoint per pipeline).

    Records go to ``out`` as files, or to ``writer(records, batch_id)`` when
    given (e.g. ``sinks.fanout.kafka_writer(servers)``).  Rule patterns are
    checked before the query starts.  With ``state_path`` a query without a
    checkpoint resumes from the saved state, and with ``source`` (the same log as
    a batch frame) it refuses a state that is ahead of the source.
    """
    from rowcast.operators.rules import validate_rules

    validate_rules(log.sparkSession, spec.rules, spec.source_filter)
    base = 0
    if state_path:
        log, base = resumed(spec, log, checkpoint, state_path, source)
    ev = events_stream(spec, log)
    w = (ev.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda b, i: deliver_batch(spec, b, base + i, out, state_path, fmt, ordered, metrics_path, writer, base)))
    if query_name:
        w = w.queryName(query_name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def start_many(specs: list[PipelineSpec], logs: list[DataFrame], root: str, available_now: bool = True
               ) -> list[StreamingQuery]:
    """N independent streaming queries in one session, each with its own
    checkpoint, output and state folder under ``root``."""
    qs = []
    for spec, log in zip(specs, logs, strict=True):
        base = f"{root}/{spec.name}"
        qs.append(start_pipeline(spec, log, f"{base}/out", f"{base}/checkpoint", f"{base}/state",
                                 available_now=available_now, query_name=f"rowcast_{spec.name}"))
    return qs


def observed(records: DataFrame, name: str = "rowcast_delivery") -> DataFrame:
    """P10 on a stream: per-batch counts and max delay reported through
    ``StreamingQueryListener`` / ``query.lastProgress['observedMetrics']``."""
    lat = F.unix_micros(F.current_timestamp()) - F.get_json_object("value", "$.meta.timestamp").cast("bigint")
    return records.observe(name, F.count(F.lit(1)).alias("records"), F.max(lat).alias("max_delay_us"))
