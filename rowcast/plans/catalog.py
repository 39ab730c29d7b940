"""Named queries over the driver's tables, each with a DuckDB oracle.

Every query reads whole tables (through the change-log fixtures) and returns
scalar or JSON-string columns, so results compare by value hash.  The oracle
SQL uses the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast import functions as RF
from rowcast.model import ACTION_CONT, ACTION_DROP
from rowcast.operators.codec import encode, image_json, payload
from rowcast.operators.envelope import build_events
from rowcast.operators.rules import Rule, SourceFilter, apply_rules
from rowcast.plans import samples
from rowcast.plans.pipeline import PipelineSpec, run_batch, run_events
from rowcast.sources import fixtures as fx

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return deco


# ---------------------------------------------------------------- oracle building blocks (DuckDB SQL)

CHG_EVENTS_SQL = """
SELECT event_id + 1 AS gtid_seq,
       CASE user_id % 3 WHEN 0 THEN 'test_shop' WHEN 1 THEN 'tenant_shop' ELSE 'audit_db' END AS schema_name,
       CASE user_id % 2 WHEN 0 THEN 'test_events' ELSE 'entity_1' END AS table_name,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END AS action,
       event_id, user_id, value, ts,
       CASE WHEN value < 10 THEN 'ignore' WHEN value < 20 THEN 'change-kafka'
            WHEN value < 30 THEN 'should-continue' WHEN value < 40 THEN 'abc'
            WHEN value < 50 THEN NULL ELSE event_type END AS text_col,
       COALESCE(LAG(event_id) OVER (PARTITION BY user_id ORDER BY event_id), event_id) AS prev_event_id,
       COALESCE(LAG(value)    OVER (PARTITION BY user_id ORDER BY event_id), value)    AS prev_value
FROM events
"""

# before/after image lists of chg_events, as DuckDB list expressions
BEFORE_SQL = """CASE action
     WHEN 'update' THEN [{'event_id': prev_event_id, 'text_col': text_col, 'user_id': user_id, 'value': prev_value}]
     WHEN 'delete' THEN [{'event_id': event_id, 'text_col': text_col, 'user_id': user_id, 'value': value}] END"""
AFTER_SQL = """CASE WHEN action <> 'delete'
     THEN [{'event_id': event_id, 'text_col': text_col, 'user_id': user_id, 'value': value}] END"""

CHG_LINEITEM_SQL = """
SELECT l.l_orderkey + 1 AS gtid_seq, l.l_orderkey,
       list({'l_linenumber': l.l_linenumber, 'l_orderkey': l.l_orderkey, 'l_partkey': l.l_partkey,
             'l_quantity': l.l_quantity, 'l_suppkey': l.l_suppkey, 'row_no': l.row_no} ORDER BY l.row_no) AS rows
FROM (SELECT l.*, ROW_NUMBER() OVER (PARTITION BY l.l_orderkey
              ORDER BY l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice) AS row_no
      FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) l
GROUP BY l.l_orderkey
"""


def _events(spark, sf_dir, pk=("user_id",), pipeline="p1"):
    log = fx.chg_events(spark, sf_dir, pk=pk)
    return build_events(log, pipeline=pipeline, timestamp=F.col("gtid_seq") * 1000)


# ---------------------------------------------------------------- flagship (T*, M*, E12)

@query("sample_chain", f"""
WITH c AS ({CHG_EVENTS_SQL}),
e AS (SELECT *, regexp_matches(schema_name, 'test_.*') AND regexp_matches(table_name, 'test_.*') AS g,
             CASE WHEN action <> 'delete' THEN text_col END AS t FROM c),
f AS (SELECT *, g AND coalesce(t = 'change-kafka', false) AS hit,
             CASE WHEN g AND length(t) > 3 THEN '****' ELSE t END AS t2 FROM e
      WHERE NOT (g AND coalesce(t = 'ignore', false))
        AND NOT (regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1'))),
r AS (SELECT *, CASE WHEN hit THEN 'another-topic' ELSE schema_name || '.' || table_name END AS topic,
             CASE WHEN hit THEN 'another-msg-key' ELSE user_id::VARCHAR END AS key FROM f)
SELECT gtid_seq, topic, key, to_json({{'schema': schema_name, 'table': table_name, 'action': action,
  'before': {BEFORE_SQL},
  'after': CASE WHEN action <> 'delete' THEN [{{'event_id': event_id, 'text_col': t2, 'user_id': user_id, 'value': value}}] END,
  'meta': {{'timestamp': gtid_seq * 1000, 'pipeline': 'p1'}},
  'kafka': {{'topic': topic, 'key': key}}}})::VARCHAR AS value
FROM r
""")
def sample_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: the two upstream sample rules end to end, delivered as JSON records (T*, M1-M5, E12)."""
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"],
                        timestamp=F.col("gtid_seq") * 1000)
    return run_batch(spec, fx.chg_events(spark, sf_dir)).select("gtid_seq", "topic", "key", "value")


# ---------------------------------------------------------------- envelope

@query("insert_images", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, action, to_json({BEFORE_SQL})::VARCHAR AS before_json, to_json({AFTER_SQL})::VARCHAR AS after_json
FROM c WHERE action = 'insert'
""")
def insert_images(spark, sf_dir):
    """Inserts carry their rows as ``after``, ``before`` is null."""
    ev = _events(spark, sf_dir).filter(F.col("action") == "insert")
    return ev.select("gtid_seq", "action", image_json("before").alias("before_json"),
                     image_json("after").alias("after_json"))


@query("delete_images", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, action, to_json({BEFORE_SQL})::VARCHAR AS before_json, to_json({AFTER_SQL})::VARCHAR AS after_json
FROM c WHERE action = 'delete'
""")
def delete_images(spark, sf_dir):
    """Deletes carry their rows as ``before``, ``after`` is null."""
    ev = _events(spark, sf_dir).filter(F.col("action") == "delete")
    return ev.select("gtid_seq", "action", image_json("before").alias("before_json"),
                     image_json("after").alias("after_json"))


@query("update_pairs", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, prev_event_id AS before_event_id, event_id AS after_event_id,
       prev_value AS before_value, value AS after_value,
       to_json({BEFORE_SQL})::VARCHAR AS before_json, to_json({AFTER_SQL})::VARCHAR AS after_json
FROM c WHERE action = 'update'
""")
def update_pairs(spark, sf_dir):
    """Update rows pair up by position, before at even and after at odd indexes."""
    ev = _events(spark, sf_dir).filter(F.col("action") == "update")
    b, a = RF.first_row("before"), RF.first_row("after")
    return ev.select("gtid_seq", b["event_id"].alias("before_event_id"), a["event_id"].alias("after_event_id"),
                     b["value"].alias("before_value"), a["value"].alias("after_value"),
                     image_json("before").alias("before_json"), image_json("after").alias("after_json"))


@query("multi_row_insert", f"""
WITH c AS ({CHG_LINEITEM_SQL})
SELECT gtid_seq, len(rows)::BIGINT AS n_rows, rows[1].l_linenumber AS first_linenumber,
       rows[len(rows)].row_no AS last_row_no, to_json(rows)::VARCHAR AS after_json
FROM c
""")
def multi_row_insert(spark, sf_dir):
    """One event with many rows, in source order."""
    ev = build_events(fx.chg_lineitem(spark, sf_dir), pipeline="p1", timestamp=F.lit(0))
    return ev.select("gtid_seq", F.size("after").cast("bigint").alias("n_rows"),
                     RF.first_row("after")["l_linenumber"].alias("first_linenumber"),
                     F.element_at("after", -1)["row_no"].alias("last_row_no"),
                     image_json("after").alias("after_json"))


@query("default_topic", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name || '.' || table_name AS topic FROM c
""")
def default_topic(spark, sf_dir):
    """The topic is ``schema.table``."""
    return _events(spark, sf_dir).select("gtid_seq", F.col("kafka.topic").alias("topic"))


@query("key_single_pk", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, user_id::VARCHAR AS key FROM c
""")
def key_single_pk(spark, sf_dir):
    """A numeric primary key becomes the key text (Q1)."""
    return _events(spark, sf_dir, pk=("user_id",)).select("gtid_seq", F.col("kafka.key").alias("key"))


@query("key_composite_pk", f"""
WITH c AS ({CHG_LINEITEM_SQL})
SELECT gtid_seq, 'test_sales.test_lineitem' AS topic,
       rows[1].l_orderkey::VARCHAR || '.' || rows[1].l_linenumber::VARCHAR AS key FROM c
""")
def key_composite_pk(spark, sf_dir):
    """A composite key joins row 0's values with dots (Q2)."""
    ev = build_events(fx.chg_lineitem(spark, sf_dir), pipeline="p1", timestamp=F.lit(0))
    return ev.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"))


@query("key_no_pk", """
SELECT (r_regionkey + 1)::BIGINT AS gtid_seq, 'ref_db.region' AS topic, 'ref_db.region' AS key FROM region
""")
def key_no_pk(spark, sf_dir):
    """Without a primary key the key is the topic."""
    ev = build_events(fx.chg_region(spark, sf_dir), pipeline="p1", timestamp=F.lit(0))
    return ev.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"))


@query("key_from_before_image", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, action,
       CASE action WHEN 'update' THEN prev_event_id ELSE event_id END::VARCHAR AS key FROM c
""")
def key_from_before_image(spark, sf_dir):
    """An update's key comes from the before image."""
    return _events(spark, sf_dir, pk=("event_id",)).select("gtid_seq", "action", F.col("kafka.key").alias("key"))


@query("payload_json", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key,
  to_json({{'schema': schema_name, 'table': table_name, 'action': action,
  'before': {BEFORE_SQL}, 'after': {AFTER_SQL},
  'meta': {{'timestamp': epoch_us(ts), 'pipeline': 'p1'}},
  'kafka': {{'topic': schema_name || '.' || table_name, 'key': user_id::VARCHAR}}}})::VARCHAR AS value
FROM c
""")
def payload_json(spark, sf_dir):
    """The full JSON payload with processing time from the log."""
    log = fx.chg_events(spark, sf_dir)
    ev = build_events(log, pipeline="p1", timestamp=F.unix_micros(F.col("ts").cast("timestamp")))
    return encode(ev).select("gtid_seq", "topic", "key", "value")


@query("payload_decode", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, action, schema_name || '.' || table_name AS topic,
       CASE WHEN action <> 'delete' THEN text_col END AS after_text,
       CASE WHEN action <> 'delete' THEN user_id END AS after_user_id,
       CASE action WHEN 'update' THEN prev_value WHEN 'delete' THEN value END AS before_value
FROM c
""")
def payload_decode(spark, sf_dir):
    """Delivered JSON read back into typed fields."""
    from rowcast.operators.codec import decode
    log = fx.chg_events(spark, sf_dir)
    recs = encode(build_events(log, pipeline="p1", timestamp=F.col("gtid_seq") * 1000))
    img = "struct<event_id:bigint,text_col:string,user_id:bigint,value:double>"
    ev = decode(recs.select("gtid_seq", "value"), img)
    return ev.select("gtid_seq", "action", F.col("kafka.topic").alias("topic"),
                     RF.first_row("after")["text_col"].alias("after_text"),
                     RF.first_row("after")["user_id"].alias("after_user_id"),
                     RF.first_row("before")["value"].alias("before_value"))


# ---------------------------------------------------------------- value normalisation (E5)

@query("string_values", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, text_col, length(text_col)::BIGINT AS text_len FROM c
""")
def string_values(spark, sf_dir):
    """E5: bytes of columns declared as strings become text."""
    log = fx.chg_events(spark, sf_dir)
    # the source delivers text_col as raw bytes; the type map says it is a string
    raw = log.withColumn("rows", F.transform("rows", lambda r: r.withField("text_col", F.encode(r["text_col"], "UTF-8"))))
    ev = build_events(raw, pipeline="p1", timestamp=F.lit(0), string_columns=["text_col"])
    img = F.coalesce(RF.first_row("after"), RF.first_row("before"))
    return ev.select("gtid_seq", img["text_col"].alias("text_col"),
                     F.length(img["text_col"]).cast("bigint").alias("text_len"))


@query("string_values_mixed", ORACLES["string_values"])
def string_values_mixed(spark, sf_dir):
    """E5 in the mixed layout: bytes of declared string columns become text there too."""
    from rowcast.operators.mixed import to_mixed_log
    log = fx.chg_events(spark, sf_dir)
    raw = log.withColumn("rows", F.transform("rows", lambda r: r.withField("text_col", F.encode(r["text_col"], "UTF-8"))))
    ev = build_events(to_mixed_log(raw), pipeline="p1", timestamp=F.lit(0), string_columns=["text_col"])
    img = F.coalesce(RF.first_row("after"), RF.first_row("before"))
    text = F.variant_get(img["text_col"], "$", "string")
    return ev.select("gtid_seq", text.alias("text_col"), F.length(text).cast("bigint").alias("text_len"))


@query("positional_rows", f"""
WITH c AS ({CHG_EVENTS_SQL}),
j AS (SELECT gtid_seq, to_json([{{'event_id': event_id, 'text_col': text_col, 'user_id': user_id, 'value': value}}])::VARCHAR
      AS image FROM c)
SELECT gtid_seq, image AS typed_json, image AS mixed_json FROM j
""")
def positional_rows(spark, sf_dir):
    """Raw rows that come as bare value lists are named from the table's
    columns, in both layouts."""
    from rowcast.operators.envelope import name_positional, name_positional_typed
    from rowcast.operators.mixed import sorted_rows
    names = ["event_id", "text_col", "user_id", "value"]
    raw = fx.events_columns(fx.table(spark, sf_dir, "events")).select(
        "gtid_seq", F.array(F.array(*[F.col(n).cast("variant") for n in names])).alias("rows"))
    typed = T._parse_datatype_string("struct<event_id:bigint,text_col:string,user_id:bigint,value:double>")
    return raw.select("gtid_seq", image_json(name_positional_typed(F.col("rows"), typed)).alias("typed_json"),
                      image_json(sorted_rows(name_positional(F.col("rows"), names))).alias("mixed_json"))


TYPE_TABLE_SQL = """
SELECT event_id AS gtid_seq,
  '[{"b":"' || to_base64(encode(event_type)) || '","d":"' || strftime(ts, '%Y-%m-%d') || '","doc":{"id":' || user_id
  || ',"kind":"' || event_type || '"},"f":' || to_json(value)::VARCHAR || ',"i":' || user_id || ',"n":null,"price":'
  || CAST(event_id + 0.1234 AS DECIMAL(20, 4))::VARCHAR || ',"t":"' || strftime(ts + to_microseconds(event_id % 1000000), '%Y-%m-%d %H:%M:%S.%f')
  || '","text":' || to_json(event_type)::VARCHAR || '}]' AS image
FROM events
"""


def _type_log(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    late = (F.col("ts").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 1000000 / 1000000).cast("decimal(18,6)"))).cast("timestamp_ntz")
    image = F.struct(
        F.encode("event_type", "UTF-8").alias("b"), F.col("ts").cast("date").alias("d"),
        F.parse_json(F.format_string('{"id":%d,"kind":"%s"}', "user_id", "event_type")).alias("doc"), F.col("value").alias("f"),
        F.col("user_id").alias("i"), F.lit(None).cast("string").alias("n"),
        (F.col("event_id") + F.lit("0.1234").cast("decimal(20,4)")).cast("decimal(20,4)").alias("price"),
        late.alias("t"), F.col("event_type").alias("text"))
    log = ev.select(F.lit("s").alias("schema"), F.lit("types").alias("table"), F.lit("insert").alias("action"),
                    F.array(image).alias("rows"), F.array(F.lit("i")).alias("pk_columns"), F.lit(fx.SOURCE_UUID).alias("gtid_uuid"),
                    F.col("event_id").alias("gtid_seq"), F.col("event_id").alias("pos"))

    return log


def type_events(spark, sf_dir):
    return build_events(_type_log(spark, sf_dir), pipeline="p1", timestamp=F.lit(0))


@query("type_table", f"SELECT gtid_seq, image AS typed_json, image AS mixed_json FROM ({TYPE_TABLE_SQL})")
def type_table(spark, sf_dir):
    """A row of every column type (decimal, date, time with microseconds,
    binary, JSON, float, integer, text, null) encodes alike in both layouts."""
    from rowcast.operators.mixed import to_mixed_log

    def after(x, name):
        recs = encode(build_events(x, pipeline="p1", timestamp=F.lit(0)))
        # the image list within the delivered text
        return recs.select("gtid_seq", F.regexp_extract("value", r'"after":(\[.*\]),"meta"', 1).alias(name))
    log = _type_log(spark, sf_dir)
    return after(log, "typed_json").join(after(to_mixed_log(log), "mixed_json"), "gtid_seq")


# ---------------------------------------------------------------- raw log entries

CHG_BINLOG_SQL = """
SELECT 'binlog.' || lpad(((event_id // 1000) + 1)::VARCHAR, 6, '0') AS log_file, event_id AS pos,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' WHEN 'click' THEN 'update'
                       WHEN 'view' THEN 'gtid' ELSE 'xid' END AS action,
       CASE WHEN event_type = 'view' THEN CASE WHEN (event_id // 1500) % 2 = 0 THEN '""" + fx.SOURCE_UUID + """'
                                               ELSE '""" + fx.OTHER_UUID + """' END END AS gtid_uuid,
       CASE WHEN event_type = 'view' THEN event_id + 1 END AS gtid_seq, ts
FROM events
"""
# the last marker in the whole log, its number and its server
STAMPED_SQL = f"""
SELECT log_file, pos, action, ts,
       last_value(gtid_uuid IGNORE NULLS) OVER w AS gtid_uuid, last_value(gtid_seq IGNORE NULLS) OVER w AS gtid_seq
FROM ({CHG_BINLOG_SQL}) WINDOW w AS (ORDER BY log_file, pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


@query("row_events_only", f"""
WITH b AS ({CHG_BINLOG_SQL})
SELECT log_file, pos, action FROM b WHERE action IN ('insert', 'update', 'delete')
""")
def row_events_only_q(spark, sf_dir):
    """Only row changes pass; GTID markers and commits are skipped."""
    from rowcast.sources.changelog import row_events_only
    return row_events_only(fx.chg_binlog(spark, sf_dir)).select("log_file", "pos", "action")


@query("gtid_stamp", f"""
WITH s AS ({STAMPED_SQL})
SELECT log_file, pos, action, gtid_uuid, gtid_seq FROM s WHERE action IN ('insert', 'update', 'delete')
""")
def gtid_stamp(spark, sf_dir):
    """Every row event gets the last GTID marker before it in the log, with its server."""
    from rowcast.sources.changelog import row_events_only, stamp_gtid
    stamped = stamp_gtid(fx.chg_binlog(spark, sf_dir))
    return row_events_only(stamped).select("log_file", "pos", "action", "gtid_uuid", "gtid_seq")


@query("gtid_stamp_stream", ORACLES["gtid_stamp"])
def gtid_stamp_stream(spark, sf_dir):
    """S2 on a stream: log files arrive last part first, and middle after it; the
    events that wait for an earlier file's marker are state."""
    from rowcast.session import shared_path
    from rowcast.sources.changelog import row_events_only, stream_log
    from rowcast.streaming.stamping import stamp_gtid_stream
    base = shared_path(spark, "gtid_stamp_stream")
    log = fx.chg_binlog(spark, sf_dir)
    n = fx.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    cuts = [0, n // 3000 * 1000, 2 * (n // 3000) * 1000, n + 1]  # at files' ends
    for part in (2, 1, 0):
        log.filter(F.col("pos").between(cuts[part], cuts[part + 1] - 1)).repartition("log_file").write.mode("append").parquet(f"{base}/log")
        stamped = row_events_only(stamp_gtid_stream(stream_log(spark, f"{base}/log", log.schema)))
        q = (stamped.select("log_file", "pos", "action", "gtid_uuid", "gtid_seq").writeStream.format("parquet")
             .option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


@query("source_restart", f"SELECT log_file, pos, action FROM ({CHG_BINLOG_SQL})")
def source_restart(spark, sf_dir):
    """The log as a data source with positions as offsets.  The query stops,
    its checkpoint is lost, and a new one starts after the position that it had
    reached, within a segment's successor: nothing twice and nothing lost."""
    from rowcast.session import shared_path
    from rowcast.sources.segments import reached, stream_segments
    base = shared_path(spark, "source_restart")
    log = fx.chg_binlog(spark, sf_dir).select("log_file", "pos", "action", "gtid_uuid", "gtid_seq")
    n = fx.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    start = None
    for run, (lo, hi) in enumerate(((0, n // 2000 * 1000 - 1), (n // 2000 * 1000, n))):
        log.filter(F.col("pos").between(lo, hi)).repartitionByRange("log_file").sortWithinPartitions("log_file", "pos").write.mode(
            "append").partitionBy("log_file").parquet(f"{base}/log")
        s = stream_segments(spark, f"{base}/log", "pos bigint, action string, gtid_uuid string, gtid_seq bigint, log_file string", start=start,
                            segments_per_trigger=16)
        q = (s.select("log_file", "pos", "action").writeStream.format("parquet").option("path", f"{base}/out{run}")
             .option("checkpointLocation", f"{base}/checkpoint{run}").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        start = reached(q.lastProgress)
    return spark.read.parquet(f"{base}/out0").unionByName(spark.read.parquet(f"{base}/out1"))


# ---------------------------------------------------------------- guards, filters, verdicts

GUARD_SQL = "regexp_matches(schema_name, 'test_.*') AND regexp_matches(table_name, 'test_.*')"


@query("source_filter", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name, table_name FROM c
WHERE (regexp_matches(schema_name, 'test_.*') OR regexp_matches(schema_name, 'audit'))
  AND NOT regexp_matches(schema_name, '^test_shop$')
  AND (regexp_matches(table_name, 'events') OR regexp_matches(table_name, 'entity'))
  AND NOT regexp_matches(table_name, '_1$')
""")
def source_filter(spark, sf_dir):
    """Include and exclude lists on schema and table."""
    sfilter = SourceFilter(include_schemas=["test_.*", "audit", ""], exclude_schemas=["^test_shop$"],
                           include_tables=["events", "entity"], exclude_tables=["_1$"])
    spec = PipelineSpec(name="p1", source_filter=sfilter, pk=["user_id"], timestamp=F.lit(0))
    return run_events(spec, fx.chg_events(spark, sf_dir)).select(
        "gtid_seq", F.col("schema").alias("schema_name"), F.col("table").alias("table_name"))


@query("rule_guard", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, {GUARD_SQL} AS generic_match,
       regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1') AS tenant_match
FROM c
""")
def rule_guard(spark, sf_dir):
    """Unanchored regex guards on schema and table."""
    ev = _events(spark, sf_dir)
    return ev.select("gtid_seq", samples.generic_rule().guard().alias("generic_match"),
                     samples.tenant_drop_rule().guard().alias("tenant_match"))


@query("rule_keep_first_row", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key,
       CASE WHEN action <> 'delete' THEN text_col END AS after_text
FROM c
WHERE NOT ({GUARD_SQL}) OR (action <> 'delete' AND coalesce(text_col = 'should-continue', false))
""")
def rule_keep_first_row(spark, sf_dir):
    """Keep only events whose first after row says should-continue."""
    out = apply_rules(_events(spark, sf_dir), [samples.keep_should_continue_rule()])
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"),
                      RF.first_row("after")["text_col"].alias("after_text"))


@query("rule_drop_any_row", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, action FROM c
WHERE NOT ({GUARD_SQL} AND action <> 'delete' AND coalesce(text_col = 'ignore', false))
""")
def rule_drop_any_row(spark, sf_dir):
    """Drop events where any after row says ignore."""
    rule = Rule("drop-ignored", "test_.*", "test_.*",
                verdict=F.when(RF.any_row("after", "text_col", lambda v: v == "ignore"), ACTION_DROP)
                         .otherwise(ACTION_CONT))
    return apply_rules(_events(spark, sf_dir), [rule]).select("gtid_seq", "action")


@query("rule_drop_table", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name || '.' || table_name AS topic FROM c
WHERE NOT (regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1'))
""")
def rule_drop_table(spark, sf_dir):
    """Drop every event of the matched tables."""
    out = apply_rules(_events(spark, sf_dir), [samples.tenant_drop_rule()])
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"))


def chain_rules() -> list[Rule]:
    """A chain that shows the fold: no-op rule, a rename the next rules see,
    a verdict 2 that a non-matching rule resets, DROP, and a final verdict 2."""
    text = F.coalesce(RF.first_row("after")["text_col"], RF.first_row("before")["text_col"])
    return [
        samples.empty_rule(),
        Rule("rename", match_schema="audit_db", set={"schema": F.lit("test_audit")}),
        Rule("hold-abc", "test_.*", "entity_1", verdict=F.when(text == "abc", 2).otherwise(ACTION_CONT)),
        Rule("drop-null-text", "test_.*", "test_events",
             verdict=F.when(text.isNull(), ACTION_DROP).otherwise(ACTION_CONT)),
        Rule("hold-audit-deletes", "test_audit", "", verdict=F.when(F.col("action") == "delete", 2).otherwise(0)),
    ]


@query("rule_chain", f"""
WITH c AS ({CHG_EVENTS_SQL}),
s AS (SELECT *, CASE WHEN regexp_matches(schema_name, 'audit_db') THEN 'test_audit' ELSE schema_name END AS schema2
      FROM c)
SELECT gtid_seq, schema2 AS schema_name, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key
FROM s
WHERE NOT (regexp_matches(schema2, 'test_.*') AND regexp_matches(table_name, 'test_events') AND text_col IS NULL)
  AND NOT (regexp_matches(schema2, 'test_audit') AND action = 'delete')
""")
def rule_chain(spark, sf_dir):
    """The verdict fold across no-op, renaming, holding and dropping rules."""
    out = apply_rules(_events(spark, sf_dir), chain_rules())
    return out.select("gtid_seq", F.col("schema").alias("schema_name"), F.col("kafka.topic").alias("topic"),
                      F.col("kafka.key").alias("key"))


# ---------------------------------------------------------------- mutation (M1-M7)

@query("mask_column", f"""
WITH c AS ({CHG_EVENTS_SQL}),
m AS (SELECT *, CASE WHEN {GUARD_SQL} AND length(text_col) > 3 THEN '****' ELSE text_col END AS tm FROM c)
SELECT gtid_seq,
  to_json(CASE action
     WHEN 'update' THEN [{{'event_id': prev_event_id, 'text_col': tm, 'user_id': user_id, 'value': prev_value}}]
     WHEN 'delete' THEN [{{'event_id': event_id, 'text_col': tm, 'user_id': user_id, 'value': value}}] END)::VARCHAR
     AS before_json,
  to_json(CASE WHEN action <> 'delete'
     THEN [{{'event_id': event_id, 'text_col': tm, 'user_id': user_id, 'value': value}}] END)::VARCHAR AS after_json
FROM m
""")
def mask_column(spark, sf_dir):
    # both images are masked, so an update does not leak the old value in ``before``
    """M1-M3: mask long text in both images."""
    rule = Rule("mask", "test_.*", "test_.*", set={"after": RF.mask_field("after", "text_col", 3),
                                                     "before": RF.mask_field("before", "text_col", 3)})
    out = apply_rules(_events(spark, sf_dir), [rule])
    return out.select("gtid_seq", image_json("before").alias("before_json"), image_json("after").alias("after_json"))


@query("reroute", f"""
WITH c AS ({CHG_EVENTS_SQL}),
r AS (SELECT *, {GUARD_SQL} AND action <> 'delete' AND coalesce(text_col = 'change-kafka', false) AS hit FROM c)
SELECT gtid_seq,
       CASE WHEN hit THEN 'rerouted.' || table_name ELSE schema_name || '.' || table_name END AS topic,
       CASE WHEN hit THEN user_id::VARCHAR || '#' || gtid_seq::VARCHAR ELSE user_id::VARCHAR END AS key
FROM r
""")
def reroute(spark, sf_dir):
    """M4/M5: change topic and key for matched events."""
    hit = RF.any_row("after", "text_col", lambda v: v == "change-kafka")
    rule = Rule("reroute", "test_.*", "test_.*", set={
        "kafka.topic": F.when(hit, F.concat(F.lit("rerouted."), F.col("table"))).otherwise(F.col("kafka.topic")),
        "kafka.key": F.when(hit, F.concat(F.col("kafka.key"), F.lit("#"), F.col("gtid_seq").cast("string")))
                      .otherwise(F.col("kafka.key")),
    })
    out = apply_rules(_events(spark, sf_dir), [rule])
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"))


@query("image_add_drop_column", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, 'p1-reshaped' AS pipeline, upper(action) AS action,
  to_json(CASE WHEN action <> 'delete' THEN [{{'event_id': event_id, 'user_id': user_id, 'value': value,
     'value_cents': round(value * 100)::BIGINT}}] END)::VARCHAR AS after_json
FROM c
""")
def image_add_drop_column(spark, sf_dir):
    """M6/M7: add and drop image columns and rewrite envelope fields."""
    ev = _events(spark, sf_dir)
    names = ev.schema["after"].dataType.elementType.names
    rule = Rule("reshape", set={
        "after": RF.reshape_rows("after", names, add={"value_cents": lambda r: F.round(r["value"] * 100).cast("bigint")},
                                 drop=("text_col",)),
        "meta.pipeline": F.lit("p1-reshaped"),
        "action": F.upper("action"),
    })
    out = apply_rules(ev, [rule])
    return out.select("gtid_seq", F.col("meta.pipeline").alias("pipeline"), "action",
                      image_json("after").alias("after_json"))


# ---------------------------------------------------------------- positions

CRASH_AT = "2024-01-15 00:00:00"  # the moment the pipelines stopped, for the resume cases


def _gtid_text(spark, sf_dir):
    """GTID-set texts derived from the events: singletons, ranges, several
    intervals and a second server uuid, with whitespace after commas."""
    ev = fx.table(spark, sf_dir, "events")
    seq = (F.col("event_id") + 1).cast("string")
    hi = (F.col("event_id") + 1 + F.col("user_id")).cast("string")
    first = F.concat(F.lit(fx.SOURCE_UUID.upper() + ":"), seq,
                     F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("-"), hi)).otherwise(F.lit("")))
    second = F.when(F.col("value") >= 250, F.concat(
        F.lit(",\n " + fx.OTHER_UUID + ":1-"), (F.col("user_id") + 1).cast("string"),
        F.lit(":"), (F.col("user_id") + 3).cast("string"))).otherwise(F.lit(""))
    return ev.select("event_id", F.concat(first, second).alias("gtid"))


GTID_TEXT_SQL = f"""
SELECT event_id,
  upper('{fx.SOURCE_UUID}') || ':' || (event_id + 1)::VARCHAR
  || CASE WHEN event_type IN ('click', 'view') THEN '-' || (event_id + 1 + user_id)::VARCHAR ELSE '' END
  || CASE WHEN value >= 250 THEN ',' || chr(10) || ' {fx.OTHER_UUID}:1-' || (user_id + 1)::VARCHAR
          || ':' || (user_id + 3)::VARCHAR ELSE '' END AS gtid
FROM events
"""


@query("gtid_parse", f"""
WITH s AS ({GTID_TEXT_SQL}),
m AS (SELECT event_id, unnest(string_split(regexp_replace(gtid, '\\s+', '', 'g'), ',')) AS member FROM s),
i AS (SELECT event_id, lower(split_part(member, ':', 1)) AS uuid,
             unnest(string_split(member, ':')[2:]) AS iv FROM m)
SELECT event_id, uuid, split_part(iv, '-', 1)::BIGINT AS lo,
       coalesce(nullif(split_part(iv, '-', 2), ''), split_part(iv, '-', 1))::BIGINT AS hi
FROM i
""")
def gtid_parse(spark, sf_dir):
    """GTID-set texts (several uuids, intervals, whitespace) as intervals."""
    from rowcast.functions.gtid import parse_gtid_set
    s = _gtid_text(spark, sf_dir)
    return (s.select("event_id", F.explode(parse_gtid_set("gtid")).alias("r"))
            .select("event_id", "r.uuid", "r.lo", "r.hi"))


STATE_LOG_SQL = f"""
SELECT CASE user_id % 3 WHEN 0 THEN 'p0' WHEN 1 THEN 'p1' ELSE 'p2' END AS name,
       event_id + 1 AS gtid_seq, ts AS saved_at FROM events
"""


def _states(spark, sf_dir, before: str | None = None, foreign: str | None = None):
    """State rows ``(name, gtid, timestamp)`` in the upstream ``uuid:N`` form."""
    st = fx.state_log(spark, sf_dir)
    if before is not None:
        st = st.filter(F.col("saved_at") < F.lit(before).cast("timestamp_ntz"))
    uuid = F.col("gtid_uuid")
    if foreign is not None:
        uuid = F.when(F.col("name") == foreign, F.lit(fx.OTHER_UUID)).otherwise(uuid)
    return st.select("name", F.concat(uuid, F.lit(":"), F.col("gtid_seq").cast("string")).alias("gtid"),
                     F.unix_micros(F.col("saved_at").cast("timestamp")).alias("timestamp"))


@query("state_latest", f"""
WITH s AS ({STATE_LOG_SQL})
SELECT name, '{fx.SOURCE_UUID}:' || arg_max(gtid_seq, saved_at)::VARCHAR AS gtid,
       arg_max(gtid_seq, saved_at) AS gtid_seq
FROM s GROUP BY name
""")
def state_latest(spark, sf_dir):
    """The newest saved position per pipeline."""
    from rowcast.functions.gtid import parse_gtid_set
    from rowcast.operators.position import latest_state
    st = latest_state(_states(spark, sf_dir))
    return st.select("name", "gtid", F.get(parse_gtid_set("gtid"), 0)["hi"].alias("gtid_seq"))


def _pipeline_log(spark, sf_dir):
    return fx.chg_events(spark, sf_dir).withColumn("pipeline", fx.pipeline_of(F.get(F.col("rows"), 0)["user_id"]))


PIPELINE_EVENTS_SQL = f"""
SELECT event_id + 1 AS gtid_seq, CASE user_id % 3 WHEN 0 THEN 'p0' WHEN 1 THEN 'p1' ELSE 'p2' END AS pipeline, ts
FROM events
"""


@query("resume_filter", f"""
WITH c AS ({PIPELINE_EVENTS_SQL}), s AS ({STATE_LOG_SQL}),
st AS (SELECT name, arg_max(gtid_seq, saved_at) AS saved FROM s
       WHERE saved_at < TIMESTAMP '{CRASH_AT}' GROUP BY name)
SELECT gtid_seq, pipeline FROM c
WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.name = c.pipeline AND c.gtid_seq BETWEEN 1 AND st.saved)
""")
def resume_filter_q(spark, sf_dir):
    """After a crash each pipeline resumes after its saved position."""
    from rowcast.operators.position import resume_filter
    out = resume_filter(_pipeline_log(spark, sf_dir), _states(spark, sf_dir, before=CRASH_AT))
    return out.select("gtid_seq", "pipeline")


@query("resume_foreign_uuid", f"""
WITH c AS ({PIPELINE_EVENTS_SQL}), s AS ({STATE_LOG_SQL}),
st AS (SELECT name, arg_max(gtid_seq, saved_at) AS saved FROM s
       WHERE saved_at < TIMESTAMP '{CRASH_AT}' GROUP BY name)
SELECT pipeline, count(*) AS replayed, pipeline = 'p2' AS foreign_state FROM c
WHERE pipeline = 'p2' OR NOT EXISTS (SELECT 1 FROM st WHERE st.name = c.pipeline AND c.gtid_seq BETWEEN 1 AND st.saved)
GROUP BY pipeline
""")
def resume_foreign_uuid(spark, sf_dir):
    """P5: a state from another server replays everything and is flagged foreign."""
    from rowcast.operators.position import check_ahead, resume_filter
    ev = _pipeline_log(spark, sf_dir)
    st = _states(spark, sf_dir, before=CRASH_AT, foreign="p2")
    replayed = resume_filter(ev, st).groupBy("pipeline").agg(F.count(F.lit(1)).alias("replayed"))
    flags = check_ahead(ev, st).groupBy(F.col("name").alias("pipeline")).agg(F.bool_or("foreign").alias("foreign_state"))
    return replayed.join(flags, "pipeline", "left").select("pipeline", "replayed", "foreign_state")


@query("state_ahead", f"""
WITH s AS ({STATE_LOG_SQL}),
st AS (SELECT name, arg_max(gtid_seq, saved_at) AS saved_seq FROM s GROUP BY name),
h AS (SELECT max(event_id + 1) AS head_seq FROM events WHERE ts < TIMESTAMP '{CRASH_AT}')
SELECT name, saved_seq, head_seq, saved_seq > head_seq AS ahead FROM st, h
""")
def state_ahead(spark, sf_dir):
    """Saved positions ahead of a restored source are flagged."""
    from rowcast.operators.position import check_ahead
    # the source was restored from a copy taken at CRASH_AT; the saved positions are newer
    restored = fx.chg_events(spark, sf_dir).filter(F.col("ts") < F.lit(CRASH_AT).cast("timestamp_ntz"))
    return check_ahead(restored, _states(spark, sf_dir)).select("name", "saved_seq", "head_seq", "ahead")


def islands_sql(rows: str) -> str:
    """GTID-set text per name over rows (name, uuid, seq): gaps and islands."""
    return f"""
SELECT name, string_agg(uuid || ':' || ivs, ',' ORDER BY uuid) AS gtid FROM (
  SELECT name, uuid, string_agg(CASE WHEN lo = hi THEN lo::VARCHAR ELSE lo || '-' || hi END, ':' ORDER BY lo) AS ivs FROM (
    SELECT name, uuid, min(seq) AS lo, max(seq) AS hi FROM (
      SELECT name, uuid, seq, seq - row_number() OVER (PARTITION BY name, uuid ORDER BY seq) AS grp
      FROM (SELECT DISTINCT name, uuid, seq FROM ({rows})))
    GROUP BY name, uuid, grp)
  GROUP BY name, uuid)
GROUP BY name"""


@query("state_from_batch", f"""
WITH c AS ({PIPELINE_EVENTS_SQL})
SELECT g.name, g.gtid, n.n_events
FROM ({islands_sql(f"SELECT pipeline AS name, '{fx.SOURCE_UUID}' AS uuid, gtid_seq AS seq FROM c")}) g
JOIN (SELECT pipeline AS name, count(*) AS n_events FROM c GROUP BY 1) n ON n.name = g.name
""")
def state_from_batch_q(spark, sf_dir):
    """The positions a batch saves per pipeline, dropped events included (Q21)."""
    from rowcast.operators.position import state_from_batch
    ev = build_events(_pipeline_log(spark, sf_dir), pipeline=F.col("pipeline"), timestamp=F.lit(0))
    st = state_from_batch(ev, F.col("meta.pipeline"), timestamp=F.lit(0))
    return st.select("name", "gtid", "n_events")


def _two_server_events(spark, sf_dir):
    """Events of three pipelines whose source moved to another server halfway
    (by user), in three batches that don't follow the source's order."""
    ev = fx.table(spark, sf_dir, "events")
    return ev.select(fx.pipeline_of(F.col("user_id")).alias("pipeline"),
                     F.when(F.col("user_id") % 7 < 4, F.upper(F.lit(fx.SOURCE_UUID))).otherwise(F.lit(fx.OTHER_UUID)).alias("gtid_uuid"),
                     (F.col("event_id") + 1).alias("gtid_seq"), F.col("event_id").alias("pos"),
                     F.when(F.expr("(event_id div 1000) % 3 = 1"), 1).when(F.expr("(event_id div 1000) % 3 = 0"), 2)
                     .otherwise(3).alias("batch"))


TWO_SERVER_SQL = f"""
SELECT CASE user_id % 3 WHEN 0 THEN 'p0' WHEN 1 THEN 'p1' ELSE 'p2' END AS name,
       CASE WHEN user_id % 7 < 4 THEN '{fx.SOURCE_UUID}' ELSE '{fx.OTHER_UUID}' END AS uuid, event_id + 1 AS seq,
       CASE (event_id // 1000) % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS batch
FROM events"""


def _merged_state(spark, sf_dir):
    """The state after batches 1 and 2, as bitmap rows: each save merges with the one before."""
    from rowcast.operators.position import state_bitmaps
    from rowcast.session import save_shared
    ev, state = _two_server_events(spark, sf_dir), None
    for n in (1, 2):
        state = save_shared(state_bitmaps(ev.filter(F.col("batch") == n), "pipeline", timestamp=F.lit(n), previous=state), "state")
    return ev, state


@query("state_merge", islands_sql(f"SELECT name, uuid, seq FROM ({TWO_SERVER_SQL}) WHERE batch <= 2"))
def state_merge(spark, sf_dir):
    """Two batches of two servers, the later part of the log first; nothing
    processed is forgotten and nothing else is claimed."""
    from rowcast.operators.position import state_text
    return state_text(_merged_state(spark, sf_dir)[1]).select("name", "gtid")


@query("resume_after_gap", f"SELECT name AS pipeline, uuid, seq AS gtid_seq FROM ({TWO_SERVER_SQL}) WHERE batch = 3")
def resume_after_gap(spark, sf_dir):
    """Resuming from that state processes exactly the batch that is missing."""
    from rowcast.operators.position import resume_filter
    ev, state = _merged_state(spark, sf_dir)
    out = resume_filter(ev, state, exact=True)
    return out.select("pipeline", F.lower("gtid_uuid").alias("uuid"), "gtid_seq")


@query("start_without_state", f"""
SELECT gtid_seq, pipeline FROM ({PIPELINE_EVENTS_SQL}) c
WHERE pipeline <> 'p1' OR gtid_seq > (SELECT max(event_id + 1) FROM events WHERE user_id % 3 = 1 AND ts = (
  SELECT max(ts) FROM events WHERE user_id % 3 = 1))
""")
def start_without_state(spark, sf_dir):
    """A pipeline without saved state reads the log from its beginning;
    one with state goes on after it."""
    from rowcast.operators.position import start_from
    log = _pipeline_log(spark, sf_dir)
    known = start_from(log.filter("pipeline = 'p1'"), _states(spark, sf_dir).filter("name = 'p1'"))
    fresh = start_from(log.filter("pipeline <> 'p1'"))
    return known.unionByName(fresh).select("gtid_seq", "pipeline")


@query("restart_without_checkpoint", f"SELECT gtid_seq, topic, key FROM ({ORACLES['sample_chain']})")
def restart_without_checkpoint(spark, sf_dir):
    """P1-P4, S4 on a stream: the checkpoint is lost between two parts of the log;
    the second query checks the saved state against the source, resumes from it
    and delivers what is missing, nothing twice."""
    from rowcast.session import shared_path
    from rowcast.sources.changelog import stream_log
    from rowcast.streaming.stream import start_pipeline
    base = shared_path(spark, "restart")
    log = fx.chg_events(spark, sf_dir)
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    for run, part in enumerate((F.col("ts") < F.lit(CRASH_AT).cast("timestamp_ntz"), F.col("ts") >= F.lit(CRASH_AT).cast("timestamp_ntz"))):
        log.filter(part).write.mode("append").parquet(f"{base}/log")
        q = start_pipeline(spec, stream_log(spark, f"{base}/log", log.schema, max_files_per_trigger=4), f"{base}/out",
                           f"{base}/checkpoint{run}", f"{base}/state", source=spark.read.schema(log.schema).parquet(f"{base}/log"))
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out").select("gtid_seq", "topic", "key")


@query("resume_exact", f"""
WITH r AS (SELECT * FROM ({STAMPED_SQL}) WHERE action IN ('insert', 'update', 'delete')),
d AS (SELECT * FROM r WHERE ts < TIMESTAMP '{CRASH_AT}' AND gtid_seq IS NOT NULL),
done AS (SELECT DISTINCT gtid_uuid AS u, gtid_seq AS q FROM d),
t AS (SELECT gtid_uuid AS tu, max(gtid_seq) AS ts_, arg_max(pos, gtid_seq * 1000000000 + pos) AS tp FROM d GROUP BY 1)
SELECT log_file, pos, gtid_seq FROM r LEFT JOIN done ON u = gtid_uuid AND q = gtid_seq LEFT JOIN t ON tu = gtid_uuid
WHERE u IS NULL OR (gtid_seq = ts_ AND pos > tp)
""")
def resume_exact(spark, sf_dir):
    """P1 + P3 at event granularity: the run stopped at CRASH_AT inside a
    transaction (row events share their GTID marker's number); resuming with
    ``exact=True`` processes exactly what had not been processed."""
    from rowcast.operators.position import resume_filter, state_from_batch
    from rowcast.sources.changelog import row_events_only, stamp_gtid
    rows = row_events_only(stamp_gtid(fx.chg_binlog(spark, sf_dir))).select(
        "log_file", "pos", "gtid_uuid", "gtid_seq", "ts", F.lit("p1").alias("pipeline"))
    done = rows.filter(F.col("ts") < F.lit(CRASH_AT).cast("timestamp_ntz"))
    states = state_from_batch(done, "pipeline", timestamp=F.lit(0))
    return resume_filter(rows, states, exact=True).select("log_file", "pos", "gtid_seq")


# ---------------------------------------------------------------- delivery

@query("dedupe", f"""
WITH c AS ({PIPELINE_EVENTS_SQL}), s AS ({STATE_LOG_SQL}),
st AS (SELECT name, arg_max(gtid_seq, saved_at) AS saved FROM s
       WHERE saved_at < TIMESTAMP '{CRASH_AT}' GROUP BY name)
SELECT gtid_seq, pipeline,
       1 + (NOT EXISTS (SELECT 1 FROM st WHERE st.name = c.pipeline AND c.gtid_seq <= st.saved))::BIGINT AS copies
FROM c
""")
def dedupe_q(spark, sf_dir):
    """At-least-once replays after a crash collapse to one record per position."""
    from rowcast.operators.delivery import dedupe
    from rowcast.operators.position import resume_filter
    log = _pipeline_log(spark, sf_dir)
    spec = PipelineSpec(name="p1", pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    first = run_events(spec, log)
    # after the crash every pipeline resumed from its saved position and re-sent what followed
    replay = resume_filter(first, _states(spark, sf_dir, before=CRASH_AT))
    both = first.unionByName(replay)
    delivered = both.select("gtid_uuid", "gtid_seq", "pos", "pipeline", payload(both).alias("value"))
    return dedupe(delivered, copies="copies").select("gtid_seq", "pipeline", "copies")


@query("dedupe_many_pipelines", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT pipeline, gtid_seq, 2::BIGINT AS copies FROM c, (VALUES ('a'), ('b'), ('c')) v(pipeline)
""")
def dedupe_many_pipelines(spark, sf_dir):
    """P7 + P9: three pipelines over one log, all delivered twice: each keeps its own records."""
    from rowcast.operators.delivery import dedupe
    from rowcast.plans.pipeline import run_many
    specs = [PipelineSpec(name=n, pk=["user_id"], timestamp=F.lit(0)) for n in ("a", "b", "c")]
    recs = run_many(specs, fx.chg_events(spark, sf_dir))
    return dedupe(recs.unionByName(recs), copies="copies").select("pipeline", "gtid_seq", "copies")


@query("dedupe_stream_exact", f"SELECT gtid_seq, schema_name || '.' || table_name AS topic FROM ({CHG_EVENTS_SQL})")
def dedupe_stream_exact(spark, sf_dir):
    """P7 on a stream without a watermark: the whole log is delivered again after
    it was processed, however old; every record comes out once."""
    from rowcast.session import shared_path
    from rowcast.streaming.dedupe import dedupe_exact_stream
    log = fx.chg_events(spark, sf_dir)
    again = F.lit(True)
    def records(s):
        ev = build_events(s, pipeline="p1", timestamp=F.lit(0), pk=["user_id"])
        return dedupe_exact_stream(ev.select(F.col("meta.pipeline").alias("pipeline"), "gtid_uuid", "pos", "gtid_seq",
                                             F.col("kafka.topic").alias("topic"))).select("gtid_seq", "topic")
    return _streamed(spark, shared_path(spark, "dedupe_exact"), log, records, [*_thirds(spark, sf_dir), again])


@query("fanout_segments", f"SELECT topic, gtid_seq, key, value FROM ({ORACLES['sample_chain']})")
def fanout_segments(spark, sf_dir):
    """K1: the sample pipeline as a stream into per-topic segments that a manifest
    commits; readers follow the manifest."""
    from rowcast.session import shared_path
    from rowcast.sinks.segments import read_segments, write_segments
    from rowcast.sources.changelog import stream_log
    base = shared_path(spark, "fanout_segments")
    log = fx.chg_events(spark, sf_dir)
    log.write.parquet(f"{base}/log")
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    recs = run_batch(spec, stream_log(spark, f"{base}/log", log.schema, max_files_per_trigger=4)).select("topic", "key", "value", "gtid_seq", "pos")
    q = write_segments(recs, f"{base}/out", f"{base}/checkpoint", segment_bytes=1 << 18)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return read_segments(spark, f"{base}/out", "topic string, key string, value string, gtid_seq bigint, pos bigint").drop("pos")


@query("per_key_order", f"""
WITH r AS ({ORACLES['sample_chain']})
SELECT topic, key, gtid_seq, row_number() OVER (PARTITION BY topic, key ORDER BY gtid_seq) AS seq_in_key FROM r
""")
def per_key_order(spark, sf_dir):
    """Records numbered per (topic, key) in source order."""
    from rowcast.operators.delivery import sequence_in_key
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    recs = run_batch(spec, fx.chg_events(spark, sf_dir))
    return sequence_in_key(recs).select("topic", "key", "gtid_seq", "seq_in_key")


@query("multi_spec_union", f"""
WITH c AS ({CHG_EVENTS_SQL}),
g AS (SELECT *, {GUARD_SQL} AS g, CASE WHEN action <> 'delete' THEN text_col END AS t FROM c),
a AS (SELECT 'sample' AS pipeline, gtid_seq,
             CASE WHEN g AND coalesce(t = 'change-kafka', false) THEN 'another-topic'
                  ELSE schema_name || '.' || table_name END AS topic,
             CASE WHEN g AND coalesce(t = 'change-kafka', false) THEN 'another-msg-key'
                  ELSE user_id::VARCHAR END AS key
      FROM g WHERE NOT (g AND coalesce(t = 'ignore', false))
        AND NOT (regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1'))),
b AS (SELECT 'plain' AS pipeline, gtid_seq, schema_name || '.' || table_name AS topic,
             schema_name || '.' || table_name AS key FROM g),
k AS (SELECT 'keep' AS pipeline, gtid_seq, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key
      FROM g WHERE NOT g OR coalesce(t = 'should-continue', false))
SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM k
""")
def multi_spec_union(spark, sf_dir):
    """Three independent pipelines over one log, as one job."""
    from rowcast.plans.pipeline import run_many
    log = fx.chg_events(spark, sf_dir)
    specs = [
        PipelineSpec(name="sample", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.lit(0)),
        PipelineSpec(name="plain", rules=[samples.empty_rule()], pk=[], timestamp=F.lit(0)),
        PipelineSpec(name="keep", rules=[samples.keep_should_continue_rule()], pk=["user_id"], timestamp=F.lit(0)),
    ]
    return run_many(specs, log).select("pipeline", "gtid_seq", "topic", "key")


MANY = 20


def _many_filter(k: int) -> SourceFilter | None:
    """Pipeline k of many: a third of them takes all tables."""
    return (None, SourceFilter(include_schemas=["^test_", "^audit_"]), SourceFilter(exclude_tables=["entity_1"]))[k % 3]


@query("many_pipelines", f"""
WITH c AS ({CHG_EVENTS_SQL}),
e AS (SELECT *, CASE WHEN action <> 'delete' THEN text_col END AS t FROM c)
SELECT 'p' || k AS pipeline, gtid_seq, schema_name || '.' || table_name || '.' || k AS topic,
       CASE WHEN k % 2 = 0 THEN user_id::VARCHAR ELSE schema_name || '.' || table_name END AS key
FROM e, range({MANY}) r(k)
WHERE (k % 3 = 0 OR (k % 3 = 1 AND regexp_matches(schema_name, '^test_|^audit_')) OR (k % 3 = 2 AND table_name <> 'entity_1'))
  AND NOT (k % 4 = 1 AND coalesce(t = 'ignore', false))
""")
def many_pipelines(spark, sf_dir):
    """Twenty pipelines with their own filters, keys and rules over one scan."""
    from rowcast.plans.pipeline import run_many
    drop = Rule("drop", "", "", verdict=F.when(RF.any_row_eq("after", "text_col", "ignore"), 1).otherwise(0))
    specs = [PipelineSpec(
        name=f"p{k}", source_filter=_many_filter(k), pk=["user_id"] if k % 2 == 0 else [], timestamp=F.lit(0),
        rules=[*([drop] if k % 4 == 1 else []),
               Rule("topic", set={"kafka.topic": F.concat(F.col("kafka.topic"), F.lit(f".{k}"))})]) for k in range(MANY)]
    return run_many(specs, fx.chg_events(spark, sf_dir)).select("pipeline", "gtid_seq", "topic", "key")


def matrix_rules(n: int = 200) -> list[Rule]:
    """Rules of a source with many tables, most of which this log doesn't have."""
    return [Rule(f"r{i}", match_schema="^(test|tenant)_", match_table=f"^entity_{1 if i % 20 == 0 else 1000 + i}$",
                 set={"kafka.topic": F.concat(F.col("kafka.topic"), F.lit(f".r{i}"))}) for i in range(n)]


@query("guard_matrix", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, schema_name || '.' || table_name ||
       CASE WHEN regexp_matches(schema_name, '^(test|tenant)_') AND table_name = 'entity_1'
            THEN '.r0.r20.r40.r60.r80.r100.r120.r140.r160.r180' ELSE '' END AS topic
FROM c
""")
def guard_matrix(spark, sf_dir):
    """200 guarded rules; their guards are evaluated once per table."""
    spec = PipelineSpec(name="p1", rules=matrix_rules(), pk=["user_id"], timestamp=F.lit(0), guard_matrix=True)
    return run_batch(spec, fx.chg_events(spark, sf_dir)).select("gtid_seq", "topic")


SINK_TIME = "2024-02-01 00:00:00"


@query("delivery_latency", f"""
WITH c AS ({CHG_EVENTS_SQL}),
l AS (SELECT schema_name || '.' || table_name AS topic,
             epoch_us(TIMESTAMP '{SINK_TIME}') - epoch_us(ts) AS lat FROM c)
SELECT topic, count(*) AS n, sum(lat)::BIGINT AS sum_latency_us, min(lat) AS min_latency_us,
       max(lat) AS max_latency_us, (sum(lat) // count(*))::BIGINT AS avg_latency_us,
       min(lat) FILTER (rk >= ceil(0.99 * n_)) AS p99_latency_us
FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY lat) AS rk, count(*) OVER (PARTITION BY topic) AS n_ FROM l)
GROUP BY topic
""")
def delivery_latency(spark, sf_dir):
    """P10: delivery delay per topic against a fixed sink time."""
    from rowcast.operators.delivery import latency_by_topic
    ev = build_events(fx.chg_events(spark, sf_dir), pipeline="p1",
                      timestamp=F.unix_micros(F.col("ts").cast("timestamp")))
    sink = F.unix_micros(F.lit(SINK_TIME).cast("timestamp"))
    recs = encode(ev.withColumn("event_us", F.col("meta.timestamp")), keep=("event_us",))
    return latency_by_topic(recs, sink, event_time_us=F.col("event_us"))


@query("latency_quantiles", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT schema_name || '.' || table_name AS topic, count(*) AS n, max(epoch_us(TIMESTAMP '{SINK_TIME}') - epoch_us(ts)) AS max_latency_us,
       true AS p50_within, true AS p99_within
FROM c GROUP BY 1
""")
def latency_quantiles(spark, sf_dir):
    """P10: sketches of ten parts of a log, merged; their quantiles' true ranks lie
    within the stated error."""
    from rowcast.operators.delivery import RANK_ERROR, latency_sketches, merged_sketches
    from rowcast.session import save_shared
    ev = _events(spark, sf_dir)
    delay = F.unix_micros(F.lit(SINK_TIME).cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    recs = ev.select(F.col("kafka.topic").alias("topic"), delay.alias("delay"), (F.col("gtid_seq") % 10).alias("part"))
    saved = save_shared(latency_sketches(recs, F.col("delay"), ["topic", "part"]), "sketches")
    got = merged_sketches(saved)
    below = recs.join(got.select("topic", "n", "max_latency_us", "p50_latency_us", "p99_latency_us"), "topic")
    out = below.groupBy("topic").agg(F.first("n").alias("n"), F.first("max_latency_us").alias("max_latency_us"), *[
        F.struct(F.avg((F.col("delay") < F.col(f"{p}_latency_us")).cast("int")).alias("lo"),
                 F.avg((F.col("delay") <= F.col(f"{p}_latency_us")).cast("int")).alias("hi")).alias(p) for p in ("p50", "p99")])
    near = [((F.col(f"{p}.lo") <= q + RANK_ERROR) & (F.col(f"{p}.hi") >= q - RANK_ERROR)).alias(f"{p}_within") for p, q in (("p50", 0.5), ("p99", 0.99))]
    return out.select("topic", "n", "max_latency_us", *near)


@query("enrich_as_of", f"""
WITH c AS ({CHG_EVENTS_SQL}),
d AS (SELECT user_id, event_id AS since, round(value * 100)::BIGINT AS plan FROM events WHERE event_type = 'signup')
SELECT c.gtid_seq, d.since, d.plan FROM c ASOF LEFT JOIN d ON c.user_id = d.user_id AND c.event_id >= d.since
""")
def enrich_as_of_q(spark, sf_dir):
    """M8 at a point in time: every event with its user's last signup at or before it."""
    from rowcast.operators.delivery import enrich_as_of
    versions = fx.table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.col("user_id").alias("who"), F.col("event_id").alias("since"), F.round(F.col("value") * 100).cast("bigint").alias("plan"))
    ev = _events(spark, sf_dir).withColumn("at", F.col("gtid_seq") - 1)
    out = enrich_as_of(ev, versions, (F.get(F.coalesce("after", "before"), 0)["user_id"], "who"), ("at", "since"), ["since", "plan"], width=4096)
    return out.select("gtid_seq", "since", "plan")


@query("enrich_join", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT c.gtid_seq,
  to_json(CASE WHEN action <> 'delete' THEN [{{'c_mktsegment': cu.c_mktsegment, 'c_name': cu.c_name,
     'event_id': event_id, 'text_col': text_col, 'user_id': user_id, 'value': value}}] END)::VARCHAR AS after_json
FROM c LEFT JOIN customer cu ON cu.c_custkey = c.user_id
""")
def enrich_join(spark, sf_dir):
    """M8: every after row gains customer columns (explode, join, regroup)."""
    from rowcast.operators.delivery import enrich_rows
    ev = _events(spark, sf_dir)
    cust = fx.table(spark, sf_dir, "customer")
    out = enrich_rows(ev, "after", cust, on=("user_id", "c_custkey"), fields=["c_mktsegment", "c_name"])
    return out.select("gtid_seq", image_json("after").alias("after_json"))


@query("enrich_duplicate_dim", f"""
WITH c AS ({CHG_EVENTS_SQL}),
p AS (SELECT DISTINCT pipeline FROM (VALUES ('a'), ('b')) v(pipeline)),
d AS (SELECT DISTINCT user_id AS k, event_type FROM events)
SELECT p.pipeline, c.gtid_seq, count(*) AS rows_after, string_agg(d.event_type, ',' ORDER BY d.event_type) AS types
FROM c CROSS JOIN p LEFT JOIN d ON d.k = c.user_id WHERE action <> 'delete' GROUP BY 1, 2
""")
def enrich_duplicate_dim(spark, sf_dir):
    """M8: a dimension with several rows per key, two pipelines over one log: a
    plain left join per image row, and no event is merged with another's."""
    from rowcast.operators.delivery import enrich_rows
    dim = fx.table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    ev = _events(spark, sf_dir, pipeline="a").unionByName(_events(spark, sf_dir, pipeline="b")).filter("action <> 'delete'")
    out = enrich_rows(ev, "after", dim.withColumnRenamed("user_id", "k"), on=("user_id", "k"), fields=["event_type"])
    types = F.array_sort(F.transform("after", lambda r: r["event_type"]))
    return out.select(F.col("meta.pipeline").alias("pipeline"), "gtid_seq", F.size("after").cast("bigint").alias("rows_after"),
                      F.array_join(types, ",").alias("types"))


@query("enrich_event_join", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT c.gtid_seq, cu.c_name, cu.c_nationkey FROM c LEFT JOIN customer cu ON cu.c_custkey = c.user_id
""")
def enrich_event_join(spark, sf_dir):
    """M8 at event level: the customer of the event's first image row."""
    from rowcast.operators.delivery import enrich_event
    ev = _events(spark, sf_dir)
    img = F.coalesce(RF.first_row("after"), RF.first_row("before"))
    out = enrich_event(ev, fx.table(spark, sf_dir, "customer"), on=(img["user_id"], "c_custkey"),
                       fields=["c_name", "c_nationkey"])
    return out.select("gtid_seq", "c_name", "c_nationkey")


@query("source_query", """
SELECT o_orderstatus, count(*) AS n_orders, max(o_orderkey) AS max_orderkey
FROM orders GROUP BY o_orderstatus
""")
def source_query_q(spark, sf_dir):
    """SQL run against the source tables."""
    from rowcast.sources.changelog import register_tables, source_query
    register_tables(spark, sf_dir, ["orders"])
    return source_query(spark, ORACLES["source_query"])


# ---------------------------------------------------------------- user code

def keep_should_continue(event: dict) -> int:
    """The upstream ``simple_test_transform`` script as a Python function."""
    after = event.get("after")
    text = after[0].get("text_col") if after else None
    return ACTION_CONT if text == "should-continue" else ACTION_DROP


@query("python_rule", ORACLES["rule_keep_first_row"])
def python_rule(spark, sf_dir):
    """The keep-should-continue rule as a Python function."""
    from rowcast.operators.pyrule import PythonRule
    rule = PythonRule("generic-test-1", "test_.*", "test_.*", keep_should_continue)
    spec = PipelineSpec(name="p1", rules=[rule], pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    out = run_events(spec, fx.chg_events(spark, sf_dir))
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"),
                      RF.first_row("after")["text_col"].alias("after_text"))


@query("python_sample_chain", ORACLES["sample_chain"])
def python_sample_chain(spark, sf_dir):
    """The flagship chain with both rules as Python functions (mapInPandas)."""
    spec = PipelineSpec(name="p1", rules=samples.sample_python_rules(), pk=["user_id"],
                        timestamp=F.col("gtid_seq") * 1000)
    return run_batch(spec, fx.chg_events(spark, sf_dir)).select("gtid_seq", "topic", "key", "value")


def leave_alone(event: dict) -> int:
    """A Python rule body that changes nothing."""
    return ACTION_CONT


@query("python_identity_rule", f"SELECT gtid_seq, image AS typed_json FROM ({TYPE_TABLE_SQL})")
def python_identity_rule(spark, sf_dir):
    """An event that a Python rule looks at but doesn't change is delivered
    with every value as it came (microseconds, decimals, bytes)."""
    from rowcast.operators.pyrule import PythonRule
    from rowcast.plans.pipeline import apply_chain
    ev = apply_chain(type_events(spark, sf_dir), [PythonRule("look", "", "", leave_alone)])
    return encode(ev).select("gtid_seq", F.regexp_extract("value", r'"after":(\[.*\]),"meta"', 1).alias("typed_json"))


def shout(text):
    """A vectorised helper: upper case with a mark."""
    return text.str.upper() + "!"


@query("helper_rule", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, CASE WHEN action <> 'delete' THEN upper(text_col) || '!' END AS shouted,
       CASE WHEN action <> 'delete' THEN length(text_col)::INTEGER END AS js_length,
       CASE WHEN action = 'delete' THEN 'none' ELSE '****' END AS topic
FROM c
""")
def helper_rule(spark, sf_dir):
    """Rules call helpers by name: built-in, SQL and registered Python ones."""
    RF.register_pandas_helper(spark, "shout", shout, "string")
    RF.register_sql_helpers(spark)
    text = RF.first_row("after")["text_col"]
    topic = F.when(F.col("action") == "delete", "none").otherwise(RF.helper("obfuscate")(text))
    out = apply_rules(_events(spark, sf_dir), [Rule("helpers", set={"kafka.topic": topic})])
    out = out.withColumn("text", text)
    return out.select("gtid_seq", RF.helper("shout")("text").alias("shouted"), F.expr("js_length(text)").alias("js_length"),
                      F.col("kafka.topic").alias("topic"))


@query("stateful_rule", f"""
WITH c AS ({CHG_EVENTS_SQL}),
k AS (SELECT gtid_seq, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key,
             round(value * 100)::BIGINT AS cents FROM c)
SELECT gtid_seq, topic, key,
       row_number() OVER (PARTITION BY topic, key ORDER BY gtid_seq) AS seen,
       (sum(cents) OVER (PARTITION BY topic, key ORDER BY gtid_seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS running_cents
FROM k
""")
def stateful_rule(spark, sf_dir):
    """U3 in batch: per-key count and running total in source order (bucketed windows)."""
    from rowcast.streaming.stateful import running_totals
    recs = encode(_events(spark, sf_dir))
    img = F.coalesce(F.get_json_object("value", "$.after[0].value"), F.get_json_object("value", "$.before[0].value"))
    recs = recs.withColumn("cents", F.round(img.cast("double") * 100).cast("bigint"))
    out = running_totals(recs, ["topic", "key"], "cents", sum_name="running_cents")
    return out.select("gtid_seq", "topic", "key", "seen", F.col("running_cents").cast("bigint").alias("running_cents"))


def count_and_total(event: dict, state: dict) -> int:
    """Stateful rule body: events seen and running total of value (in cents) per key."""
    img = (event.get("after") or event.get("before") or [{}])[0]
    state["seen"] = state.get("seen", 0) + 1
    state["running_cents"] = state.get("running_cents", 0) + round((img.get("value") or 0) * 100)
    return ACTION_CONT


def hold_back_repeats(event: dict, state: dict) -> int:
    """Stateful rule body whose result depends on the order: numbers a key's
    events, notes the previous value and drops every third one."""
    img = (event.get("after") or event.get("before") or [{}])[0]
    cents = round((img.get("value") or 0) * 100)
    state["seen"] = state.get("seen", 0) + 1
    state["change"] = cents - state.get("last", cents)
    state["last"] = cents
    event["kafka"]["key"] = f"{event['kafka']['key']}#{state['seen']}"
    return ACTION_DROP if state["seen"] % 3 == 0 else ACTION_CONT


STATEFUL_SQL = f"""
WITH c AS ({CHG_EVENTS_SQL}),
k AS (SELECT gtid_seq, schema_name || '.' || table_name AS topic, user_id::VARCHAR AS key,
             round(value * 100)::BIGINT AS cents, {GUARD_SQL} AS g FROM c),
n AS (SELECT *, row_number() OVER w AS seen, cents - coalesce(lag(cents) OVER w, cents) AS change
      FROM k WHERE g WINDOW w AS (PARTITION BY topic, key ORDER BY gtid_seq))
SELECT gtid_seq, topic, key || '#' || seen AS key, seen, change FROM n WHERE seen % 3 <> 0
UNION ALL SELECT gtid_seq, topic, key, NULL, NULL FROM k WHERE NOT g
"""


def _state_rule():
    from rowcast.streaming.stateful import StatefulRule
    return StatefulRule("repeats", ["kafka.topic", "kafka.key"], hold_back_repeats, [("seen", "bigint"), ("change", "bigint")],
                        match_schema="test_.*", match_table="test_.*")


@query("stateful_chain", STATEFUL_SQL)
def stateful_chain(spark, sf_dir):
    """U3 in a rule chain: guard, verdict, edits and order of a stateful rule
    between expression rules."""
    from rowcast.plans.pipeline import apply_chain
    rules = [samples.empty_rule(), _state_rule(), samples.empty_rule()]
    out = apply_chain(_events(spark, sf_dir), rules)
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"), "seen", "change")


@query("stateful_stream", STATEFUL_SQL)
def stateful_stream(spark, sf_dir):
    """U3 on a stream: the same rule keeps its state in the state store across
    micro-batches.  The log is written in source order, a third after the other,
    so its files reach the state in source order; one row per event comes out."""
    from rowcast.session import shared_path
    from rowcast.sources.changelog import stream_log
    from rowcast.plans.pipeline import finished
    from rowcast.streaming.stream import events_stream
    base = shared_path(spark, "stateful_stream")
    log = fx.chg_events(spark, sf_dir)
    spec = PipelineSpec(name="p1", rules=[_state_rule()], pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    last = fx.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    for part in range(3):  # each part is one arrival: whatever files it has, the next one's are newer
        low, high = part * (last // 3 + 1), (part + 1) * (last // 3 + 1)
        log.filter(F.col("pos").between(low, high - 1)).write.mode("append").parquet(f"{base}/log")
        ev = finished(events_stream(spec, stream_log(spark, f"{base}/log", log.schema)))
        q = (ev.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"), "seen", "change")
             .writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


@query("window_rule_chain", STATEFUL_SQL)
def window_rule_chain(spark, sf_dir):
    """U3 as expressions: the same rule with a running number and the previous
    value, cut by position, so that a hot key is no single task."""
    from rowcast.plans.pipeline import apply_chain
    from rowcast.streaming.stateful import WindowRule
    cents = "cast(round(coalesce(get(coalesce(after, before), 0).value, 0) * 100) as bigint)"
    rule = WindowRule("repeats", ["kafka.topic", "kafka.key"], number="seen", sums={}, lags={"previous": cents}, maxes={"now": cents},
                      verdict=F.when(F.col("seen") % 3 == 0, ACTION_DROP).otherwise(ACTION_CONT),
                      set={"kafka.key": F.concat("kafka.key", F.lit("#"), F.col("seen").cast("string"))},
                      match_schema="test_.*", match_table="test_.*")
    ev = _events(spark, sf_dir).withColumn("cents", F.expr(cents))
    out = apply_chain(ev, [samples.empty_rule(), rule, samples.empty_rule()])
    change = F.when(F.col("seen").isNotNull(), F.col("cents") - F.coalesce("previous", "cents"))
    return out.select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"), "seen", change.alias("change"))


def _streamed(spark, base, log, build, parts, order="pos", **write):
    """Write ``log`` in parts and run ``build(stream)`` over each as it arrives."""
    from rowcast.sources.changelog import stream_log
    for part in parts:
        log.filter(part).write.mode("append").parquet(f"{base}/log")
        q = (build(stream_log(spark, f"{base}/log", log.schema)).writeStream.format("parquet").option("path", f"{base}/out")
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return spark.read.parquet(f"{base}/out")


def _thirds(spark, sf_dir):
    last = fx.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] or 0
    return [F.col("pos").between(k * (last // 3 + 1), (k + 1) * (last // 3 + 1) - 1) for k in range(3)]


def raise_odd_keys(event: dict) -> int:
    """Python rule body: events of odd users go to a topic of their own."""
    if int(event["kafka"]["key"]) % 2:
        event["kafka"]["topic"] += ".odd"
    return ACTION_CONT


@query("python_then_stateful", STATEFUL_SQL.replace("schema_name || '.' || table_name AS topic",
                                                    "schema_name || '.' || table_name || CASE WHEN user_id % 2 = 1 THEN '.odd' ELSE '' END AS topic"))
def python_then_stateful(spark, sf_dir):
    """U1 before U3 on a stream: a Python rule changes the topic that the stateful
    rule keeps its state by."""
    from rowcast.operators.pyrule import PythonRule
    from rowcast.plans.pipeline import finished
    from rowcast.session import shared_path
    from rowcast.streaming.stream import events_stream
    spec = PipelineSpec(name="p1", rules=[PythonRule("odd", "", "", raise_odd_keys), _state_rule()], pk=["user_id"],
                        timestamp=F.col("gtid_seq") * 1000)
    return _streamed(spark, shared_path(spark, "python_then_stateful"), fx.chg_events(spark, sf_dir), lambda s: finished(
        events_stream(spec, s)).select("gtid_seq", F.col("kafka.topic").alias("topic"), F.col("kafka.key").alias("key"), "seen", "change"),
        _thirds(spark, sf_dir))


def number_from_start(event: dict, state: dict) -> int:
    """Stateful rule body: numbers a key's events on from what it starts with."""
    state["seen"] = state.get("seen", 0) + 1
    return ACTION_CONT


@query("stateful_stream_ttl", f"""
WITH c AS ({CHG_EVENTS_SQL}),
h AS (SELECT user_id, count(*) AS before FROM events GROUP BY user_id)
SELECT gtid_seq, user_id::VARCHAR AS key,
       before + row_number() OVER (PARTITION BY user_id, schema_name, table_name ORDER BY gtid_seq) AS seen
FROM c JOIN h USING (user_id)
""")
def stateful_stream_ttl(spark, sf_dir):
    """U3 with a TTL and a start from a batch frame: every key's number goes on
    from its count in an earlier table; names idle for a day are forgotten."""
    from rowcast.plans.pipeline import finished
    from rowcast.session import shared_path
    from rowcast.streaming.stateful import StatefulRule
    from rowcast.streaming.stream import events_stream
    start = fx.table(spark, sf_dir, "events").groupBy(F.col("user_id").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("seen"))
    rule = StatefulRule("number", ["kafka.key"], number_from_start, [("seen", "bigint")], ttl="24 hours", initial=start)
    spec = PipelineSpec(name="p1", rules=[rule], pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    try:
        return _streamed(spark, shared_path(spark, "stateful_stream_ttl"), fx.chg_events(spark, sf_dir), lambda s: finished(
            events_stream(spec, s)).select("gtid_seq", F.col("kafka.key").alias("key"), "seen"), _thirds(spark, sf_dir))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


# ---------------------------------------------------------------- audit and table versions

@query("drop_audit", f"""
WITH c AS ({CHG_EVENTS_SQL}),
e AS (SELECT *, {GUARD_SQL} AS g, CASE WHEN action <> 'delete' THEN text_col END AS t FROM c)
SELECT CASE WHEN g AND coalesce(t = 'ignore', false) THEN 'generic'
            WHEN regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1') THEN 'another-rule'
            ELSE 'delivered' END AS outcome,
       count(*) AS n
FROM e GROUP BY 1
""")
def drop_audit(spark, sf_dir):
    """Events in, dropped per rule and delivered, for the flagship rules (P10)."""
    from rowcast.operators.rules import verdicts
    v = verdicts(_events(spark, sf_dir), samples.sample_rules())
    return (v.groupBy(F.coalesce("_dropped_by", F.lit("delivered")).alias("outcome"))
            .agg(F.count(F.lit(1)).alias("n")))


@query("image_versions", f"""
WITH c AS ({CHG_EVENTS_SQL})
SELECT gtid_seq, to_json(CASE WHEN action <> 'delete' THEN [{{'event_id': event_id,
     'text_col': CASE WHEN ts < TIMESTAMP '{CRASH_AT}' THEN NULL ELSE text_col END,
     'user_id': user_id, 'value': value}}] END)::VARCHAR AS after_json
FROM c
""")
def image_versions(spark, sf_dir):
    """A table that gained ``text_col`` at CRASH_AT: the old log (images
    without it) and the new log union after the old images are evolved."""
    from rowcast.sources.changelog import evolve_rows
    log = fx.chg_events(spark, sf_dir)
    cut = F.col("ts") < F.lit(CRASH_AT).cast("timestamp_ntz")
    old = log.filter(cut).withColumn("rows", RF.drop_fields("rows", "text_col"))
    new = log.filter(~cut)
    both = evolve_rows(old, new.schema["rows"].dataType.elementType).unionByName(new)
    ev = build_events(both, pipeline="p1", timestamp=F.lit(0))
    return ev.select("gtid_seq", image_json("after").alias("after_json"))


# ---------------------------------------------------------------- mixed layout (many tables, one frame)

REGION_PAYLOAD_SQL = """
SELECT (r_regionkey + 1)::BIGINT AS gtid_seq, 'ref_db.region' AS topic, 'ref_db.region' AS key,
  to_json({'schema': 'ref_db', 'table': 'region', 'action': 'insert', 'before': NULL,
           'after': [{'r_name': r_name, 'r_regionkey': r_regionkey}],
           'meta': {'timestamp': (r_regionkey + 1)::BIGINT * 1000, 'pipeline': 'p1'},
           'kafka': {'topic': 'ref_db.region', 'key': 'ref_db.region'}})::VARCHAR AS value
FROM region
"""


@query("mixed_sample_chain", f"""
SELECT * FROM ({ORACLES['sample_chain']}) UNION ALL {REGION_PAYLOAD_SQL}
""")
def mixed_sample_chain(spark, sf_dir):
    """Two tables of different shapes in one frame (``map<string, variant>``
    images, per-row key columns) through the flagship rules."""
    from rowcast.operators.mixed import union_logs
    log = union_logs([fx.chg_events(spark, sf_dir), fx.chg_region(spark, sf_dir)])
    spec = PipelineSpec(name="p1", rules=samples.sample_rules_mixed(), timestamp=F.col("gtid_seq") * 1000)
    return run_batch(spec, log).select("gtid_seq", "topic", "key", "value")


# ---------------------------------------------------------------- streaming (S1, K1, P1 on a stream)

@query("topic_fanout", f"""
WITH c AS ({CHG_EVENTS_SQL}),
e AS (SELECT *, {GUARD_SQL} AS g, CASE WHEN action <> 'delete' THEN text_col END AS t FROM c)
SELECT CASE WHEN g AND coalesce(t = 'change-kafka', false) THEN 'another-topic'
            ELSE schema_name || '.' || table_name END AS topic, count(*) AS n
FROM e
WHERE NOT (g AND coalesce(t = 'ignore', false))
  AND NOT (regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1'))
GROUP BY 1
""")
def topic_fanout(spark, sf_dir):
    """K1 in batch: records written to one folder per topic (in per-key
    order), read back and counted per topic."""
    from rowcast.session import shared_path
    from rowcast.sinks.fanout import write_topics
    base = shared_path(spark, "topic_fanout")
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    write_topics(run_batch(spec, fx.chg_events(spark, sf_dir)), base)
    return spark.read.parquet(base).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("topic_counts", f"""
WITH c AS ({CHG_EVENTS_SQL}),
e AS (SELECT *, {GUARD_SQL} AS g, CASE WHEN action <> 'delete' THEN text_col END AS t FROM c)
SELECT CASE WHEN g AND coalesce(t = 'change-kafka', false) THEN 'another-topic'
            ELSE schema_name || '.' || table_name END AS topic, count(*) AS n
FROM e
WHERE NOT (g AND coalesce(t = 'ignore', false))
  AND NOT (regexp_matches(schema_name, 'tenant_.*') AND regexp_matches(table_name, 'entity_1'))
GROUP BY 1
""")
def topic_counts(spark, sf_dir):
    """The sample pipeline as a streaming query (``availableNow``) over the
    change log written as files; returns records per delivered topic."""
    from rowcast.session import shared_path
    from rowcast.sources.changelog import stream_log
    from rowcast.streaming.stream import start_pipeline
    base = shared_path(spark, "topic_counts")
    log = fx.chg_events(spark, sf_dir)
    log.write.parquet(f"{base}/log")
    stream = stream_log(spark, f"{base}/log", log.schema, max_files_per_trigger=4)
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    q = start_pipeline(spec, stream, f"{base}/out", f"{base}/checkpoint", f"{base}/state")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    out = spark.read.option("basePath", f"{base}/out").parquet(f"{base}/out")
    return out.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
