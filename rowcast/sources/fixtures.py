"""Change logs derived from the driver's tables.

Each builder reads whole tables and returns a raw change log in the input
contract of :func:`rowcast.operators.envelope.build_events`::

    schema, table, action, rows array<struct>, pk_columns array<string>,
    gtid_uuid, gtid_seq, pos, [extra carried columns]

Image structs are built with their fields in name order, as the encoded JSON
object has its keys sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators.ordered import DEFAULT_BUCKET_WIDTH, keyed_lag

# Fixed values shared with the oracle SQL.
SOURCE_UUID = "fa632d10-864b-11ed-843e-0242c0a86002"
OTHER_UUID = "3e11fa47-71ca-11e1-9e33-c80aa9429562"
PIPELINES = ("p0", "p1", "p2")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: Sequence[tuple], default) -> Column:
    out = None
    for k, v in mapping:
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out.otherwise(default if isinstance(default, Column) else F.lit(default))


def events_columns(ev: DataFrame) -> DataFrame:
    """The per-event derived columns of the ``chg_events`` log (no images yet)."""
    return ev.select(
        (F.col("event_id") + 1).alias("gtid_seq"),
        _case(F.col("user_id") % 3, [(0, "test_shop"), (1, "tenant_shop")], "audit_db").alias("schema"),
        _case(F.col("user_id") % 2, [(0, "test_events")], "entity_1").alias("table"),
        _case(F.col("event_type"), [("signup", "insert"), ("error", "delete")], "update").alias("action"),
        "event_id", "user_id", "value", "ts",
        F.when(F.col("value") < 10, "ignore")
         .when(F.col("value") < 20, "change-kafka")
         .when(F.col("value") < 30, "should-continue")
         .when(F.col("value") < 40, "abc")
         .when(F.col("value") < 50, F.lit(None))
         .otherwise(F.col("event_type")).alias("text_col"),
    )


def chg_events(spark: SparkSession, sf_dir: str, pk: Sequence[str] = ("user_id",),
               width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Mixed actions over six (schema, table) pairs, one row per event.

    Updates carry ``[before, after]`` where ``before`` holds the previous
    event_id and value of the same user (the event itself when there is none).
    The previous row per user is found with the bucketed lag, so one very busy
    user does not end up in one task.
    """
    base = events_columns(table(spark, sf_dir, "events"))
    lagged = keyed_lag(base, keys=["user_id"], order=["event_id"], cols=["event_id", "value"],
                       prefix="prev_", width=width)
    cur = F.struct("event_id", "text_col", "user_id", "value")
    prev = F.struct(F.coalesce("prev_event_id", "event_id").alias("event_id"), "text_col", "user_id",
                    F.coalesce("prev_value", "value").alias("value"))
    return lagged.select(
        "schema", "table", "action",
        F.when(F.col("action") == "update", F.array(prev, cur)).otherwise(F.array(cur)).alias("rows"),
        F.array(*[F.lit(c) for c in pk]).cast("array<string>").alias("pk_columns"),
        F.lit(SOURCE_UUID).alias("gtid_uuid"), "gtid_seq", F.col("event_id").alias("pos"), "ts",
    )


def chg_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One multi-row insert per order; images sorted like the oracle's row_no.

    A row event is bounded by the source's event size, so collecting the rows
    of one order is bounded too; the aggregate is partial (map-side) first.
    """
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    li = li.join(orders, on="l_orderkey", how="left_semi")
    sort_key = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_orderkey")
    grouped = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(sort_key)).alias("_sorted"))
    rows = F.transform("_sorted", lambda r, i: F.struct(
        r["l_linenumber"].alias("l_linenumber"), r["l_orderkey"].alias("l_orderkey"),
        r["l_partkey"].alias("l_partkey"), r["l_quantity"].alias("l_quantity"),
        r["l_suppkey"].alias("l_suppkey"), (i + 1).cast("bigint").alias("row_no")))
    return grouped.select(
        F.lit("test_sales").alias("schema"), F.lit("test_lineitem").alias("table"), F.lit("insert").alias("action"),
        rows.alias("rows"), F.array(F.lit("l_orderkey"), F.lit("l_linenumber")).alias("pk_columns"),
        F.lit(SOURCE_UUID).alias("gtid_uuid"), (F.col("l_orderkey") + 1).alias("gtid_seq"),
        F.lit(0).cast("bigint").alias("pos"),
    )


def chg_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserts into a table without a primary key (key = topic)."""
    r = table(spark, sf_dir, "region")
    return r.select(
        F.lit("ref_db").alias("schema"), F.lit("region").alias("table"), F.lit("insert").alias("action"),
        F.array(F.struct("r_name", "r_regionkey")).alias("rows"),
        F.array().cast("array<string>").alias("pk_columns"),
        F.lit(SOURCE_UUID).alias("gtid_uuid"), (F.col("r_regionkey") + 1).cast("bigint").alias("gtid_seq"),
        F.lit(0).cast("bigint").alias("pos"),
    )


def pipeline_of(user_id: Column) -> Column:
    return _case(user_id % 3, [(0, "p0"), (1, "p1")], "p2")


def state_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved positions: one save per delivered event, as upstream saves each one.

    Columns ``name, gtid_uuid, gtid_seq, saved_at`` (``saved_at`` timestamp_ntz).
    """
    ev = table(spark, sf_dir, "events")
    return ev.select(pipeline_of(F.col("user_id")).alias("name"), F.lit(SOURCE_UUID).alias("gtid_uuid"),
                     (F.col("event_id") + 1).alias("gtid_seq"), F.col("ts").alias("saved_at"))


def chg_binlog(spark: SparkSession, sf_dir: str, entries_per_file: int = 1000) -> DataFrame:
    """A raw log with non-row entries: GTID markers (``gtid``), commits (``xid``)
    and row events, in files of ``entries_per_file`` positions.

    Only GTID markers carry ``gtid_uuid`` and ``gtid_seq``; row events get them
    from the last marker before them in the log, whatever file it is in (S2).
    The server changes every ``entries_per_file * 3 // 2`` entries, within files.
    """
    kind = _case(F.col("event_type"), [("signup", "insert"), ("error", "delete"), ("click", "update"),
                                       ("view", "gtid")], "xid")
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", "ts", kind.alias("action"),
        _case(F.col("user_id") % 3, [(0, "test_shop"), (1, "tenant_shop")], "audit_db").alias("schema"),
        _case(F.col("user_id") % 2, [(0, "test_events")], "entity_1").alias("table"))
    file_no = (F.floor(F.col("event_id") / entries_per_file) + 1).cast("string")
    return ev.select(
        F.concat(F.lit("binlog."), F.lpad(file_no, 6, "0")).alias("log_file"),
        F.col("event_id").alias("pos"), "action", "schema", "table",
        F.when(F.col("action").isin("insert", "update", "delete"),
               F.array(F.struct("event_id", "user_id", "value"))).alias("rows"),
        F.when(F.col("action") == "gtid", F.when(
            F.expr(f"(event_id div {entries_per_file * 3 // 2}) % 2 = 0"), F.lit(SOURCE_UUID)).otherwise(
            F.lit(OTHER_UUID))).alias("gtid_uuid"),
        F.when(F.col("action") == "gtid", F.col("event_id") + 1).alias("gtid_seq"), "ts",
    )
