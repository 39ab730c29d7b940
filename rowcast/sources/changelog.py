"""Change-log sources.

A change log is any table with the raw contract of
:func:`rowcast.operators.envelope.build_events`.  Batch logs are read with
``spark.read``, streams with ``spark.readStream`` (a schema is required, so
the plan is fixed before data arrives).  A live binlog client is not part of
this library; logs land in files, tables or Kafka first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import GTID_SEQ, GTID_UUID, ROW_ACTIONS
from rowcast.operators.ordered import DEFAULT_BUCKET_WIDTH, keyed_windows


#: Files of a micro-batch unless the caller says otherwise.
FILES_PER_TRIGGER = 1000


def read_log(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None,
             **options) -> DataFrame:
    """S1 (batch): a change log from files."""
    r = spark.read.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def stream_log(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet",
               max_files_per_trigger: int = FILES_PER_TRIGGER, **options) -> DataFrame:
    """S1 (stream): new files of a change-log folder as a stream.

    ``max_files_per_trigger`` bounds each micro-batch (back-pressure), the first
    one over a backlog too.
    """
    r = spark.readStream.format(fmt).schema(schema).options(**options)
    return r.option("maxFilesPerTrigger", str(max_files_per_trigger)).load(path)


def stream_kafka(spark: SparkSession, servers: str, topics: str, value_schema: T.StructType | str,
                 starting_offsets: str = "earliest", **options) -> DataFrame:
    """S1 from Kafka (needs the Kafka connector on the class path).

    S3: ``starting_offsets='earliest'`` reads from the beginning; S4 resumes
    from the streaming checkpoint instead.
    """
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topics).option("startingOffsets", starting_offsets).options(**options).load())
    return raw.select(F.from_json(F.col("value").cast("string"), value_schema).alias("r")).select("r.*")


def write_log(log: DataFrame, path: str, partition_by: Sequence[str] = ("schema", "table"),
              fmt: str = "parquet", mode: str = "append") -> None:
    """Store a change log partitioned by schema and table, so that rule guards
    and source filters (regexes on those columns) prune whole folders."""
    log.write.mode(mode).partitionBy(*partition_by).format(fmt).save(path)


def evolve_rows(log: DataFrame, image_type: T.StructType) -> DataFrame:
    """Bring a typed log's row images to ``image_type`` (a newer table version):
    missing columns become null, columns are cast and put in that order, so
    logs of several versions union by name."""
    have = set(log.schema["rows"].dataType.elementType.names)
    rows = F.transform("rows", lambda r: F.struct(*[
        (r[f.name].cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in image_type.fields]))
    return log.withColumn("rows", rows)


def row_events_only(log: DataFrame, action: str = "action") -> DataFrame:
    """Keep row changes; rotate/DDL/XID/GTID-marker entries are skipped."""
    return log.filter(F.col(action).isin(*ROW_ACTIONS))


def stamp_gtid(log: DataFrame, file_no: Column | str = "log_file", pos_col: str = "pos", seq_col: str = GTID_SEQ,
               uuid_col: str | None = GTID_UUID, source: Sequence[str] = (), width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Give every entry the last GTID, number and server uuid together, seen
    at or before it in the log.

    The log's order is (file, position): a new file goes on with the last GTID
    of the one before, as only entries before the very first marker have none.
    ``file_no`` is a file's number, by default the digits its name ends with.
    ``source`` names the columns that tell several logs apart.  Batch only: a
    stream cannot run non-time windows, so streams must carry the position as a
    column.  Cut by position, so one huge log is spread over many tasks.
    """
    name = F.col(file_no) if isinstance(file_no, str) else file_no
    number = F.regexp_extract(name.cast("string"), r"(\d+)$", 1).cast("bigint")
    marks = [c for c in (uuid_col, seq_col) if c and c in log.columns]
    at = log.withColumns({
        "_file_at": F.coalesce(number, F.lit(0)) * F.lit(1 << 40) + F.col(pos_col),
        "_mark": F.when(F.col(seq_col).isNotNull(), F.struct(*marks))})
    out = keyed_windows(at, keys=list(source), order=["_file_at"], lasts={"_last": "_mark"}, width=width)
    return out.select(*[F.col("_last")[c].alias(c) if c in marks else F.col(c) for c in log.columns])


def source_query(spark: SparkSession, sql: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL against the source tables (registered as temp views)."""
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql)


def register_tables(spark: SparkSession, sf_dir: str, names: Sequence[str]) -> None:
    for n in names:
        spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet").createOrReplaceTempView(n)
