"""Helpers shared by the training-data operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.session import shared_path

#: Rows per Arrow batch: whole texts of any length travel in small batches.
BATCH_ROWS = 512

#: The white space of every contract, as a Java/Python regex class.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; sets the batch size the Arrow operators assume."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there, lost
    executors cost nothing, and every later pass reads the same rows."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0, by ``order`` in the group) and ``n`` (rows
    of the group).  A group of any size is spread over the range partitions; what
    a partition needs to know is one summary row per partition and group."""
    by = [group, *order, "_tie"]
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())  # equal rows are spread too
    at = written(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_id", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_id", 33).alias("_part")
    parts = at.groupBy(F.col(group).alias("_g"), part).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    parts = written(parts.selectExpr("_g", "_part", "_first", "sum(_n) over (partition by _g order by _part) - _n as _base",
                                     "sum(_n) over (partition by _g) as n"), f"{name}-parts")
    return (at.join(parts, (at[group] == parts["_g"]) & (F.shiftrightunsigned(at["_id"], 33) == parts["_part"]))
            .select(*rows.columns, (F.col("_base") + F.col("_id") - F.col("_first")).alias("idx"), "n"))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus`` (null id: null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def binary_rows(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of an Arrow string/binary array without copying per
    row; null rows are empty."""
    import pyarrow as pa

    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
        kind = np.int64
    else:
        column = column.cast(pa.binary())
        kind = np.int32
    if column.null_count:
        column = column.fill_null(b"")
    _, offs, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    body = body[offsets[0]:offsets[-1]]
    return body, offsets - offsets[0]
