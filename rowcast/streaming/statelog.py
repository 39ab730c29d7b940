"""A stream's position as a log of deltas with compaction.

Each micro-batch appends the bitmap rows of its own events and nothing else
(``segment=<n>-<n>``), so what a batch writes doesn't depend on the state's size.
Every ``FAN`` segments are merged into one of the next size (``segment=<a>-<b>``),
so after n batches about ``FAN * log(n)`` segments are live.  Readers merge on
read: a segment inside another complete one is left out, and since merging is a
bitwise or, reading a position twice would change nothing.

A segment is replaced only by a complete one (its ``_SUCCESS`` file), and deleted
``FAN`` batches later, when readers that listed it are done.  A replayed batch
overwrites its own segment.

Batches are numbered through a pipeline's life: a query with a fresh checkpoint
goes on after the last saved number (:func:`first_number`), which the checkpoint
folder remembers, so neither records nor segments of earlier runs are overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.operators import bitmaps
from rowcast.session import delete_folder, folder_names, make_folder

#: Segments that are merged into one of the next size.
FAN = 8


def _name(lo: int, hi: int) -> str:
    return f"segment={lo:010d}-{hi:010d}"


def segments(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """All complete segments (lo, hi), also those inside larger ones."""
    out = []
    for name in folder_names(spark, path):
        if name.startswith("segment=") and "_SUCCESS" in folder_names(spark, f"{path}/{name}"):
            lo, hi = name.removeprefix("segment=").split("-")
            out.append((int(lo), int(hi)))
    return sorted(out)


def _inside(s: tuple[int, int], all_: list[tuple[int, int]]) -> tuple[int, int] | None:
    return next((x for x in all_ if x != s and x[0] <= s[0] and s[1] <= x[1]), None)


def live(all_: list[tuple[int, int]], lo: int = 0, hi: int | None = None) -> list[tuple[int, int]]:
    """The largest segments within lo..hi."""
    own = [s for s in all_ if s[0] >= lo and (hi is None or s[1] <= hi)]
    return [s for s in own if _inside(s, own) is None]


def _rows(spark: SparkSession, path: str, parts: list[tuple[int, int]]) -> DataFrame:
    return spark.read.schema(bitmaps.STATE_DDL).parquet(*[f"{path}/{_name(*s)}" for s in parts])


def _merged(rows: DataFrame) -> DataFrame:
    """One state of all rows; a pipeline's timestamp is its newest."""
    stamps = rows.groupBy("name").agg(F.max("timestamp").alias("_t")).withColumnRenamed("name", "_n")
    out = bitmaps.merged(rows, F.lit(None)).drop("timestamp")
    return out.join(stamps, out["name"].eqNullSafe(stamps["_n"]), "left").select(*out.columns, F.col("_t").alias("timestamp"))


def read_state(spark: SparkSession, path: str, below: int | None = None) -> DataFrame | None:
    """The state that all batches (those below a number) have saved, as bitmap
    rows with one save's timestamp per pipeline; None if nothing is saved."""
    parts = live(segments(spark, path), 0, None if below is None else below - 1)
    return _merged(_rows(spark, path, parts)) if parts else None


def append(rows: DataFrame, path: str, number: int, base: int = 0) -> None:
    """Save one batch's own state rows and merge what is due."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{path}/{_name(number, number)}")
    size = FAN
    while (number - base + 1) % size == 0:
        _merge(spark, path, number + 1 - size, number)
        size *= FAN
    sweep(spark, path, number)


def _merge(spark: SparkSession, path: str, lo: int, hi: int) -> None:
    all_ = segments(spark, path)
    if (lo, hi) in all_:
        return  # a replay: its parts may be deleted already
    parts = live(all_, lo, hi)
    if parts:
        _merged(_rows(spark, path, parts)).write.mode("overwrite").parquet(f"{path}/{_name(lo, hi)}")


def sweep(spark: SparkSession, path: str, number: int) -> None:
    """Delete segments that a complete larger one replaced FAN batches ago."""
    all_ = segments(spark, path)
    for s in all_:
        larger = _inside(s, all_)
        if larger and larger[1] <= number - FAN:
            delete_folder(spark, f"{path}/{_name(*s)}")


def first_number(spark: SparkSession, checkpoint: str, path: str) -> int:
    """The number of the query's batch 0.  A checkpoint that has begun remembers
    it; a fresh one begins after the last saved segment, and the state up to there
    is merged into one segment, which the resumed query reads."""
    kept = [x for x in folder_names(spark, f"{checkpoint}/rowcast") if x.startswith("base=")]
    if kept:
        return max(int(x.removeprefix("base=")) for x in kept)
    begun = bool(folder_names(spark, f"{checkpoint}/offsets"))
    all_ = segments(spark, path)
    base = 0 if begun else max((s[1] + 1 for s in all_), default=0)
    if base and len(live(all_, 0, base - 1)) > 1:
        _merge(spark, path, 0, base - 1)
    make_folder(spark, f"{checkpoint}/rowcast/base={base}")
    return base
