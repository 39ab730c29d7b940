"""Per-key ordered operators that stay balanced when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task, so a key
holding a third of all rows becomes one giant sort.  The operators here cut
every key into buckets of its integer order column (a sequence number, a GTID,
an event id): ``order[0] div width``.  Rows are exchanged on ``(key, bucket)``
explicitly, so a partitioning that the input already has never keeps a key
together, and the window runs per ``(key, bucket)``.  What a bucket takes over
from earlier ones (rows so far, sum so far, last value) comes from a summary
with one row per ``(key, bucket)``.

The summary is an aggregate (summed map-side, so a hot key costs one row per
task and bucket), is windowed per key (a key of ``n`` dense rows has
``n / width`` buckets), keeps only buckets that have earlier ones, and is
written to the shared folder.  The plan that is returned therefore scans its
input once, whatever number of calls is chained; each call adds one narrow pass
over its input for the summary.  Number, sums, lags, last values and maxima of
one key and order are computed together by :func:`keyed_windows`.

Bound: a bucket holds at most ``width`` distinct values of the leading order
column, so lead with a per-event sequence (event id, GTID sequence, log
position): rows that share one GTID are the row events of one transaction,
which the source bounds.  ``order`` must be unique per key.  Batch only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.session import save_shared

DEFAULT_BUCKET_WIDTH = 1 << 20

_B = "_ord_bucket"
_FIRST_BUCKET = -(1 << 62)


def _bucket(order: Sequence[str], width: int) -> Column:
    """Exact integer bucket of the first order column; null sorts first."""
    return F.coalesce(F.expr(f"CAST(`{order[0]}` AS BIGINT) div {int(width)}"), F.lit(_FIRST_BUCKET))


def _default(dt: T.DataType) -> Column | None:
    """A typed stand-in for null keys (paired with an is-null flag)."""
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.NumericType,)):
        return F.lit(0).cast(dt)
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    if isinstance(dt, T.BinaryType):
        return F.lit(bytearray())
    return None


def _part_keys(df: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Null-safe equi keys: each key k becomes (is-null flag, value or a typed
    default).  Windows and joins then share plain equi keys, so a join on them
    reuses the window's partitioning, and null keys are handled like others."""
    cols = []
    for i, k in enumerate(keys):
        dflt = _default(df.schema[k].dataType)
        if dflt is None:
            df = df.withColumn(f"_pk{i}v", F.col(k))
            cols.append(f"_pk{i}v")
        else:
            df = (df.withColumn(f"_pk{i}n", F.col(k).isNull())
                    .withColumn(f"_pk{i}v", F.coalesce(F.col(k), dflt)))
            cols += [f"_pk{i}n", f"_pk{i}v"]
    return df, cols


def keyed_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], number: str | None = None,
                  sums: Mapping[str, str] | None = None, lags: Mapping[str, str] | None = None,
                  lasts: Mapping[str, str] | None = None, maxes: Mapping[str, str] | None = None,
                  width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add per-key ordered columns, each equal to the plain window over
    ``partitionBy(keys).orderBy(order)``.

    ``number``: 1-based position; ``sums``, ``maxes`` and ``lasts``: running
    sum, maximum and last non-null value up to and including the row; ``lags``:
    the value on the previous row.  Mappings are output name -> input column.
    """
    keys, order = list(keys), list(order)
    sums, lags, lasts, maxes = (dict(x or {}) for x in (sums, lags, lasts, maxes))
    inputs = list(dict.fromkeys([*keys, *order, *sums.values(), *lags.values(), *lasts.values(), *maxes.values()]))
    d, pk = _part_keys(df.select(*inputs).withColumn(_B, _bucket(order, width)), keys)
    at = F.struct(*[F.col(c) for c in order])
    lagged = F.struct(*[F.col(c).alias(n) for n, c in lags.items()]) if lags else F.lit(None)
    summary = d.groupBy(*pk, _B).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(lagged, at).alias("_lag"),
        *[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()], *[F.max(c).alias(f"_m_{n}") for n, c in maxes.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"_l_{n}") for n, c in lasts.items()])
    every = Window.partitionBy(*pk).orderBy(_B)
    before = every.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *pk, _B, F.row_number().over(every).alias("_i"), F.sum("_n").over(before).alias("_cn"),
        F.last("_lag").over(before).alias("_clag"), *[F.sum(f"_s_{n}").over(before).alias(f"_cs_{n}") for n in sums],
        *[F.max(f"_m_{n}").over(before).alias(f"_cm_{n}") for n in maxes],
        *[F.last(f"_l_{n}", ignorenulls=True).over(before).alias(f"_cl_{n}") for n in lasts])
    carry = save_shared(carry.filter(F.col("_i") > 1).drop("_i"), "ordered-carry")

    rows, pk = _part_keys(df.withColumn(_B, _bucket(order, width)), keys)
    w = Window.partitionBy(*pk, _B).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.repartition(*pk, _B).select(
        "*", F.row_number().over(w).alias("_ln"), F.lag(F.struct(*[F.col(c).alias(n) for n, c in lags.items()])
                                                        if lags else F.lit(None)).over(w).alias("_llag"),
        *[F.sum(c).over(upto).alias(f"_ls_{n}") for n, c in sums.items()],
        *[F.max(c).over(upto).alias(f"_lm_{n}") for n, c in maxes.items()],
        *[F.last(c, ignorenulls=True).over(upto).alias(f"_ll_{n}") for n, c in lasts.items()])
    j = local.join(carry, on=[*pk, _B], how="left")
    out = [(F.col("_ln") + F.coalesce("_cn", F.lit(0))).cast("bigint").alias(number)] if number else []
    for n in sums:  # SQL sum: null only while every value so far is null
        a, b = F.col(f"_ls_{n}"), F.col(f"_cs_{n}")
        out.append(F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b).cast(j.schema[f"_ls_{n}"].dataType).alias(n))
    prev = F.coalesce("_llag", "_clag") if lags else None
    out += [prev[n].alias(n) for n in lags]
    out += [F.coalesce(f"_ll_{n}", f"_cl_{n}").alias(n) for n in lasts]
    out += [F.greatest(f"_lm_{n}", f"_cm_{n}").alias(n) for n in maxes]
    return j.select(*[F.col(c) for c in df.columns], *out)


def keyed_lag(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
              prefix: str = "prev_", width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same key."""
    return keyed_windows(df, keys, order, lags={prefix + c: c for c in cols}, width=width)


def keyed_row_number(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn",
                     width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add ``name`` = 1-based position of the row within its key, by ``order``."""
    return keyed_windows(df, keys, order, number=name, width=width)


def keyed_running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str,
                      width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Running sum of ``value`` per key (inclusive of the current row)."""
    return keyed_windows(df, keys, order, sums={name: value}, width=width)


def keyed_last_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, name: str,
                     width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Add ``name`` = last non-null ``col`` at or before the row within its key."""
    return keyed_windows(df, keys, order, lasts={name: col}, width=width)


def keyed_running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str, name: str,
                      width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Running maximum of ``col`` per key (inclusive, nulls ignored)."""
    return keyed_windows(df, keys, order, maxes={name: col}, width=width)
