"""Column functions for rules: image access, masking, rerouting
and the named-helper registry (U2).

Every helper returns a Column; nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowcast.model import MASK_TEXT


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- scalar helpers

def obfuscate(value: Column | None = None) -> Column:
    """M3: the masking helper; always ``****`` (also for null input)."""
    return F.lit(MASK_TEXT)


def js_length(s: str | Column) -> Column:
    """String length in UTF-16 code units, as a script's ``.length`` counts."""
    return (F.octet_length(F.encode(_c(s), "UTF-16BE")) / 2).cast("int")


# ---------------------------------------------------------------- image access

def first_row(image: str | Column) -> Column:
    """Row 0 of an image list; null for a null or empty list (never raises)."""
    return F.get(_c(image), 0)


def row_field(image: str | Column, field: str) -> Column:
    """``array<struct>`` -> ``array<field>``: lets Parquet read one nested column."""
    return _c(image).getField(field)


def any_row(image: str | Column, field: str, pred: Callable[[Column], Column]) -> Column:
    """True when some row's ``field`` satisfies ``pred``; false for null lists."""
    return F.coalesce(F.exists(row_field(image, field), pred), F.lit(False))


def any_row_eq(image: str | Column, field: str, value) -> Column:
    """T9 for equality: ``array_contains`` instead of a lambda, so the operator
    keeps whole-stage codegen; false for null lists."""
    return F.coalesce(F.array_contains(row_field(image, field), value), F.lit(False))


def all_rows(image: str | Column, field: str, pred: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.forall(row_field(image, field), pred), F.lit(True))


# ---------------------------------------------------------------- image mutation

def rewrite_field(image: str | Column, field: str, fn: Callable[[Column, Column], Column]) -> Column:
    """M1: set ``field`` in every row to ``fn(value, row)``; null list stays null."""
    return F.transform(_c(image), lambda r: r.withField(field, fn(r[field], r)))


def mask_field(image: str | Column, field: str, min_length: int = 3) -> Column:
    """M1-M3: obfuscate ``field`` in every row whose value is longer than
    ``min_length`` UTF-16 units; shorter and null values stay."""
    return rewrite_field(image, field,
                         lambda v, r: F.when(js_length(v) > min_length, obfuscate(v)).otherwise(v))


def add_field(image: str | Column, field: str, fn: Callable[[Column], Column]) -> Column:
    """M7: add (or replace) a column in every row, computed from the row."""
    return F.transform(_c(image), lambda r: r.withField(field, fn(r)))


def drop_fields(image: str | Column, *fields: str) -> Column:
    """M7: remove columns from every row."""
    return F.transform(_c(image), lambda r: r.dropFields(*fields))


def filter_rows(image: str | Column, pred: Callable[[Column], Column]) -> Column:
    """M7: keep the rows of an image that satisfy ``pred``."""
    return F.filter(_c(image), pred)


def reshape_rows(image: str | Column, names: list[str], add: dict[str, Callable[[Column], Column]] | None = None,
                 drop: tuple[str, ...] = ()) -> Column:
    """M7: add and drop columns in every row, keeping the fields in name order.

    ``names`` are the current field names (``df.schema['after'].dataType.elementType.names``).
    """
    add = add or {}
    keep = [n for n in names if n not in drop and n not in add]
    order = sorted(set(keep) | set(add))
    return F.transform(_c(image), lambda r: F.struct(
        *[(add[n](r) if n in add else r[n]).alias(n) for n in order]))


# ---------------------------------------------------------------- helper registry

_REGISTRY: dict[str, Callable[..., Column]] = {}


def register_helper(name: str, fn: Callable[..., Column]) -> None:
    """Make a Column function available to rules by name."""
    _REGISTRY[name] = fn


def helper(name: str) -> Callable[..., Column]:
    try:
        return _REGISTRY[name]
    except KeyError:
        raise KeyError(f"no helper named {name!r}; registered: {sorted(_REGISTRY)}") from None


def helpers() -> dict[str, Callable[..., Column]]:
    return dict(_REGISTRY)


def register_sql_helpers(spark) -> None:
    """Expose the built-in helpers to ``spark.sql`` / ``selectExpr`` rules.

    Spark cannot apply these SQL-defined functions to a lambda variable (a row
    inside ``transform``); write the expression itself there, e.g.
    ``octet_length(encode(r.text_col, 'UTF-16BE')) / 2`` for ``js_length``.
    """
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION obfuscate(s STRING) RETURNS STRING RETURN '{MASK_TEXT}'")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION js_length(s STRING) RETURNS INT "
              "RETURN CAST(octet_length(encode(s, 'UTF-16BE')) / 2 AS INT)")


def register_pandas_helper(spark, name: str, fn, return_type: str) -> None:
    """Expose a vectorised Python helper (pandas Series -> Series) to SQL
    and to rules by name; it runs on Arrow batches, never per row."""
    from pyspark.sql.functions import pandas_udf

    udf = pandas_udf(fn, return_type)
    spark.udf.register(name, udf)
    register_helper(name, udf)


register_helper("obfuscate", obfuscate)
register_helper("js_length", js_length)
register_helper("mask_field", mask_field)


# ---------------------------------------------------------------- ENUM / SET labels (optional, Q14)

def enum_label(index: str | Column, labels: list[str]) -> Column:
    """ENUM index (1-based, 0 = empty) -> label text; out of range -> null."""
    idx = _c(index).cast("int")
    return F.when(idx == 0, F.lit("")).otherwise(F.try_element_at(F.array(*[F.lit(x) for x in labels]), idx))


def set_labels(bits: str | Column, labels: list[str]) -> Column:
    """SET bitmask -> ``array<string>`` of the labels whose bit is set."""
    b = _c(bits).cast("bigint")
    arr = F.array(*[F.lit(x) for x in labels])
    # bit i as a signed 64-bit literal (a SET has at most 64 members)
    masks = F.array(*[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("bigint") for i in range(len(labels))])
    return F.filter(arr, lambda x, i: F.element_at(masks, i + 1).bitwiseAND(b) != 0)
