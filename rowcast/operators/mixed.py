"""Mixed layout: images as ``array<map<string, variant>>``.

The typed layout needs one DataFrame per table shape.  The mixed layout puts
any number of tables into one frame: every row image is a map from column
name to a ``variant`` value, so tables with different columns union freely
and values keep their JSON types.  Keys and topics are extracted to strings
(variant cannot be grouped or sorted); map entries are put in name order
before encoding, which gives the same JSON text as the typed layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import RAW_ROWS

MIXED_IMAGE = T.MapType(T.StringType(), T.VariantType())


def _by_key(left: Column, right: Column) -> Column:
    return F.when(left["key"] < right["key"], -1).when(left["key"] > right["key"], 1).otherwise(0)


def _value(row: Column, field: T.StructField) -> Column:
    """A column's value as a variant; times in the text form that is encoded."""
    from rowcast.operators.codec import TIME_FORMAT

    v = row[field.name]
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        v = F.date_format(v, TIME_FORMAT)
    return v if isinstance(field.dataType, T.VariantType) else v.cast("variant")


def struct_to_map(row: Column, image_type: T.StructType) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(f.name) for f in image_type.fields]),
                             F.array(*[_value(row, f) for f in image_type.fields]))


def to_mixed_rows(rows: Column, image_type: T.StructType) -> Column:
    """``array<struct>`` -> ``array<map<string, variant>>``."""
    return F.transform(rows, lambda r: struct_to_map(r, image_type))


def to_mixed_log(log: DataFrame) -> DataFrame:
    """A typed change log -> the same log in the mixed layout."""
    it = log.schema[RAW_ROWS].dataType.elementType
    if isinstance(it, T.MapType):
        return log
    return log.withColumn(RAW_ROWS, to_mixed_rows(F.col(RAW_ROWS), it))


def union_logs(logs: Sequence[DataFrame]) -> DataFrame:
    """Several tables' change logs (any shapes) as one mixed-layout log."""
    out = None
    for log in logs:
        m = to_mixed_log(log)
        out = m if out is None else out.unionByName(m, allowMissingColumns=True)
    return out


def sorted_rows(image: Column) -> Column:
    """Map entries in name order (the encoded key order)."""
    return F.transform(image, lambda m: F.map_from_entries(F.array_sort(F.map_entries(m), _by_key)))
