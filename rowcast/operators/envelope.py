"""Envelope construction: raw row-change log -> change events.

Input contract (one row per row-change message)::

    schema string, table string, action string,
    rows array<struct|map>      raw row images; updates alternate before, after
    pk_columns array<string>    optional; primary-key column names in key order
    gtid_uuid, gtid_seq, pos    position side columns (optional)
    ...                         any other column is carried along untouched

Output: ``schema, table, action, before, after, meta, kafka`` plus the carried
columns.  The whole build is one projection (plus one filter for the error
policy): no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast.model import (ACTION_DELETE, ACTION_INSERT, ACTION_UPDATE, ERROR_COL, KEY_SEPARATOR, RAW_PK,
                           RAW_ROWS, ROW_ACTIONS, TOPIC_SEPARATOR)

ON_ERROR = ("fail", "drop", "pass", "mark")


def _image_type(log: DataFrame) -> T.DataType:
    dt = log.schema[RAW_ROWS].dataType
    if not isinstance(dt, T.ArrayType):
        raise TypeError(f"'{RAW_ROWS}' must be an array of row images, got {dt.simpleString()}")
    return dt.elementType


def sort_image_fields(rows: Column, image_type: T.DataType) -> Column:
    """Reorder struct fields by name, the key order of the encoded object."""
    if not isinstance(image_type, T.StructType):
        return rows
    names = [f.name for f in image_type.fields]
    if names == sorted(names):
        return rows
    return F.transform(rows, lambda r: F.struct(*[r[n].alias(n) for n in sorted(names)]))


def normalise_strings(rows: Column, image_type: T.DataType, string_columns: Sequence[str]) -> Column:
    """E5: bytes -> text for the columns the source declares as strings.

    Invalid UTF-8 becomes U+FFFD (``cast``), it never fails the job.  Columns
    not listed are left as they are.
    """
    if not string_columns:
        return rows
    if isinstance(image_type, T.StructType):
        present = {f.name: f.dataType for f in image_type.fields}
        todo = [c for c in string_columns if isinstance(present.get(c), T.BinaryType)]
        if not todo:
            return rows

        def fix(r):
            for c in todo:
                r = r.withField(c, r[c].cast("string"))
            return r
        return F.transform(rows, fix)
    if isinstance(image_type, T.MapType) and isinstance(image_type.valueType, T.VariantType):
        def text(k, v):
            raw = k.isin(*string_columns) & (F.schema_of_variant(v) == "BINARY")
            return F.when(raw, F.try_variant_get(v, "$", "binary").cast("string").cast("variant")).otherwise(v)
        return F.transform(rows, lambda r: F.transform_values(r, text))
    return rows


def name_positional(rows: Column, columns: Column | Sequence[str], value_type: str = "variant") -> Column:
    """Positional raw rows (``array<array<...>>``) -> named row images.

    ``columns`` is the table's column list (a per-row ``array<string>`` column
    or a fixed list).  A row shorter than the column list gets nulls for the
    missing values (upstream indexes past the end and crashes).  The result is
    the mixed layout, ``array<map<string, value_type>>``.
    """
    cols = columns if isinstance(columns, Column) else F.array(*[F.lit(c) for c in columns])
    return F.transform(rows, lambda r: F.map_from_entries(F.transform(
        cols, lambda c, i: F.struct(c.alias("key"), F.get(r, i).cast(value_type).alias("value")))))


def name_positional_typed(rows: Column, image_type: T.StructType) -> Column:
    """E6, typed layout: positional raw rows -> ``array<struct>`` of
    ``image_type`` (values cast to the column types; short rows give nulls)."""
    return F.transform(rows, lambda r: F.struct(*[
        F.get(r, i).cast(f.dataType).alias(f.name) for i, f in enumerate(image_type.fields)]))


def images(action: Column, rows: Column) -> tuple[Column, Column]:
    """(before, after) per action; update rows pair up by position."""
    before = (F.when(action == ACTION_DELETE, rows)
               .when(action == ACTION_UPDATE, F.filter(rows, lambda r, i: i % 2 == 0)))
    after = (F.when(action == ACTION_INSERT, rows)
              .when(action == ACTION_UPDATE, F.filter(rows, lambda r, i: i % 2 == 1)))
    return before, after


def default_topic(schema: Column, table: Column) -> Column:
    """``schema.table`` (a missing part is an empty string, never dropped)."""
    return F.concat(F.coalesce(schema, F.lit("")), F.lit(TOPIC_SEPARATOR), F.coalesce(table, F.lit("")))


def key_parts(image: Column, image_type: T.DataType, pk: Sequence[str] | None, pk_col: Column | None) -> Column | None:
    """Primary-key values of one image as ``array<string>`` (null parts kept)."""
    if pk is not None:
        if not pk:
            return F.array().cast("array<string>")
        if isinstance(image_type, T.StructType):
            names = set(image_type.fieldNames())
            missing = [c for c in pk if c not in names]
            if missing:
                raise ValueError(f"primary-key columns not in the row image: {missing}")
            return F.array(*[image[c].cast("string") for c in pk])
        return F.array(*[image[c].cast("string") for c in pk])
    if pk_col is None:
        return None
    if isinstance(image_type, T.StructType):
        # Per-row key list over a typed image: pick the named field per element.
        def pick(c):
            out = None
            for f in image_type.fieldNames():
                out = (F.when(c == f, image[f].cast("string")) if out is None
                       else out.when(c == f, image[f].cast("string")))
            return out if out is not None else F.lit(None).cast("string")
        return F.transform(pk_col, pick)
    return F.transform(pk_col, lambda c: F.element_at(image, c).cast("string"))


def event_key(log: DataFrame, pk: Sequence[str] | None, string_columns: Sequence[str] = ()) -> tuple[Column, Column]:
    """(key, whether it is an error) of raw events, over ``log``'s columns."""
    itype = _image_type(log)
    rows = sort_image_fields(normalise_strings(F.col(RAW_ROWS), itype, string_columns), itype)
    if isinstance(itype, T.StructType):
        itype = T.StructType(sorted(itype.fields, key=lambda f: f.name))
    topic = default_topic(F.col("schema"), F.col("table"))
    pk_col = (F.coalesce(F.col(RAW_PK), F.array().cast("array<string>"))
              if (pk is None and RAW_PK in log.columns) else None)
    # Row 0 of after (insert) or before (update, delete) is always rows[0]:
    # updates alternate before, after.  Reading it directly keeps the key
    # (and the error filter) free of the pairing lambdas.
    kimg = F.get(rows, 0)
    parts = key_parts(kimg, itype, pk, pk_col)
    if parts is None:
        key, key_err = topic, F.lit(False)
    elif pk is not None:
        # a fixed key list: plain expressions (no lambda), so the stage stays in codegen
        if not pk:
            key, key_err = topic, F.lit(False)
        else:
            vals = [kimg[c].cast("string") for c in pk]
            key = F.concat_ws(KEY_SEPARATOR, *vals)
            key_err = vals[0].isNull()
            for v in vals[1:]:
                key_err = key_err | v.isNull()
    else:
        key = F.when(F.size(parts) == 0, topic).otherwise(F.array_join(parts, KEY_SEPARATOR))
        key_err = F.exists(parts, lambda p: p.isNull())
    return key, key_err


def build_events(log: DataFrame, pipeline: str | Column = "rowcast", timestamp: Column | None = None,
                 pk: Sequence[str] | None = None, on_error: str = "fail",
                 string_columns: Sequence[str] = ()) -> DataFrame:
    """Raw change log -> change events.

    ``pk``: primary-key columns for every row of ``log``; when ``None`` the
    per-row ``pk_columns`` column is used if present, else there is no key and
    the key is the topic (E9).  ``timestamp`` defaults to processing time in
    microseconds (one value per query or micro-batch).  ``on_error`` decides
    what happens to malformed events (unknown action, odd update row count,
    missing key value): ``fail`` raises, ``drop`` removes them, ``pass`` keeps
    them, ``mark`` keeps them with an ``_error`` column.
    """
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")
    itype = _image_type(log)
    rows = sort_image_fields(normalise_strings(F.col(RAW_ROWS), itype, string_columns), itype)
    if isinstance(itype, T.StructType):
        itype = T.StructType(sorted(itype.fields, key=lambda f: f.name))
    action = F.col("action")
    before, after = images(action, rows)
    topic = default_topic(F.col("schema"), F.col("table"))

    key, key_err = event_key(log, pk, string_columns)

    pipe = pipeline if isinstance(pipeline, Column) else F.lit(pipeline)
    ts = timestamp if timestamp is not None else F.unix_micros(F.current_timestamp())
    err = (F.when(~action.isin(*ROW_ACTIONS) | action.isNull(), F.lit("invalid action"))
            .when((action == ACTION_UPDATE) & (F.size(F.col(RAW_ROWS)) % 2 != 0), F.lit("odd update rows"))
            .when(key_err, F.lit("null key value")))

    carried = [c for c in log.columns if c not in ("schema", "table", "action", RAW_ROWS, RAW_PK)]
    out = log.select(
        F.col("schema"), F.col("table"), action.alias("action"),
        before.alias("before"), after.alias("after"),
        F.struct(ts.cast("bigint").alias("timestamp"), pipe.cast("string").alias("pipeline")).alias("meta"),
        F.struct(topic.alias("topic"), key.alias("key")).alias("kafka"),
        *[F.col(c) for c in carried],
        err.alias(ERROR_COL),
    )
    return apply_error_policy(out, on_error)


def apply_error_policy(df: DataFrame, on_error: str, col: str = ERROR_COL) -> DataFrame:
    """Resolve the ``_error`` column: raise, drop, keep or keep-and-mark.

    The raise sits in a filter so that Catalyst cannot prune it away.
    """
    e = F.col(col)
    if on_error == "fail":
        check = F.when(e.isNotNull(), F.raise_error(F.concat(F.lit("malformed change event: "), e)))
        return df.filter(F.coalesce(check.cast("boolean"), F.lit(True))).drop(col)
    if on_error == "drop":
        return df.filter(e.isNull()).drop(col)
    if on_error == "pass":
        return df.drop(col)
    return df
