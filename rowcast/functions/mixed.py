"""Rule helpers for the mixed layout (images are ``array<map<string, variant>>``).

Same meaning as the typed helpers in :mod:`rowcast.functions`; values are
read with a cast from variant and written back as variant.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from rowcast.functions import js_length, obfuscate


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def value(row: Column, field: str, type_: str = "string") -> Column:
    """A column's value in one row image, as ``type_`` (null when absent)."""
    return F.element_at(row, F.lit(field)).cast(type_)


def first_row(image: str | Column) -> Column:
    return F.get(_c(image), 0)


def any_row(image: str | Column, field: str, pred: Callable[[Column], Column], type_: str = "string") -> Column:
    return F.coalesce(F.exists(_c(image), lambda r: pred(value(r, field, type_))), F.lit(False))


def set_field(row: Column, field: str, new: Column) -> Column:
    return F.map_concat(F.map_filter(row, lambda k, v: k != field), F.create_map(F.lit(field), new.cast("variant")))


def rewrite_field(image: str | Column, field: str, fn: Callable[[Column, Column], Column],
                  type_: str = "string") -> Column:
    return F.transform(_c(image), lambda r: set_field(r, field, fn(value(r, field, type_), r)))


def mask_field(image: str | Column, field: str, min_length: int = 3) -> Column:
    """Obfuscate ``field`` where its text is longer than ``min_length`` UTF-16 units."""
    return F.transform(_c(image), lambda r: F.when(js_length(value(r, field)) > min_length,
                                                   set_field(r, field, obfuscate())).otherwise(r))


def drop_fields(image: str | Column, *fields: str) -> Column:
    return F.transform(_c(image), lambda r: F.map_filter(r, lambda k, v: ~k.isin(*fields)))


def add_field(image: str | Column, field: str, fn: Callable[[Column], Column]) -> Column:
    return F.transform(_c(image), lambda r: set_field(r, field, fn(r)))
