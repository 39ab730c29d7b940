"""GTID-set text <-> ``array<struct<uuid, lo, hi>>`` as Column expressions.

Grammar (MySQL): ``uuid:interval[:interval...][,uuid:...]`` where an interval
is ``N`` or ``N-M`` (inclusive).  Whitespace and newlines after commas are
allowed.  Sequence numbers are compared as numbers, never as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def parse_gtid_set(text: str | Column) -> Column:
    """Text -> ``array<struct<uuid:string, lo:bigint, hi:bigint>>`` (empty text: empty array)."""
    t = F.regexp_replace(_c(text), r"\s+", "")
    members = F.filter(F.split(t, ","), lambda m: m != "")

    def member(parts):  # a lambda variable, so a member is split once and not per interval
        uuid = F.lower(F.get(parts, 0))
        return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda iv: F.struct(
            uuid.alias("uuid"),
            F.substring_index(iv, "-", 1).cast("bigint").alias("lo"),
            F.substring_index(iv, "-", -1).cast("bigint").alias("hi")))

    members = F.transform(members, lambda m: F.split(m, ":"))
    return F.flatten(F.transform(members, member))


def format_interval(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo.cast("string")).otherwise(F.concat(lo.cast("string"), F.lit("-"), hi.cast("string")))


def format_gtid_set(ranges: str | Column) -> Column:
    """``array<struct<uuid, lo, hi>>`` -> canonical text: uuids sorted, intervals
    sorted, one member per uuid (``u:1-5:7,v:3``)."""
    r = F.array_sort(_c(ranges))
    uuids = F.array_distinct(F.transform(r, lambda x: x["uuid"]))
    return F.array_join(F.transform(uuids, lambda u: F.concat(
        u, F.lit(":"),
        F.array_join(F.transform(F.filter(r, lambda x: x["uuid"] == u),
                                 lambda x: format_interval(x["lo"], x["hi"])), ":"))), ",")


def widen_single(ranges: str | Column, start: int | Column = 1) -> Column:
    """A saved ``uuid:N`` means everything up to N is done: widen a uuid's only
    interval ``N-N`` to ``start-N``.  Sets with real intervals stay."""
    s = start if isinstance(start, Column) else F.lit(int(start)).cast("bigint")

    def widen(r):  # sorted: a uuid's only interval has neighbours of other uuids
        def alone(x, i):
            return (~F.coalesce(F.get(r, i - 1)["uuid"] == x["uuid"], F.lit(False))
                    & ~F.coalesce(F.get(r, i + 1)["uuid"] == x["uuid"], F.lit(False)))
        return F.transform(r, lambda x, i: F.struct(
            x["uuid"].alias("uuid"),
            F.when((x["lo"] == x["hi"]) & alone(x, i), F.least(s, x["lo"])).otherwise(x["lo"]).alias("lo"),
            x["hi"].alias("hi")))

    # bound as a lambda variable, so the sorted list is made once per row
    return F.get(F.transform(F.array(F.array_sort(_c(ranges))), widen), 0)


def in_gtid_set(uuid: str | Column, seq: str | Column, ranges: str | Column) -> Column:
    """True when (uuid, seq) lies in the set; for small literal or per-row sets."""
    u, s = _c(uuid), _c(seq)
    return F.coalesce(F.exists(_c(ranges), lambda x: (x["uuid"] == F.lower(u)) & s.between(x["lo"], x["hi"])),
                      F.lit(False))
