"""Positions as compressed bitmaps.

A state is rows, one per (pipeline, uuid, bucket of 32,768 sequence numbers) with
a bitmap of the numbers processed, built and merged in the JVM by
``bitmap_construct_agg`` and ``bitmap_or_agg``.  A bucket that is full becomes one
bit of a bitmap of buckets (level 1), so 2^30 gapless numbers cost one row of four
kilobytes.  Merging states is a bitwise or: batches may come in any order and may
be merged twice.

===== =================== ==========================================================
level bucket              row
===== =================== ==========================================================
0     number >> 15        bitmap of the numbers of one bucket
1     number >> 30        bitmap of the full buckets among 2^15
2     0                   no bitmap: the last ``(seq, pos)`` processed of the uuid,
                          and in ``n`` the events of the newest batch
===== =================== ==========================================================

Whether an event is done is an equi-join on (pipeline, uuid, bucket) and a test of
one bit.  No task needs more than a bucket's row, whatever a server's share.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowcast.model import GTID_SEQ, GTID_UUID, POS

SHIFT = 15
WIDTH = 1 << SHIFT
#: A bitmap's bytes.
BYTES = WIDTH // 8

TAIL = "struct<seq:bigint,pos:bigint>"
STATE_DDL = ("name string, uuid string, level int, bucket bigint, bits binary, seq bigint, pos bigint, n bigint, "
             "timestamp bigint")
RANGE_DDL = "name string, uuid string, lo bigint, hi bigint, seq bigint, pos bigint, n bigint, timestamp bigint"


def _low(number: Column) -> Column:
    return number.bitwiseAND(WIDTH - 1)


def _high(number: Column) -> Column:
    return F.shiftright(number, SHIFT)


def one_bit(at: Column) -> Column:
    """A bitmap with the bit ``at`` alone."""
    byte = F.shiftright(at, 3).cast("int")
    nibbles = F.substring(F.lit("0102040810204080"), (at.bitwiseAND(7) * 2 + 1).cast("int"), F.lit(2))
    return F.unhex(F.concat(F.repeat(F.lit("00"), byte), nibbles, F.repeat(F.lit("00"), F.lit(BYTES - 1) - byte)))


def has_bit(bits: Column, at: Column) -> Column:
    """Whether the bit ``at`` of a bitmap is set."""
    byte = F.substring(bits, (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), at.bitwiseAND(7).cast("int")) == 1


def positions(processed: DataFrame, pipeline: Column) -> DataFrame:
    """Events as (name, uuid, bucket, bits, tail, n): one partial aggregate, one
    exchange of bitmap rows.  Events without a position are left out."""
    pos = F.col(POS).cast("bigint") if POS in processed.columns else F.lit(None).cast("bigint")
    events = processed.select(pipeline.cast("string").alias("name"), F.lower(GTID_UUID).alias("uuid"),
                              F.col(GTID_SEQ).cast("bigint").alias("seq"), pos.alias("pos")).where("uuid is not null and seq is not null")
    return events.groupBy("name", "uuid", _high(F.col("seq")).alias("bucket")).agg(
        F.bitmap_construct_agg(_low(F.col("seq"))).alias("bits"), F.max(F.struct("seq", "pos")).alias("tail"),
        F.count(F.lit(1)).alias("n"))


def _outside(r: DataFrame, lo: str, hi: str) -> tuple[DataFrame, Column]:
    """``r`` with the whole buckets ``_c0.._c1`` of its intervals, and the numbers
    of an interval that lie outside of them (less than two buckets)."""
    cut = r.withColumns({"_c0": _high(F.col(lo) + (WIDTH - 1)), "_c1": _high(F.col(hi) + 1) - 1})
    ends = F.concat(
        F.when(F.col(lo) < F.col("_c0") * WIDTH, F.sequence(F.col(lo), F.col("_c0") * WIDTH - 1)).otherwise(F.array().cast("array<bigint>")),
        F.when((F.col("_c1") + 1) * WIDTH <= F.col(hi), F.sequence((F.col("_c1") + 1) * WIDTH, F.col(hi))).otherwise(
            F.array().cast("array<bigint>")))
    return cut, F.explode(F.when(F.col("_c0") > F.col("_c1"), F.sequence(F.col(lo), F.col(hi))).otherwise(ends))


def bitmaps_of(ranges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Intervals (name, uuid, lo, hi) as bitmap rows of level 0 and of level 1."""
    r = ranges.where("lo <= hi")
    cut, numbers = _outside(r, "lo", "hi")
    low = cut.select("name", "uuid", numbers.alias("x")).groupBy("name", "uuid", _high(F.col("x")).alias("bucket")).agg(
        F.bitmap_construct_agg(_low(F.col("x"))).alias("bits"))
    buckets, ends = _outside(cut.where("_c0 <= _c1").select("name", "uuid", F.col("_c0").alias("b0"), F.col("_c1").alias("b1")), "b0", "b1")
    some = buckets.select("name", "uuid", ends.alias("x")).groupBy("name", "uuid", _high(F.col("x")).alias("bucket")).agg(
        F.bitmap_construct_agg(_low(F.col("x"))).alias("bits"))
    whole = buckets.where("_c0 <= _c1").select("name", "uuid", F.explode(F.sequence("_c0", "_c1")).alias("bucket")).withColumn(
        "bits", F.unhex(F.lit("FF" * (WIDTH // 8) + "00" * (BYTES - WIDTH // 8))))
    return low, some.unionByName(whole)


def folded(low: DataFrame, more: DataFrame | None, timestamp: Column) -> DataFrame:
    """State rows of level-0 bitmaps (name, uuid, bucket, bits, tail, n) and of
    rows that have their level: full buckets become bits of level 1."""
    full = F.bitmap_count("bits") == WIDTH
    none, zero, bucket = F.lit(None), F.lit(0).cast("bigint"), F.col("bucket")
    parts = F.array(
        F.struct(F.when(full, 1).otherwise(0).alias("level"), F.when(full, _high(bucket)).otherwise(bucket).alias("bucket"),
                 F.when(full, one_bit(_low(bucket))).otherwise(F.col("bits")).alias("bits"), none.cast(TAIL).alias("tail"), zero.alias("n")),
        F.struct(F.lit(2).alias("level"), zero.alias("bucket"), none.cast("binary").alias("bits"), F.col("tail"), F.col("n")))
    rows = low.select("name", "uuid", F.explode(parts).alias("r")).select("name", "uuid", "r.*")
    if more is not None:
        rows = rows.unionByName(more)
    out = rows.where("level < 2 or tail is not null").groupBy("name", "uuid", "level", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max("tail").alias("tail"), F.sum("n").alias("n"))
    return out.select("name", "uuid", "level", "bucket", F.when(F.col("level") < 2, F.col("bits")).alias("bits"), "tail.seq", "tail.pos", "n",
                      timestamp.cast("bigint").alias("timestamp"))


def merged(parts: DataFrame, timestamp: Column) -> DataFrame:
    """State rows of any number of states, or parts of them, as one state."""
    tail = F.when(F.col("seq").isNotNull(), F.struct("seq", "pos"))
    rows = parts.select("name", "uuid", "level", "bucket", "bits", tail.alias("tail"), "n")
    low = rows.where("level = 0").groupBy("name", "uuid", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max("tail").alias("tail"), F.sum("n").alias("n"))
    return folded(low, rows.where("level > 0"), timestamp)


def added(processed: DataFrame, pipeline: Column, timestamp: Column, previous: DataFrame | None = None) -> DataFrame:
    """State rows of ``previous`` (state rows, one save) and of a batch's events;
    ``n`` counts this batch's events."""
    own = positions(processed, pipeline)
    if previous is None:
        return folded(own, None, timestamp)
    zero = F.lit(0).cast("bigint")
    tail = F.when(F.col("seq").isNotNull(), F.struct("seq", "pos")).cast(TAIL)
    before = previous.select("name", "uuid", "level", "bucket", "bits", tail.alias("tail"), zero.alias("n"))
    low = own.unionByName(before.where("level = 0").drop("level")).groupBy("name", "uuid", "bucket").agg(
        F.bitmap_or_agg("bits").alias("bits"), F.max("tail").alias("tail"), F.sum("n").alias("n"))
    return folded(low, before.where("level > 0"), timestamp)


def decoded(state: DataFrame) -> DataFrame:
    """The intervals of every state row (null ``seq``), and its last positions.
    Intervals end at a row's edges: neighbours may touch."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            los, his, at = [], [], []
            for i, (level, bucket, bits) in enumerate(zip(*(b.column(c).to_pylist() for c in ("level", "bucket", "bits")), strict=True)):
                if level > 1:
                    los.append([None]), his.append([None]), at.append([i])
                    continue
                flags = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(np.int8)
                edges = np.flatnonzero(np.diff(flags, prepend=0, append=0))
                unit = WIDTH if level else 1
                lo, hi = (bucket * WIDTH + edges[::2]) * unit, (bucket * WIDTH + edges[1::2]) * unit - 1
                los.append(lo.tolist()), his.append(hi.tolist()), at.append([i] * len(lo))
            flat = [pa.array([x for part in parts for x in part], pa.int64()) for parts in (los, his, at)]
            own = {c: b.column(c).take(flat[2]) for c in ("name", "uuid", "seq", "pos", "n", "timestamp")}
            yield pa.RecordBatch.from_arrays([own["name"], own["uuid"], flat[0], flat[1], own["seq"], own["pos"], own["n"], own["timestamp"]],
                                             names=["name", "uuid", "lo", "hi", "seq", "pos", "n", "timestamp"])
    return state.select(*[c.split()[0] for c in STATE_DDL.split(", ")]).mapInArrow(run, RANGE_DDL)


def texts(state: DataFrame, most: int) -> DataFrame:
    """One row ``(name, gtid, timestamp, tail, n_events)`` per pipeline, its
    intervals as a GTID-set text.  More than ``most`` intervals of a pipeline are
    an error when the text is made; its task holds no more than that."""
    import pyarrow as pa

    def run(key, batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        spans: dict[str, list] = {}
        tails, n, held, stamp = [], 0, 0, None
        for b in batches:
            held += b.num_rows
            if held > 2 * most + 1000:  # touching intervals are merged below
                raise ValueError(f"state of {key[0].as_py()} has more intervals than a text takes ({most}); keep it as rows (state_bitmaps)")
            t = pa.Table.from_batches([b])
            stamp = max([x for x in t.column("timestamp").to_pylist() if x is not None] + ([stamp] if stamp is not None else []), default=None)
            n += sum(x or 0 for x in t.column("n").to_pylist())
            ends = t.filter(pc.is_null(t.column("lo")))
            tails += [{"uuid": u, "seq": s, "pos": p} for u, s, p in zip(*(ends.column(c).to_pylist() for c in ("uuid", "seq", "pos")), strict=True)]
            own = t.filter(pc.is_valid(t.column("lo")))
            for u in own.column("uuid").unique().to_pylist():
                mine = own.filter(pc.equal(own.column("uuid"), u))
                spans.setdefault(u, []).append((np.asarray(mine.column("lo")), np.asarray(mine.column("hi"))))
        members, count = [], 0
        for u in sorted(spans):
            lo, hi = (np.concatenate(x) for x in zip(*spans[u], strict=True))
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate(hi[order])
            first = np.r_[True, lo[1:] - 1 > hi[:-1]]
            lo, hi = lo[first], hi[np.r_[first[1:], True]]
            count += len(lo)
            members.append(u + ":" + ":".join([str(a) if a == z else f"{a}-{z}" for a, z in zip(lo.tolist(), hi.tolist(), strict=True)]))
        if count > most:
            raise ValueError(f"state of {key[0].as_py()} has {count} intervals, more than a text takes ({most}); keep it as rows (state_bitmaps)")
        tails.sort(key=lambda x: (x["uuid"], x["seq"], x["pos"] is not None, x["pos"] or 0))
        tail = pa.struct([("uuid", pa.string()), ("seq", pa.int64()), ("pos", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.string()), pa.array([",".join(members)], pa.string()), pa.array([stamp], pa.int64()),
             pa.array([tails], pa.list_(tail)), pa.array([n], pa.int64())], names=["name", "gtid", "timestamp", "tail", "n_events"])

    # Spark takes the iterator form from the types
    run.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return decoded(state).groupBy("name").applyInArrow(
        run, "name string, gtid string, timestamp bigint, tail array<struct<uuid:string,seq:bigint,pos:bigint>>, n_events bigint")


def not_in(events: DataFrame, state: DataFrame, pipe: str, uuid: str, seq: str, keep: Column) -> DataFrame:
    """The events (columns ``pipe``, ``uuid``, ``seq``) whose number isn't set in
    ``state``, and those that ``keep`` holds for."""
    out = events.withColumns({"_b": _high(F.col(seq)), "_keep": keep})
    for level, bucket, bit in ((0, F.col("_b"), _low(F.col(seq))), (1, _high(F.col("_b")), _low(F.col("_b")))):
        own = state.where(F.col("level") == level).select(
            F.col("name").alias("_n"), F.col("uuid").alias("_u"), F.col("bucket").alias("_k"), F.col("bits").alias("_bits"))
        out = out.join(own, (F.col(pipe) == F.col("_n")) & (F.col(uuid) == F.col("_u")) & (bucket == F.col("_k")) & ~F.col("_keep")
                       & has_bit(F.col("_bits"), bit), "left_anti")
    return out.drop("_b", "_keep")
