"""Exact de-duplication with a cuckoo-filter index of live digests.

The index is a table of buckets in the shared folder.  A bucket holds a cuckoo
filter over its digests and the stored keys themselves (full SHA-256, the row
that stays, the group's size).  Each insertion asks the filter first: a miss is
surely new; a hit is verified against the bucket's stored keys, so a false
positive is never taken for a copy.  Deleting a live digest removes its
fingerprint and its key.  When a kick chain overflows, the filter doubles and is
rebuilt from the stored keys.

The index decides what is a copy: rows are only summed within a piece of a task
(``HELD`` rows), so the copies of a text reach its bucket from many pieces, the
first is inserted, and each later one is a hit that is verified and merged.  The
index counts its hits, false positives and resizes.  A text held by a third of all
rows is one row per piece; digests are uniform, so buckets are even, and their
number follows the number of rows.

Defined cases: a null text is the empty text; a null doc_id counts as the
largest; of rows that tie on doc_id exactly one stays; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, written

#: Stored keys per bucket that the number of buckets is chosen for.
KEYS_PER_BUCKET = 20_000
SLOTS = 4
MAX_KICKS = 200
#: Rows that a task sums before it sends them to the index.
HELD = 100_000

COUNTERS = ("hits", "false_hits", "resizes")
INDEX_DDL = ("bucket int, capacity int, filter binary, digests binary, keep_ids array<long>, keep_rows array<long>, "
             "sizes array<long>, hits long, false_hits long, resizes long")
ENTRY_DDL = "digest binary, keep_id long, keep_row long, group_size long"


class CuckooFilter:
    """16-bit fingerprints, two candidate buckets of four slots (partial-key
    cuckoo hashing); capacity is a power of two."""

    def __init__(self, capacity: int, table: np.ndarray | None = None):
        self.capacity = capacity
        self.table = [0] * (capacity * SLOTS) if table is None else table.tolist()

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        fp = int.from_bytes(digest[:2], "little") or 1
        i = int.from_bytes(digest[2:8], "little") & (self.capacity - 1)
        return fp, i, self._other(i, fp)

    def _other(self, i: int, fp: int) -> int:
        return (i ^ (fp * 0x5BD1E995)) & (self.capacity - 1)

    def contains(self, digest: bytes) -> bool:
        fp, i, j = self._place(digest)
        t = self.table
        return fp in t[i * SLOTS:(i + 1) * SLOTS] or fp in t[j * SLOTS:(j + 1) * SLOTS]

    def _put(self, i: int, fp: int) -> bool:
        for s in range(i * SLOTS, (i + 1) * SLOTS):
            if not self.table[s]:
                self.table[s] = fp
                return True
        return False

    def insert(self, digest: bytes) -> bool:
        """False when the kick chain overflows; the caller resizes."""
        fp, i, j = self._place(digest)
        if self._put(i, fp) or self._put(j, fp):
            return True
        for k in range(MAX_KICKS):
            s = j * SLOTS + k % SLOTS
            fp, self.table[s] = self.table[s], fp
            j = self._other(j, fp)
            if self._put(j, fp):
                return True
        return False

    def delete(self, digest: bytes) -> None:
        fp, i, j = self._place(digest)
        for b in (i, j):
            for s in range(b * SLOTS, (b + 1) * SLOTS):
                if self.table[s] == fp:
                    self.table[s] = 0
                    return

    def dump(self) -> bytes:
        return np.array(self.table, dtype="<u2").tobytes()


class Bucket:
    """A filter, and the stored keys it answers for; it counts insertions that
    were hits, hits that weren't true, and overflows."""

    def __init__(self, row=None, expected: int = 0):
        self.keys: dict[bytes, list] = {}
        self.hits, self.false_hits, self.resizes = (int(row[c]) for c in COUNTERS) if row is not None else (0, 0, 0)
        if row is not None:
            d = bytes(row["digests"])
            for k, keep, at, n in zip(range(0, len(d), 32), row["keep_ids"], row["keep_rows"], row["sizes"], strict=True):
                self.keys[d[k:k + 32]] = [_int(keep), _int(at), int(n)]
            self.filter = CuckooFilter(int(row["capacity"]), np.frombuffer(bytes(row["filter"]), "<u2"))
        else:
            self.filter = CuckooFilter(max(16, 1 << (max(1, expected) * 10 // (9 * SLOTS)).bit_length()))

    def resize(self) -> None:
        size = self.filter.capacity
        while True:
            size *= 2
            self.resizes += 1
            self.filter = CuckooFilter(size)
            if all(self.filter.insert(k) for k in self.keys):
                return

    def insert(self, digest: bytes, keep, at, n: int) -> None:
        if self.filter.contains(digest):
            held = self.keys.get(digest)  # the hit is verified
            if held is not None:
                self.hits += 1
                held[2] += n
                if _rank(keep, at) < _rank(held[0], held[1]):
                    held[0], held[1] = keep, at
                return
            self.false_hits += 1
        self.keys[digest] = [keep, at, n]
        if not self.filter.insert(digest):
            self.resize()

    def delete(self, digest: bytes) -> None:
        if self.filter.contains(digest) and self.keys.pop(digest, None) is not None:
            self.filter.delete(digest)

    def lookup(self, digest: bytes):
        return self.keys.get(digest) if self.filter.contains(digest) else None

    def row(self, bucket: int) -> dict:
        return {"bucket": [bucket], "capacity": [self.filter.capacity], "filter": [self.filter.dump()],
                "digests": [b"".join(self.keys)], "keep_ids": [[v[0] for v in self.keys.values()]],
                "keep_rows": [[v[1] for v in self.keys.values()]], "sizes": [[v[2] for v in self.keys.values()]],
                **{c: [getattr(self, c)] for c in COUNTERS}}


def _int(x):
    return None if x is None or x != x else int(x)


def _rank(keep, at):
    return (keep is None, keep or 0, at if at is not None else 0)


def _schema(kind: str):
    import pyarrow as pa

    return pa.schema([("bucket", pa.int32()), ("capacity", pa.int32()), ("filter", pa.binary()), ("digests", pa.binary()),
                      ("keep_ids", pa.list_(pa.int64())), ("keep_rows", pa.list_(pa.int64())),
                      ("sizes", pa.list_(pa.int64())), *((c, pa.int64()) for c in COUNTERS)]) if kind == "index" else pa.schema(
        [("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()), ("group_size", pa.int64())])


def normalized(text: Column) -> Column:
    """Each run of white space is one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE + "+", " ")


def digest(text: Column) -> Column:
    """SHA-256 of the normalised text in UTF-8, 32 bytes."""
    return F.unhex(F.sha2(normalized(text).cast("binary"), 256))


class CuckooIndex:
    """Live digests in ``buckets`` cuckoo-filtered buckets (a DataFrame)."""

    def __init__(self, state: DataFrame, buckets: int):
        self.state, self.buckets = state, buckets

    @classmethod
    def sized(cls, spark, keys: int) -> CuckooIndex:
        """An empty index with buckets for about ``keys`` digests."""
        return cls(spark.createDataFrame([], INDEX_DDL), max(1, -(-keys // KEYS_PER_BUCKET)))

    def _keyed(self, batch: DataFrame) -> DataFrame:
        return batch.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(self.buckets)).cast("int"))

    def _apply(self, batch: DataFrame, change, name: str) -> CuckooIndex:
        def run(key, old, new):
            import pyarrow as pa

            rows = old.to_pylist()
            b = Bucket(rows[0] if rows else None, new.num_rows)
            change(b, new)
            return pa.table({k: pa.array(v, _schema("index").field(k).type) for k, v in b.row(key[0].as_py()).items()})

        state = self.state.groupBy("bucket").cogroup(self._keyed(batch).groupBy("bucket")).applyInArrow(run, INDEX_DDL)
        return CuckooIndex(written(state, name), self.buckets)

    def insert(self, batch: DataFrame) -> CuckooIndex:
        """``batch``: rows of digest, keep_id, keep_row, group_size, any number per
        digest."""
        def change(b, new):
            for r in zip(*(new.column(k).to_pylist() for k in ("digest", "keep_id", "keep_row", "group_size")), strict=True):
                b.insert(*r)
        return self._apply(batch.select("digest", "keep_id", "keep_row", "group_size"), change, "cuckoo-insert")

    def delete(self, batch: DataFrame) -> CuckooIndex:
        """Remove the digests of ``batch``; absent ones change nothing."""
        def change(b, new):
            for d in new.column("digest").to_pylist():
                b.delete(d)
        return self._apply(batch.select("digest"), change, "cuckoo-delete")

    def lookup(self, batch: DataFrame) -> DataFrame:
        """The entries of those digests of ``batch`` (distinct) that are live."""
        def run(key, old, new):
            import pyarrow as pa

            rows = old.to_pylist()
            b = Bucket(rows[0]) if rows else Bucket()
            hits = [(d, *held) for d in new.column("digest").to_pylist() if (held := b.lookup(d)) is not None]
            cols = list(zip(*hits, strict=True)) or [[], [], [], []]
            return pa.table([pa.array(c, f.type) for c, f in zip(cols, _schema("entry"), strict=True)],
                            schema=_schema("entry"))
        return self.state.groupBy("bucket").cogroup(
            self._keyed(batch.select("digest").distinct()).groupBy("bucket")).applyInArrow(run, ENTRY_DDL)

    def entries(self) -> DataFrame:
        """One row per live digest."""
        def run(batches):
            import pyarrow as pa

            for b in batches:
                for r in b.to_pylist():
                    d = r["digests"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([d[k:k + 32] for k in range(0, len(d), 32)], pa.binary()), pa.array(r["keep_ids"], pa.int64()),
                         pa.array(r["keep_rows"], pa.int64()), pa.array(r["sizes"], pa.int64())], schema=_schema("entry"))
        return self.state.mapInArrow(run, ENTRY_DDL)


def partials(rows: DataFrame) -> DataFrame:
    """(digest, doc_id, row) to (digest, keep_id, keep_row, group_size), summed in
    pieces of HELD rows, without a shuffle."""
    def summed(held):
        import pyarrow as pa

        t = pa.Table.from_batches(held)
        at = t.append_column("at", t.column("doc_id").fill_null(np.iinfo(np.int64).max)).sort_by([("at", "ascending"), ("row", "ascending")])
        g = at.group_by("digest", use_threads=False).aggregate([("doc_id", "first"), ("row", "first"), ("row", "count")])
        return pa.table([g.column(c) for c in ("digest", "doc_id_first", "row_first", "row_count")], schema=_schema("entry")).to_batches()

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= HELD:
                yield from summed(held)
                held, n = [], 0
        if n:
            yield from summed(held)
    return rows.select("digest", "doc_id", "row").mapInArrow(run, ENTRY_DDL)


def indexed(rows: DataFrame) -> CuckooIndex:
    """The index of all (digest, doc_id, row)."""
    return CuckooIndex.sized(rows.sparkSession, rows.count()).insert(partials(rows))


def duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept, digest."""
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
                   .withColumn("row", F.monotonically_increasing_id()), "digests")
    return (rows.join(indexed(rows).entries(), "digest")
            .select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each text, as it is: that of the smallest doc_id
    (of equal rows any one).  Rows meet the index's entries once, by digest and id,
    so a hot text's copies are spread; rows that tie on both meet there too."""
    names = docs.columns
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest(F.col("text")).alias("digest"))
                   .withColumn("row", F.lit(0).cast("long")), "digests")
    key = F.coalesce(F.col("id").cast("string"), F.lit(""))
    keep = indexed(rows).entries().select(F.col("digest").alias("k_own"), F.col("keep_id").alias("id")).withColumn("k_id", key).drop("id")
    named = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], digest(F.col("text")).alias("own"),
                        F.col("doc_id").cast("long").alias("id")).withColumn("id", key)
    first = named.join(keep, (F.col("own") == F.col("k_own")) & (F.col("id") == F.col("k_id")), "left_semi")
    return first.dropDuplicates(["own", "id"]).select(*[f"c{i}" for i in range(len(names))]).toDF(*names)
