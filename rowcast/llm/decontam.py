"""Benchmark decontamination by greedy string tiling.

Words are lower-cased runs of letters and digits.  Seeds, the hashes of
``MIN_MATCH`` words in a row (all of a shorter item), find the pairs of document
and benchmark item that share one.  Each pair is tiled: running Karp-Rabin
hashes give all matches of unmarked words, the longest are marked, and so on
until none of ``MIN_MATCH`` words is left, so passages are found in any order
and with pieces between them.  A document whose tiles cover at least
``COVERAGE`` of an item's words is contaminated by it.

Seeds travel to the documents (one pass, no shuffle) while the benchmark has at
most ``MAX_WORDS`` words; a larger one is joined on its seeds.  Both ways tile
the same pairs.

Defined cases: a null or empty text is clean; items without words match
nothing; a repeated item is listed once per distinct id; an item with a null id
contaminates but isn't listed; an empty benchmark leaves all documents clean; an
empty table gives an empty result; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import texthash
from .common import binary_rows, written

MIN_MATCH = 5
COVERAGE = 0.5
#: Benchmark words that are sent to every task, at most (8 bytes each, twice).
MAX_WORDS = 4_000_000

#: Bytes that part words: white space and ASCII punctuation.
_PARTS = np.zeros(256, bool)
_PARTS[:128] = True
_PARTS[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = False

RESULT_DDL = "contaminated boolean, coverage double, item_ids array<long>"


def matches(a: np.ndarray, b: np.ndarray, hits, free_a, free_b, least: int):
    """Maximal matches (length, a start, b start) of unmarked words; ``hits``
    are pairs of starts with equal Karp-Rabin hashes of ``least`` words."""
    out, done = [], {}
    for i, j in hits:  # ordered by i: a hit inside its diagonal's last match says nothing new
        if i < done.get(i - j, -1):
            continue
        n = 0
        while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
            n += 1
        if n >= least:
            out.append((n, i, j))
            done[i - j] = i + n - least + 1
    return out


#: Pairs of equal seeds that are listed for one document and item; texts that
#: repeat themselves more are tiled along the diagonals, in bounded memory.
MAX_HITS = 50_000


def _longest(a: np.ndarray, b: np.ndarray, free_a: np.ndarray, free_b: np.ndarray):
    """(length, starts in a, starts in b) of the longest matches of unmarked words.

    The match that begins at (i, j) is one longer than that at (i + 1, j + 1), so
    one row of lengths per word of ``b`` is enough, from the last word back.  Of a
    word of ``b`` the first ``2 * len(b) + 1`` starts in ``a`` are enough: tiles of
    this length block fewer, so one of them is free when it is asked for."""
    top, starts = 0, []
    after = np.zeros(len(a) + 1, np.int32)
    for j in range(len(b) - 1, -1, -1):
        row = np.zeros(len(a) + 1, np.int32)
        if free_b[j]:
            same = (a == b[j]) & free_a
            row[:-1][same] = after[1:][same] + 1
            most = int(row.max())
            if most and most >= top:
                if most > top:
                    top, starts = most, []
                at = np.flatnonzero(row == most)[:2 * len(b) + 1]
                starts.append((at, np.full(len(at), j)))
        after = row
    if not top:
        return 0, np.empty(0, np.int64), np.empty(0, np.int64)
    i, j = (np.concatenate(x) for x in zip(*starts, strict=True))
    order = np.lexsort((j, i))
    return top, i[order], j[order]


def _tile_diagonals(a: np.ndarray, b: np.ndarray, least: int) -> int:
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    while True:
        n, starts_a, starts_b = _longest(a, b, free_a, free_b)
        if n < least:
            return int((~free_b).sum())
        for i, j in zip(starts_a.tolist(), starts_b.tolist(), strict=True):
            if free_b[j] and free_a[i] and free_a[i:i + n].all() and free_b[j:j + n].all():
                free_a[i:i + n] = free_b[j:j + n] = False
        if not free_b.any():
            return len(b)


def tile(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Words of ``b`` covered by greedy tiles of at least ``least`` words."""
    least = min(least, len(b))
    if not least or len(a) < least:
        return 0
    own, grams = texthash.ngrams(b, least), texthash.ngrams(a, least)
    order = np.argsort(own, kind="stable")
    sorted_own = own[order]
    lo, hi = np.searchsorted(sorted_own, grams, "left"), np.searchsorted(sorted_own, grams, "right")
    if int((hi - lo).sum()) > MAX_HITS:
        return _tile_diagonals(a, b, least)
    hits = [(int(i), int(j)) for i in np.flatnonzero(hi > lo) for j in order[lo[i]:hi[i]]]
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    while hits and (found := matches(a, b, hits, free_a, free_b, least)):
        longest = max(found)[0]
        for n, i, j in found:
            if n == longest and free_a[i:i + n].all() and free_b[j:j + n].all():
                free_a[i:i + n] = free_b[j:j + n] = False
        hits = [(i, j) for i, j in hits if free_a[i] and free_b[j]]
    return int((~free_b).sum())


def _word_hashes(column) -> list[np.ndarray]:
    """Word hashes of each row of a string column."""
    body, offsets = binary_rows(column)
    out = []
    for i, j in texthash.ranges(offsets):
        row, h, _, _ = texthash.words(body[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], ~_PARTS)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=j - i))])
        out += [h[bounds[r]:bounds[r + 1]] for r in range(j - i)]
    return out


def _seeds(h: np.ndarray, least: int) -> np.ndarray:
    return np.unique(texthash.ngrams(h, least) + np.uint64(least))


class Benchmark:
    """Items as word hashes, and a sorted array of seeds with their items."""

    def __init__(self, ids: list, hashes: list[np.ndarray]):
        kept = [(i, h) for i, h in zip(ids, hashes, strict=True) if len(h)]
        self.ids, self.words = [i for i, _ in kept], [h for _, h in kept]
        self.lengths = sorted({min(MIN_MATCH, len(h)) for h in self.words})
        own = [_seeds(h, min(MIN_MATCH, len(h))) for h in self.words]
        seed = np.concatenate(own) if own else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(own)), [len(x) for x in own])
        order = np.argsort(seed, kind="stable")
        self.seed, self.item = seed[order], item[order]

    def candidates(self, h: np.ndarray) -> list[int]:
        """Items that share a seed with the words ``h``."""
        got: set[int] = set()
        for least in self.lengths:
            s = texthash.ngrams(h, least) + np.uint64(least)
            a, b = np.searchsorted(self.seed, s, "left"), np.searchsorted(self.seed, s, "right")
            for x, y in {*zip(a[a < b].tolist(), b[a < b].tolist(), strict=True)}:
                got.update(self.item[x:y].tolist())
        return sorted(got)

    def judge(self, h: np.ndarray):
        """(contaminated, best coverage, ids of the contaminating items)."""
        best, ids, bad = 0.0, set(), False
        for k in self.candidates(h):
            c = tile(h, self.words[k], MIN_MATCH) / len(self.words[k])
            best = max(best, c)
            if c >= COVERAGE:
                bad = True
                if self.ids[k] is not None:
                    ids.add(self.ids[k])
        return bad, best, sorted(ids)


def _lowered(df: DataFrame, *keep: str) -> DataFrame:
    return df.select(*keep, F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))


def _items(benchmark: DataFrame) -> DataFrame:
    return _lowered(benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id")


def _by_broadcast(docs: DataFrame, bench: Benchmark, keep: list[str], schema: str, filtering: bool) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(bench)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [held.value.judge(h) for h in _word_hashes(b.column("words"))]
            if filtering:
                yield b.filter(pa.array([not g[0] for g in got], pa.bool_())).select(keep)
                continue
            cols = list(zip(*got, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in keep), pa.array(cols[0], pa.bool_()), pa.array(cols[1], pa.float64()),
                 pa.array(cols[2], pa.list_(pa.int64()))], names=[*keep, "contaminated", "coverage", "item_ids"])
    return docs.mapInArrow(run, schema)


def _by_join(rows: DataFrame, items: DataFrame) -> DataFrame:
    """(text_key, contaminated, coverage, item_ids) of texts that share a seed,
    for a benchmark of any size: seeds are joined, then pairs tiled."""
    lengths = [r[0] for r in items.mapInArrow(_item_lengths, "least int").distinct().collect()]  # MIN_MATCH at most

    def seeds(column, key, ddl, all_lengths):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                for k, h in zip(b.column(key).to_pylist(), _word_hashes(b.column("words")), strict=True):
                    own = lengths if all_lengths else [min(MIN_MATCH, len(h))] if len(h) else []
                    s = np.unique(np.concatenate([_seeds(h, n) for n in own])) if own else np.empty(0, np.uint64)
                    yield pa.RecordBatch.from_arrays([pa.array([k] * len(s), pa.int64()), pa.array(s.view(np.int64))],
                                                     names=[key, "seed"])
        return column.mapInArrow(run, ddl)

    items = items.withColumn("item_key", F.xxhash64("item_id", "words"))
    doc_seeds = seeds(rows, "text_key", "text_key long, seed long", True)
    item_seeds = seeds(items.dropDuplicates(["item_key"]), "item_key", "item_key long, seed long", False)
    pairs = doc_seeds.join(item_seeds, "seed").select("text_key", "item_key").distinct()
    full = (pairs.join(rows.dropDuplicates(["text_key"]), "text_key")
            .join(items.dropDuplicates(["item_key"]).select("item_key", "item_id", F.col("words").alias("item")), "item_key"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            cover = [tile(x, y, MIN_MATCH) / len(y) for x, y in zip(_word_hashes(b.column("words")),
                                                                    _word_hashes(b.column("item")), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("text_key"), b.column("item_id"), pa.array(cover, pa.float64())],
                                             names=["text_key", "item_id", "cover"])
    covers = full.select("text_key", "item_id", "words", "item").mapInArrow(run, "text_key long, item_id long, cover double")
    return covers.groupBy("text_key").agg(
        (F.max("cover") >= COVERAGE).alias("contaminated"), F.max("cover").alias("coverage"),
        F.array_sort(F.collect_set(F.when(F.col("cover") >= COVERAGE, F.col("item_id")))).alias("item_ids"))


def _item_lengths(batches):
    import pyarrow as pa

    for b in batches:
        n = [min(MIN_MATCH, len(h)) for h in _word_hashes(b.column("words"))]
        yield pa.RecordBatch.from_arrays([pa.array([x for x in n if x], pa.int32())], names=["least"])


def _loaded(items: DataFrame, max_words: int) -> Benchmark | None:
    """The benchmark, if it is small enough for every task."""
    words = items.select(F.sum(F.size(F.split("words", r"[^\p{L}\p{N}]+")) + 1)).first()[0] or 0
    if words > max_words:
        return None
    rows = items.toArrow()
    column = rows.column("words").combine_chunks()
    return Benchmark(rows.column("item_id").to_pylist(), _word_hashes(column) if len(rows) else [])


def contamination(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, coverage (the best over the
    items), item_ids (sorted) of the items it leaks."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = _items(benchmark)
    bench = _loaded(items, max_words)
    if bench is not None:
        return _by_broadcast(_lowered(own, "doc_id"), bench, ["doc_id"], f"doc_id long, {RESULT_DDL}", False)
    rows = _lowered(own, "doc_id").withColumn("text_key", F.xxhash64("words"))
    found = _by_join(rows.select("text_key", "words"), items)
    return rows.select("doc_id", "text_key").join(found, "text_key", "left").select(
        "doc_id", F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """The rows of ``docs`` that leak no item, as they are."""
    items = _items(benchmark)
    bench = _loaded(items, max_words)
    names = docs.columns
    if bench is not None:
        # docs' own column named words, if any, is kept beside the lowered text
        frame = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)],
                            F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("words"))
        kinds = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
        return _by_broadcast(frame, bench, [f"c{i}" for i in range(len(names))], kinds, True).toDF(*names)
    key = F.xxhash64(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    bad = written(_by_join(_lowered(docs.select("text")).withColumn("text_key", F.xxhash64("words")), items)
                  .where("contaminated").select(F.col("text_key").alias("_leak")), "leaks")
    return docs.join(bad, key == F.col("_leak"), "left_anti")
