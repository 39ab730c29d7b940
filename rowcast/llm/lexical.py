"""Ranked lexical search: documents scanned by an Aho-Corasick automaton.

The terms of all items, each between two guard spaces, are one automaton that is
broadcast.  A document's bytes are brought to the same form (A-Z lower-cased, every
byte that is no part of a term a space), so a guarded term matches exactly where it
stands as a whole term, and the automaton's outputs count tf straight from the
text.  There is no index of documents: one scan sums the corpus statistics (N, L,
df; partial sums per task), a second one scores.  An output leads to the items that
hold the term, and each task keeps the ten best documents per item.

An automaton has at most ``MAX_BYTES`` of term text (or one item's); the items of a
larger benchmark are cut into blocks by a hash, with one automaton and one pair of
scans each, so what is broadcast never follows the benchmark.

Defined cases: a null or empty text has no term, and no document matches an item
without terms; a null doc_id counts as the largest among equal scores; repeated
documents are ranked each; a repeated item, also one with a null id, has a list of
its own; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, written

TOP = 10
#: Term bytes of one automaton, at most (about 40 bytes of memory each).
MAX_BYTES = 1 << 21
#: Cells of the score matrix of documents and items that are held at once.
CELLS = 1 << 21
#: A task's lists are merged in so many groups first.
GROUPS = 64

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
#: Bytes as the automaton reads them: terms' in lower case, all others a space.
_FORM = np.full(256, ord(" "), np.uint8)
_FORM[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _FORM[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _FORM[_c] = _c + 32
_LAST = np.iinfo(np.int64).max

COUNTS_DDL = "term int, df long, terms long, docs long"
FOUND_DDL = "item int, doc_id long, score long"


def terms(text: str | None) -> list[str]:
    """The terms of a text, in order, with repeats."""
    return _TERM.findall((text or "").translate(_LOWER))


class Automaton:
    """All terms of some items: term numbers by an Aho-Corasick automaton (built
    where it is first used), and a term's items with its repeats in each."""

    def __init__(self, items: list[list[str]]):
        self.terms = sorted({t for item in items for t in item})
        number = {t: i for i, t in enumerate(self.terms)}
        pairs: dict[tuple[int, int], int] = {}
        for k, item in enumerate(items):
            for t in item:
                pairs[number[t], k] = pairs.get((number[t], k), 0) + 1
        order = sorted(pairs)
        self.items = len(items)
        self.item = np.array([k for _, k in order], np.int64)
        self.repeats = np.array([pairs[p] for p in order], np.int64)
        self.starts = np.searchsorted(np.array([t for t, _ in order], np.int64), np.arange(len(self.terms) + 1))
        self._machine = None

    def __getstate__(self):
        return self.__dict__ | {"_machine": None}

    @property
    def machine(self):
        if self._machine is None:
            import ahocorasick

            self._machine = ahocorasick.Automaton()
            for i, t in enumerate(self.terms):
                self._machine.add_word(f" {t} ", i)
            self._machine.make_automaton()
        return self._machine

    def counted(self, column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of a column of texts: (terms per text), and (text, term, tf) of the
        terms that the automaton knows."""
        body, offsets = binary_rows(column)
        form = _FORM[body]
        inside = form != ord(" ")
        begins = inside & np.r_[True, ~inside[:-1]]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text's first byte follows no other text
        begins[heads] = inside[heads]
        sums = np.r_[0, np.cumsum(begins)]
        lengths = sums[offsets[1:]] - sums[offsets[:-1]]
        raw = form.tobytes()
        texts, found, counts = [], [], []
        if self.terms:
            scan = self.machine.iter
            for d, n in enumerate(lengths.tolist()):
                if not n:
                    continue
                text = raw[offsets[d]:offsets[d + 1]].decode("utf-8", "surrogateescape")
                hits = np.fromiter((i for _, i in scan(f" {text} ")), np.int32)
                if len(hits):
                    own, tf = np.unique(hits, return_counts=True)
                    texts.append(np.full(len(own), d))
                    found.append(own)
                    counts.append(tf)
        if not texts:
            none = np.empty(0, np.int64)
            return lengths, none, none, none
        return lengths, np.concatenate(texts), np.concatenate(found).astype(np.int64), np.concatenate(counts)


class Scorer:
    """An automaton with its terms' weights and the corpus's N and L."""

    def __init__(self, automaton: Automaton, df: np.ndarray, n_docs: int, n_terms: int):
        self.automaton, self.n_docs, self.n_terms = automaton, n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        a = automaton
        most = np.bincount(a.item, weights=a.repeats * self.weights[np.repeat(np.arange(len(df)), np.diff(a.starts))], minlength=1)
        self.plain = float(most.max(initial=0)) * 1e6 < 2.0 ** 52  # sums are exact in doubles

    def scores(self, lengths, texts, found, tf):
        """(text, item, score) of a column's texts, score above 0."""
        m = 100 - 75 + (75 * lengths[texts] * self.n_docs) // max(1, self.n_terms)
        gains = self.weights[found] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        a = self.automaton
        first, many = a.starts[found], a.starts[found + 1] - a.starts[found]
        at = np.repeat(first - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
        value = np.repeat(gains, many) * a.repeats[at]
        cell = np.repeat(texts, many) * a.items + a.item[at]
        if not len(cell):
            return cell, cell, cell
        base = int(cell.min())
        if self.plain and int(cell.max()) - base < 8 * len(cell) + CELLS:
            sums = np.bincount(cell - base, weights=value).astype(np.int64)
            got = np.flatnonzero(sums)
            return (got + base) // a.items, (got + base) % a.items, sums[got]
        order = np.argsort(cell, kind="stable")
        starts = np.flatnonzero(np.r_[True, cell[order][1:] != cell[order][:-1]])
        sums, keys = np.add.reduceat(value[order], starts), cell[order][starts]
        keys, sums = keys[sums > 0], sums[sums > 0]
        return keys // a.items, keys % a.items, sums


class Lists:
    """The best ``k`` (score, doc_id) of each item so far."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.zeros(items, np.int64)
        self.least_id = np.full(items, _LAST)
        self.rows = tuple(np.empty(0, np.int64) for _ in range(3))  # item, doc_id, score

    def add(self, item, ids, score) -> None:
        better = (score > self.least[item]) | ((score == self.least[item]) & (ids < self.least_id[item]))
        item, ids, score = (np.r_[a, b[better]] for a, b in zip(self.rows, (item, ids, score), strict=True))
        order = np.lexsort((ids, -score, item))
        item, ids, score = item[order], ids[order], score[order]
        starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.empty(0, np.int64)
        place = np.arange(len(item)) - np.repeat(starts, np.diff(np.r_[starts, len(item)]))
        last = place == self.k - 1
        self.least[item[last]], self.least_id[item[last]] = score[last], ids[last]
        self.rows = tuple(x[place < self.k] for x in (item, ids, score))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def statistics(docs: DataFrame, automaton: Automaton) -> tuple[np.ndarray, int, int]:
    """(df per term, N, L): one scan; a task sends a row per term."""
    held = docs.sparkSession.sparkContext.broadcast(automaton)

    def run(batches):
        import pyarrow as pa

        a = held.value
        df, total, some = np.zeros(len(a.terms), np.int64), 0, 0
        for b in batches:
            lengths, _, found, _ = a.counted(b.column("text"))
            df += np.bincount(found, minlength=len(df))
            total, some = total + int(lengths.sum()), some + int((lengths > 0).sum())
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[seen, -1], pa.int32()), pa.array(np.r_[df[seen], 0]), pa.array(np.r_[0 * seen, total]),
             pa.array(np.r_[0 * seen, some])], names=["term", "df", "terms", "docs"])

    sums = _texts(docs).select("text").mapInArrow(run, COUNTS_DDL).groupBy("term").agg(
        F.sum("df").alias("df"), F.sum("terms").alias("terms"), F.sum("docs").alias("docs")).toArrow()
    df, n, total = np.zeros(len(automaton.terms), np.int64), 0, 0
    for t, x, terms_, docs_ in zip(*(sums.column(c).to_pylist() for c in ("term", "df", "terms", "docs")), strict=True):
        if t < 0:
            n, total = docs_, terms_
        else:
            df[t] = x
    return df, n, total


def best_documents(docs: DataFrame, scorer: Scorer, k: int) -> DataFrame:
    """(item, doc_id, score): each task's best ``k`` documents per item."""
    held = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches):
        import pyarrow as pa

        s = held.value
        lists = Lists(s.automaton.items, k)
        for b in batches:
            ids = np.asarray(b.column("doc_id").fill_null(_LAST), np.int64)
            text, item, score = s.scores(*s.automaton.counted(b.column("text")))
            lists.add(item, ids[text], score)
        item, ids, score = lists.rows
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
                                         names=["item", "doc_id", "score"])
    found = _texts(docs).mapInArrow(run, FOUND_DDL)
    # a null id has travelled as the largest number; tasks' lists meet in two steps
    order = "order by score desc, doc_id"
    some = found.withColumn("part", F.spark_partition_id() % GROUPS).selectExpr(
        "*", f"row_number() over (partition by item, part {order}) as place").where(F.col("place") <= k)
    return some.selectExpr("item", "doc_id", "score", f"cast(row_number() over (partition by item {order}) as int) as rank").where(
        F.col("rank") <= k).withColumn("doc_id", F.nullif("doc_id", F.lit(int(_LAST))))


def _blocks(items: DataFrame) -> DataFrame:
    """Items with their block; a block has at most MAX_BYTES of text, or one item."""
    size = F.octet_length("text")
    sized = items.withColumn("size", size)
    total, n = sized.agg(F.sum("size"), F.count(F.lit(1))).first()
    blocks = max(1, -(-(total or 0) // MAX_BYTES))
    while True:
        cut = sized.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        over = cut.groupBy("block").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).where(
            (F.col("size") > MAX_BYTES) & (F.col("n") > 1))
        if over.isEmpty():
            return cut
        blocks *= 2


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    items = written(benchmark.select(F.monotonically_increasing_id().alias("row"), F.col("item_id").cast("long").alias("item_id"),
                                     F.col("text").cast("string").alias("text")).where("text is not null"), "search-items")
    cut = _blocks(items)
    out = None
    for (block,) in cut.select("block").distinct().orderBy("block").collect():
        own = cut.where(F.col("block") == block).select("item_id", "text").toArrow()  # MAX_BYTES, or one item
        automaton = Automaton([terms(t) for t in own.column("text").to_pylist()])
        scorer = Scorer(automaton, *statistics(docs, automaton))
        names = spark.createDataFrame(list(enumerate(own.column("item_id").to_pylist())), "item int, item_id long")
        found = best_documents(docs, scorer, k).join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = written(found, "search-found")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
