"""Language identification by interpolated Kneser-Ney character models.

Per language, n-grams of up to ``ORDER`` characters over a common alphabet (the
``ALPHABET`` most frequent letters of the training rows; every other letter is
one symbol, anything else a word boundary).  The highest order keeps its counts
and lower orders the number of different characters seen before an n-gram, each
with an absolute discount that passes to the next lower order.

Counting reads every training row: tasks sum n-grams in arrays over the key
space (ALPHABET + 2 symbols, so at most 42 ** 4 keys) and Spark sums those.  A
model is two sorted arrays per order, hashes and statistics, looked up by binary
search; what tasks receive is bounded by the key space whatever the corpus, and
``MODEL_BYTES`` checks it.  A task keeps the probabilities it has looked up.

The language of the lowest cross-entropy per character wins.  The score is its
calibrated share against the others; ``rejected`` tells a text whose
cross-entropy no language explains.  Temperature and rejection are calibrated
on every training row: cross-entropies are written once for all rows, tasks sum
each temperature's loss, and the rejection's quantile is found by counting.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
equal cross-entropies go to the first language by name; rows of null language
aren't learned from; without training rows every text is ``und``; a null doc_id
is not held out and is learned from; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, written

ORDER = 4
ALPHABET = 40
BASE = ALPHABET + 2
HOLD_MOD, HOLD_REST = 5, 0
#: Temperatures that are tried.
SCALES = np.geomspace(0.05, 20, 30)
#: Share of training rows that rejection may take.
REJECT_SHARE = 0.001
MODEL_BYTES = 1 << 30
UNKNOWN = "und"
CHUNK_CHARS = 1 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)


def _hash(keys: np.ndarray) -> np.ndarray:
    """A one-to-one spread of n-gram keys (multiplication by an odd number)."""
    return keys.astype(np.uint64) * _MUL


def _letters_table(alphabet: str) -> np.ndarray:
    """Symbol of every code point: 0 boundary, 1 other letter, then letters."""
    import sys

    out = np.zeros(sys.maxunicode + 1, np.int8)
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            out[c] = 1
    for i, ch in enumerate(alphabet):
        for x in (ch, ch.upper()):
            if len(x) == 1:
                out[ord(x)] = 2 + i
    return out


class Symbols:
    """Texts to symbol arrays; runs of boundaries are one boundary."""

    def __init__(self, alphabet: str):
        self.table = _letters_table(alphabet)

    def keys(self, texts: list[str]):
        """(n-gram key ending at each symbol, row of each, letters per row)."""
        parts = [np.frombuffer((" " + t + " ").encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        code = self.table[np.concatenate(parts)].astype(np.int32)
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        letters = np.bincount(row[code > 0], minlength=len(parts))
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] > 0) | (code[:-1] > 0) | (row[1:] != row[:-1])
        code, row = code[keep], row[keep]
        key = code.copy()
        for back in range(1, ORDER):
            # symbols before a row's beginning are boundaries: rows start with one
            earlier = np.zeros_like(code)
            earlier[back:] = np.where(row[back:] == row[:-back], code[:-back], 0)
            key += earlier * BASE ** back
        counted = np.ones(len(code), bool)
        counted[1:] = row[1:] == row[:-1]
        counted[:1] = False  # a row's leading boundary is context only
        return key[counted], row[counted], letters


def _chunks(texts: list):
    """Runs of at most CHUNK_CHARS characters, one text at least."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j] or "") <= CHUNK_CHARS):
            size += len(texts[j] or "")
            j += 1
        yield i, j
        i = j


def alphabet(train: DataFrame) -> str:
    """The most frequent letters of the training rows (ties by code point)."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(0, np.int64)
        for b in batches:
            texts = b.column("text").to_pylist()
            for i, j in _chunks(texts):
                n = np.bincount(np.frombuffer("".join(t or "" for t in texts[i:j]).lower().encode("utf-32-le", "surrogatepass"),
                                              np.uint32))
                if len(n) > len(total):
                    total = np.concatenate([total, np.zeros(len(n) - len(total), np.int64)])
                total[:len(n)] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["code", "n"])

    rows = train.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    letters = [(-r["n"], r["code"]) for r in rows if chr(r["code"]).isalpha()]  # one row per character at most
    return "".join(chr(c) for _, c in sorted(letters)[:ALPHABET])


def ngram_counts(train: DataFrame, letters: str) -> DataFrame:
    """(lang, key, n) of the highest order over every training row."""
    def run(batches):
        import pyarrow as pa

        symbols, held = Symbols(letters), {}
        for b in batches:
            by: dict = {}
            for t, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                if t:
                    by.setdefault(lang, []).append(t)
            for lang, texts in by.items():
                total = held.setdefault(lang, np.zeros(BASE ** ORDER, np.int32))
                for i, j in _chunks(texts):
                    total += np.bincount(symbols.keys(texts[i:j])[0], minlength=BASE ** ORDER).astype(np.int32)
        for lang, total in held.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                              pa.array(total[at], pa.int64())], names=["lang", "key", "n"])
    return train.select("lang", "text").mapInArrow(run, "lang string, key int, n long").groupBy("lang", "key").agg(
        F.sum("n").alias("n"))


class Model:
    """One language: per order, n-gram hashes (sorted) with their counts, and
    context hashes (sorted) with total and number of followers."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.grams, self.contexts, self.discounts = [], [], []
        counts = counts.astype(np.float64)
        for order in range(ORDER, 0, -1):
            ones, twos = (counts == 1).sum(), (counts == 2).sum()
            self.discounts.append(float(min(0.95, max(0.1, ones / (ones + 2 * twos) if ones else 0.5))))
            self.grams.append(self._sorted(keys, counts))
            ctx, at = np.unique(keys // BASE, return_inverse=True)
            self.contexts.append(self._sorted(ctx, np.bincount(at, counts), np.bincount(at).astype(np.float64)))
            # lower order: different characters before the n-gram
            keys, counts = np.unique(keys % BASE ** (order - 1), return_counts=True)
            counts = counts.astype(np.float64)

    @staticmethod
    def _sorted(keys, *stats):
        h = _hash(keys)
        order = np.argsort(h)
        return (h[order], *(s[order].astype(np.float32) for s in stats))

    @staticmethod
    def _find(table, keys):
        h = _hash(keys)
        at = np.minimum(np.searchsorted(table[0], h), len(table[0]) - 1)
        found = table[0][at] == h
        return [np.where(found, s[at], 0) for s in table[1:]]

    def log_prob(self, keys: np.ndarray) -> np.ndarray:
        """Natural logarithm of the last character's probability after the others."""
        p = np.full(len(keys), 1.0 / BASE)
        for i in range(ORDER - 1, -1, -1):  # from single characters up
            order = ORDER - i
            k = keys % BASE ** order
            (c,), (total, kinds) = self._find(self.grams[i], k), self._find(self.contexts[i], k // BASE)
            d = self.discounts[i]
            seen = total > 0
            t = np.where(seen, total, 1)
            p = np.where(seen, np.maximum(c - d, 0) / t + d * kinds / t * p, p)
        return np.log(p)

    def nbytes(self) -> int:
        return sum(a.nbytes for t in (*self.grams, *self.contexts) for a in t)


class Memo:
    """Probabilities of the n-grams a task has met, one array per language."""

    def __init__(self, models: dict[str, Model]):
        self.models = [models[x] for x in sorted(models)]
        self.known = np.zeros(BASE ** ORDER, bool)
        self.log = np.zeros((len(models), BASE ** ORDER), np.float32)

    def cross_entropy(self, keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """(rows, languages): mean negative log probability per character."""
        new = np.unique(keys[~self.known[keys]])
        if len(new):
            for log, m in zip(self.log, self.models, strict=True):
                log[new] = m.log_prob(new.astype(np.int64))
            self.known[new] = True
        n = np.bincount(row, minlength=rows)
        if not self.models:
            return np.zeros((rows, 0))
        return np.stack([-np.bincount(row, log[keys], rows) / np.maximum(n, 1) for log in self.log], 1)


def train_rows(docs: DataFrame) -> DataFrame:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                      F.col("lang").cast("string").alias("lang"))
    return own.where(_learned())


def _learned():
    return (F.col("lang").isNotNull() & F.col("text").isNotNull()
            & F.coalesce(crc_mod(F.col("doc_id"), HOLD_MOD) != HOLD_REST, F.lit(True)))


def fit(docs: DataFrame):
    """(alphabet, {language: Model}) from every training row."""
    train = train_rows(docs)
    letters = alphabet(train)
    counts = written(ngram_counts(train, letters), "ngrams")
    models = {}
    for r in counts.groupBy("lang").count().collect():  # one language's keys at a time; at most BASE ** ORDER
        rows = counts.where(F.col("lang") == r["lang"]).select("key", "n").toArrow()
        order = np.argsort(rows.column("key").to_numpy())
        models[r["lang"]] = Model(rows.column("key").to_numpy()[order].astype(np.int64), rows.column("n").to_numpy()[order])
    if sum(m.nbytes() for m in models.values()) > MODEL_BYTES:
        raise ValueError("too many languages for one broadcast; lower ORDER or ALPHABET")
    return letters, models


def _entropies(rows: DataFrame, held, keep: list[str], ddl: str) -> DataFrame:
    """``keep`` columns, letters and one cross-entropy per language."""
    def run(batches):
        import pyarrow as pa

        letters, models = held.value
        symbols, memo = Symbols(letters), Memo(models)
        for b in batches:
            texts = b.column("text").to_pylist()
            n, ce = [np.zeros(0, np.int64)], [np.zeros((0, len(models)))]
            for i, j in _chunks(texts):
                key, row, own = symbols.keys([t or "" for t in texts[i:j]])
                n.append(own)
                ce.append(memo.cross_entropy(key, row, j - i))
            table = np.concatenate(ce)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()),
                                            pa.array(table.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(np.concatenate(n), pa.int64()), flat],
                                             names=[*keep, "letters", "entropies"])
    return rows.select(*keep, "text").mapInArrow(run, f"{ddl}, letters long, entropies array<double>")


def _ranked(low: DataFrame, rank: int) -> float:
    """The value of 0-based ``rank`` of the only column, exact: the bin that holds
    it is cut again until all its values are equal."""
    name, at, width = low.columns[0], 0.0, 1 / 1024
    while True:
        bins = low.groupBy(F.floor((F.col(name) - at) / width).alias("b")).agg(
            F.count(F.lit(1)).alias("n"), F.min(name).alias("first"), F.max(name).alias("last")).orderBy("b").collect()
        for r in bins:
            if rank < r["n"]:
                break
            rank -= r["n"]
        if r["first"] == r["last"]:
            return r["first"]
        low = low.where(F.col(name).between(r["first"], r["last"]))
        at, width = r["first"], (r["last"] - r["first"]) / 1024
        if not width:  # neighbouring numbers
            return sorted([r["first"], r["last"]])[rank >= low.where(F.col(name) == r["first"]).count()]


def _calibrate(rows: DataFrame, names: list[str]) -> tuple[float, float]:
    """(temperature, cross-entropy above which a text is rejected) from every row:
    lang, letters, entropies of the training texts with a letter."""
    def run(batches):
        import pyarrow as pa

        total = [0] * len(SCALES)
        for b in batches:
            if not b.num_rows:
                continue
            ce = b.column("entropies").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            own = np.array([names.index(x) for x in b.column("lang").to_pylist()])
            weight = np.sqrt(b.column("letters").to_numpy(zero_copy_only=False).astype(float))[:, None]
            for i, scale in enumerate(SCALES):
                z = -ce * weight * scale
                z -= z.max(1, keepdims=True)
                loss = np.log(np.exp(z).sum(1)) - z[np.arange(len(own)), own]
                total[i] += int(np.rint(loss * 1e6).astype(np.int64).sum())  # whole numbers: their sum has no order
        yield pa.RecordBatch.from_arrays([pa.array(range(len(SCALES)), pa.int32()), pa.array(total, pa.int64())], names=["i", "loss"])

    n = rows.count()
    if not n:
        return 20.0, float("inf")
    losses = rows.select("lang", "letters", "entropies").mapInArrow(run, "i int, loss long").groupBy("i").agg(
        F.sum(F.col("loss").cast("decimal(38,0)")).alias("loss")).collect()
    scale = min((r["loss"], float(SCALES[r["i"]])) for r in losses)[1]
    low, place = rows.select(F.array_min("entropies").alias("low")), (n - 1) * (1 - REJECT_SHARE)
    below = _ranked(low, int(place))
    above = _ranked(low, int(place) + 1) if place > int(place) else below
    return scale, float(below + (place - int(place)) * (above - below)) * 1.05


def identified(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, cross_entropy, rejected."""
    spark = docs.sparkSession
    letters, models = fit(docs)
    names = sorted(models)
    held = spark.sparkContext.broadcast((letters, models))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    # the language of rows that are learned from, for the calibration alone
    rows = rows.withColumn("lang", F.when(_learned(), F.col("lang")))
    out = written(_entropies(rows, held, ["doc_id", "lang"], "doc_id long, lang string"), "entropies")
    scale, reject = _calibrate(out.where("lang is not null and letters > 0"), names) if names else (1.0, float("inf"))
    least = F.array_min("entropies")
    share = F.aggregate("entropies", F.lit(0.0),
                        lambda s, e: s + F.exp((least - e) * F.sqrt("letters") * F.lit(scale)), lambda s: 1 / s)
    known = F.col("letters") > 0 if names else F.lit(False)
    lang = F.element_at(F.array(*[F.lit(x) for x in names or [UNKNOWN]]),
                        F.array_position("entropies", least).cast("int") if names else F.lit(1))
    out_held = F.coalesce(crc_mod(F.col("doc_id"), HOLD_MOD) == HOLD_REST, F.lit(False))
    return out.select("doc_id", out_held.alias("held_out"), F.when(known, lang).otherwise(UNKNOWN).alias("lang_pred"),
                      F.when(known, share).otherwise(0.0).alias("score"), F.when(known, least).alias("cross_entropy"),
                      F.coalesce(~known | (least > F.lit(reject)), F.lit(True)).alias("rejected"))
