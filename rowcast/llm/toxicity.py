"""Toxicity by a weighted finite-state pattern grammar.

Small transducers read the symbols of a clause: insult and threat mark what is
said, target, negation, reported speech and an insult before another (heaped) how.  ``compose`` makes one machine of
them (the reachable product of their states) whose arcs carry weights: an arc that
completes a match weighs what its kind of match (the marks of all parts together)
adds to the log-odds of toxicity.  A clause is what its best path says: the path
skips to one match and past it, weights add along it and the greatest wins (the
max-plus semiring).  So "not an idiot" and "he said idiot" weigh what negated and
reported insults weigh, not what the word does.  A document's log-odds add up its
clauses by kind; no weight is on words.

Words become symbols through a lexicon of short fixed lists and learned entries:
insults are words or stems that stand in many different contexts of toxic training
texts and in few of clean ones (contexts, so that copies of one text count once);
softeners (negators, reporters) and targets are words beside an insult that make
its clause mostly clean, or toxic.  Weights are fitted towards ``PRIOR``, so a kind
of match that the labels don't show keeps its prior weight.  Lexicon and weights
come from at most ``MAX_TRAIN`` labelled rows (chosen by a hash of the id when there
are more); every text is scored whole.  Labels, language, source and id are no
inputs of a score.

Defined cases: a null or empty text scores what a text without a match scores;
null labels aren't learned from; a doc_id labelled twice counts twice; without
labels of both kinds the fixed lists and ``PRIOR`` weights score; a null doc_id
is not held out; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, written

THRESHOLD = 0.3
HOLD_MOD, HOLD_REST = 4, 2
#: Labelled rows that lexicon and weights are learned from, at most (expected).
MAX_TRAIN = 200_000
#: A learned entry: share of the toxic training texts it occurs in at least,
#: contexts at least, and share of its texts (and contexts) that are toxic.
MIN_SHARE, MIN_COUNT, MIN_PURITY = 0.005, 4, 0.75
#: Letters of a learned stem; a word of the stem has SUFFIX more at most.
PREFIXES = (5, 6, 7, 8)
SUFFIX = 4
#: A word beside insults is a softener (target) if its clauses are at most a third
#: as often toxic (clean) as all clauses with an insult, over MIN_CLAUSES of them.
MIN_CLAUSES = 12

# The grammar's own words (general vocabulary).
INSULTS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic")
THREATS = ("kill", "hurt", "destroy", "punch", "shoot", "stab", "strangle")
TARGETS = ("you", "your", "yourself", "him", "them", "everyone", "dich", "euch", "vous", "ustedes")
NEGATIONS = ("not", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "pas", "jamais", "nunca")
REPORTS = ("said", "says", "wrote", "claimed", "called", "quoted", "sagte", "dit", "dijo")

WORD, INSULT, THREAT, TARGET, NOT, REPORT = range(6)
#: Kinds of match, in the order of the features.
KINDS = ("insult", "aimed", "heaped", "negated", "reported", "threat")
BINS = 7
#: Weights without training: bias, then one per kind of match; and how firmly the
#: fit is held to them.
PRIOR = np.array([-3.0, 3.0, 4.0, 4.0, 0.2, 0.2, 4.0])
FIRMNESS = 0.5
SCOPE = 3

_LETTERS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_ENDS = re.compile(r"[.!?;:\n]+")


# -- the grammar -------------------------------------------------------------------

class Transducer:
    """``step(state, symbol) -> (state, mark)``, from state 0."""

    def __init__(self, step):
        self.step = step


def marks(symbol: int) -> Transducer:
    return Transducer(lambda s, x: (0, x == symbol))


def within(symbol: int) -> Transducer:
    """Marks the SCOPE symbols after ``symbol``."""
    return Transducer(lambda s, x: (SCOPE if x == symbol else max(0, s - 1), s > 0))


def after(symbol: int) -> Transducer:
    """Marks everything after ``symbol`` up to the clause's end."""
    return Transducer(lambda s, x: (1 if s or x == symbol else 0, s == 1))


def scoped(symbol: int, over: tuple[int, ...]) -> Transducer:
    """As ``within``; a symbol of ``over`` in the scope carries it on, so what
    completes a match later is marked too."""
    return Transducer(lambda s, x: (SCOPE if x == symbol or (s and x in over) else max(0, s - 1), s > 0))


def compose(*parts: Transducer):
    """The reachable product: (next state, marks) by [state][symbol]."""
    start = (0,) * len(parts)
    number, rows, todo = {start: 0}, [], [start]
    while todo:
        state = todo.pop(0)
        row = []
        for symbol in range(6):
            moved = [p.step(s, symbol) for p, s in zip(parts, state, strict=True)]
            to = tuple(m[0] for m in moved)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append((number[to], tuple(m[1] for m in moved)))
        rows.append(row)
    return rows


def _kind(insult, threat, target, beside, had_insult, had_threat, negated, reported, earlier) -> int:
    """The kind of match that an arc with these marks completes, or -1."""
    aimed = (insult and beside) or (target and had_insult)
    threatens = (threat and beside) or (target and had_threat)
    if not (insult or aimed or threatens):
        return -1
    return KINDS.index("negated" if negated else "reported" if reported else "threat" if threatens else "aimed" if aimed else
                       "heaped" if earlier else "insult")


class Grammar:
    """The composed machine: by [state][symbol] the next state, and the kind of
    the match that the arc completes (-1: none), which has its weight."""

    def __init__(self):
        rows = compose(marks(INSULT), marks(THREAT), marks(TARGET), within(TARGET), within(INSULT), within(THREAT),
                       scoped(NOT, (INSULT, THREAT)), after(REPORT), after(INSULT))
        self.arcs = [[(to, _kind(*m)) for to, m in row] for row in rows]

    def best_path(self, symbols, weights) -> int:
        """The kind of the match on a clause's best path (ties: the earlier
        match), or -1 if no path has a match.  ``weights`` by kind."""
        state, best, kind = 0, -np.inf, -1
        for x in symbols:
            state, got = self.arcs[state][x]
            if got >= 0 and weights[got] > best:
                best, kind = weights[got], got
        return kind


GRAMMAR = Grammar()


class Lexicon:
    """Words to symbols: the fixed lists, and learned insults (``word`` or
    ``stem*``), softeners and targets; ``weights`` are those of the arcs."""

    def __init__(self, learned: list[str], softeners=(), targets=(), weights: np.ndarray = PRIOR[1:]):
        self.words = {w: INSULT for w in learned if w[-1] != "*"} | {w: NOT for w in softeners} | {w: TARGET for w in targets}
        self.words |= {w: k for k, ws in ((INSULT, INSULTS), (THREAT, THREATS), (TARGET, TARGETS), (NOT, NEGATIONS),
                                          (REPORT, REPORTS)) for w in ws}
        self.stems = {w[:-1] for w in learned if w[-1] == "*"}
        self.weights = list(weights)
        said = sorted({w for w, k in self.words.items() if k in (INSULT, THREAT)} | self.stems)
        self.any = re.compile("(?<![^\\W\\d_])(?:" + "|".join(map(re.escape, said)) + ")")

    def symbol(self, word: str) -> int:
        got = self.words.get(word, WORD)
        if got == WORD and any(word[:n] in self.stems and len(word) <= n + SUFFIX for n in PREFIXES):
            return INSULT
        return got

    def clauses(self, text: str):
        """(words, symbols) of the clauses that may hold a match."""
        low = text.lower()
        if self.any.search(low):
            for clause in _ENDS.split(low):
                if self.any.search(clause):
                    words = _LETTERS.findall(clause)
                    yield words, [self.symbol(w) for w in words]

    def features(self, text: str) -> tuple[int, ...]:
        """Clauses by the kind of their best path, on a rough logarithmic scale."""
        kinds = [0] * len(KINDS)
        for _, symbols in self.clauses(text):
            kind = GRAMMAR.best_path(symbols, self.weights)
            if kind >= 0:
                kinds[kind] += 1
        return tuple(_bin(x) for x in kinds)


def _bin(x: int) -> int:
    """0, 1, 2, 3-4, 5-8, 9-16, more."""
    return min(BINS - 1, x if x < 3 else 1 + (x - 1).bit_length())


def _design(bins) -> np.ndarray:
    """Features as the weights see them: 1, clauses by kind."""
    x = np.asarray(bins, float).reshape(-1, len(KINDS))
    return np.hstack([np.ones((len(x), 1)), x])


def score(weights: np.ndarray, bins) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(bins) @ weights, -30, 30)))


# -- learning ----------------------------------------------------------------------

def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of labelled rows that aren't held out, MAX_TRAIN at most in
    expectation; the label side is bounded by that number and broadcast."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_mod(F.col("doc_id"), HOLD_MOD) != HOLD_REST))
    n = rows.count()
    if n > MAX_TRAIN:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(MAX_TRAIN / n * (1 << 20)))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(texts.where("text is not null").join(F.broadcast(rows), "doc_id").select("text", "toxic"), "toxicity-train")


def _entries(word: str):
    return (word, *(word[:k] + "*" for k in PREFIXES if len(word) >= k))


def _entry_counts(train: DataFrame) -> DataFrame:
    """(entry, n, toxic): training texts that hold it; partly summed in tasks."""
    def run(batches):
        import pyarrow as pa

        def out():
            rows = [(e, n, toxic[e]) for e, n in all_.items()]
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                               pa.array(cols[2], pa.int64())], names=["entry", "n", "toxic"])
        all_, toxic, entries = Counter(), Counter(), lru_cache(1 << 17)(_entries)
        for b in batches:
            for text, t in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                own = set()
                for w in set(_LETTERS.findall(text.lower())):
                    own.update(entries(w))
                all_.update(own)
                if t:
                    toxic.update(own)
            if len(all_) > 300_000:
                yield out()
                all_, toxic = Counter(), Counter()
        yield out()
    return train.mapInArrow(run, "entry string, n long, toxic long").groupBy("entry").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))


def _contexts(train: DataFrame, entries: set[str]) -> DataFrame:
    """(entry, n, toxic) again, of different contexts (words around)."""
    def run(batches):
        import pyarrow as pa

        wanted = lru_cache(1 << 17)(lambda w: tuple(e for e in _entries(w) if e in entries))
        for b in batches:
            rows = set()
            for text, t in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                ws = ["", *_LETTERS.findall(text.lower()), ""]
                for i, w in enumerate(ws[1:-1], 1):
                    if own := wanted(w):
                        around = zlib.crc32(f"{ws[i - 1]} {ws[i + 1]}".encode())
                        rows.update((e, t, around) for e in own)
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.int64())], names=["entry", "toxic", "context"])
    return train.mapInArrow(run, "entry string, toxic int, context long").distinct().groupBy("entry").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))


def learn_lexicon(train: DataFrame) -> list[str]:
    """Insult entries.  A kept entry occurs in MIN_SHARE of the toxic texts, so
    their number is bounded by a text's words, not by the corpus."""
    total, positives = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    least = max(MIN_COUNT, MIN_SHARE * positives)
    purity = max(MIN_PURITY, 1 - (1 - positives / max(1, total)) / 3)  # far above what any word has
    pure = F.col("toxic") >= F.col("n") * purity
    first = {r[0] for r in _entry_counts(train).where((F.col("toxic") >= least) & pure).select("entry").collect()}
    if not first:
        return []
    seen = {r["entry"]: (r["toxic"], r["toxic"] / r["n"]) for r in _contexts(train, first).collect()}
    held = {e: p for e, (n, p) in seen.items() if n >= least and p >= purity}
    kept: list[str] = []
    for e in sorted(held, key=lambda e: (-seen[e][0], -len(e.rstrip("*")), e)):
        stem = e.rstrip("*")  # of entries that say the same in as many contexts the longest stem is kept
        if not any(k.rstrip("*").startswith(stem) or (k[-1] == "*" and stem.startswith(k[:-1])) for k in kept):
            kept.append(e)
    return kept


def learn_context(train: DataFrame, lexicon: Lexicon) -> tuple[list[str], list[str]]:
    """(softeners, targets): words beside an insult that move its clause's label.
    Equal clauses count once.  At most a text's words beside insults are kept in
    MIN_CLAUSES clauses each, so both lists are short."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = set()
            for text, t in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist(), strict=True):
                for words, symbols in lexicon.clauses(text):
                    near = {words[j] for i, x in enumerate(symbols) if x == INSULT
                            for j in range(max(0, i - SCOPE), min(len(words), i + SCOPE + 1)) if symbols[j] == WORD}
                    if near:
                        key = zlib.crc32(" ".join(words).encode())
                        rows |= {(w, t, key) for w in near} | {("", t, key)}
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.int64())], names=["word", "toxic", "clause"])
    counts = train.mapInArrow(run, "word string, toxic int, clause long").distinct().groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).where(F.col("n") >= MIN_CLAUSES)
    whole = counts.where("word = ''").first()
    if whole is None:
        return [], []
    base = whole["toxic"] / whole["n"]
    share = F.col("toxic") / F.col("n")
    soft = counts.where((F.col("word") != "") & (share * 3 <= base)).select("word").collect()
    hard = counts.where((F.col("word") != "") & ((1 - share) * 3 <= 1 - base) & F.lit(base < 0.75)).select("word").collect()
    return sorted(r[0] for r in soft), sorted(r[0] for r in hard)


def _features(rows: DataFrame, lexicon: Lexicon, keep: list[str], ddl: str) -> DataFrame:
    """``keep`` columns and the feature bins of ``text``."""
    names = list(KINDS)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [lexicon.features(t or "") for t in b.column("text").to_pylist()]
            cols = list(zip(*got, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(c, pa.int32()) for c in cols)],
                                             names=[*keep, *names])
    return rows.select(*keep, "text").mapInArrow(run, ", ".join([ddl, *(f"{n} int" for n in names)]))


def fit(train: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """Logistic weights by Newton steps over the counts of equal features (at
    most BINS ** 6 rows, whatever the corpus), held to PRIOR by FIRMNESS."""
    names = list(KINDS)
    rows = _features(train, lexicon, ["toxic"], "toxic int").groupBy("toxic", *names).count().collect()
    y = np.array([r["toxic"] for r in rows], float)
    if not len(y) or y.min() == y.max():
        return PRIOR.copy()
    x, c = _design([[r[n] for n in names] for r in rows]), np.array([r["count"] for r in rows], float)
    w, ridge = PRIOR.copy(), np.diag([1e-6] + [FIRMNESS] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (c * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (c * (y - p)) - ridge @ (w - PRIOR))
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def model(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon, np.ndarray]:
    """(lexicon with the arcs' weights, weights with the bias)."""
    train = training_rows(docs, labels)
    learned = learn_lexicon(train)
    context = learn_context(train, Lexicon(learned))
    weights = fit(train, Lexicon(learned, *context))
    return Lexicon(learned, *context, weights[1:]), weights


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted, and the clauses by kind."""
    lexicon, weights = model(docs, labels)
    table: dict = {}

    def run(batches):
        import pyarrow as pa

        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                got = lexicon.features(text or "")
                if got not in table:
                    table[got] = float(score(weights, got)[0])
                out.append((table[got], *got))
            cols = list(zip(*out, strict=True)) or [[]] * (1 + len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(cols[0], pa.float64()), *(pa.array(c, pa.int32()) for c in cols[1:])],
                names=["doc_id", "score", *KINDS])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, score double, " + ", ".join(f"{k} int" for k in KINDS))
    held = F.coalesce(crc_mod(F.col("doc_id"), HOLD_MOD) == HOLD_REST, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                      *KINDS)


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below THRESHOLD, as they are."""
    lexicon, weights = model(docs, labels)
    names = docs.columns

    def run(batches):
        import pyarrow as pa

        held: dict = {}
        for b in batches:
            keep = []
            for text in b.column("text").to_pylist():
                got = lexicon.features(text or "")
                if got not in held:
                    held[got] = bool(score(weights, got)[0] < THRESHOLD)
                keep.append(held[got])
            yield b.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema).select(*names)
