"""Toxicity: the grammar, learning, held-out accuracy and edge cases."""

import itertools
import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

from llm_tables import SF_MID, make_docs  # noqa: F401
from rowcast.llm import toxicity as T
from rowcast.llm.common import table


def kind_of(lex, text):
    k = T.GRAMMAR.best_path(map(lex.symbol, text.split()), lex.weights)
    return T.KINDS[k] if k >= 0 else None


def test_clauses_are_matched_not_words():
    lex = T.Lexicon(["grobian*"], softeners=["kaum"], targets=["ihr"])
    for text, want in {
            "what an idiot": "insult", "you are an idiot": "aimed", "idiot that you are": "aimed", "she is not an idiot": "negated",
            "he said what an idiot": "reported", "we will hurt you": "threat", "we will not hurt you": "negated", "they hurt nobody": None,
            "das ist grobianisch": "insult", "das sind grobiansverehrerinnen": None, "kaum ein grobian": "negated",
            "ihr seid grobian": "aimed", "the path of wort and worth": None, "not an idiot but you are scum": "aimed", "idiot moron": "heaped"}.items():
        assert kind_of(lex, text) == want, text
    assert lex.features("Fine. You idiot! He said: moron") == (1, 1, 0, 0, 0, 0)
    # the best path is the heaviest: with other weights on the arcs another match is the clause's
    heavy = T.Lexicon([], weights=np.array([9.0, 1.0, 1.0, 0, 0, 0]))
    assert kind_of(heavy, "what an idiot yes and you are scum") == "insult"
    assert kind_of(T.Lexicon([]), "what an idiot yes and you are scum") == "aimed"


def test_composition_is_the_product():
    grammar = T.compose(T.marks(T.INSULT), T.within(T.NOT))
    assert len(grammar) == T.SCOPE + 1
    state, marks = grammar[0][T.NOT]
    assert marks == (False, False) and grammar[state][T.INSULT][1] == (True, True)


SAID = ["what an idiot", "you are an idiot", "she is not an idiot", "he said what an idiot", "nothing here"]


def plain_score(lex, weights, text):
    """The score by a plain reading of the grammar's rules, word by word."""
    total = dict.fromkeys(T.KINDS, 0)
    for clause in re.split(r"[.!?;:\n]+", text.lower()):
        words = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)
        sym = [lex.symbol(w) for w in words]
        best = None
        soft = 0
        for i, x in enumerate(sym):
            near = sym[max(0, i - T.SCOPE):i]
            aimed = x == T.INSULT and T.TARGET in near or x == T.TARGET and T.INSULT in near
            threat = x == T.THREAT and T.TARGET in near or x == T.TARGET and T.THREAT in near
            negated, reported = soft > 0, T.REPORT in sym[:i]
            soft = T.SCOPE if x == T.NOT or soft and x in (T.INSULT, T.THREAT) else max(0, soft - 1)
            if x == T.INSULT or aimed or threat:
                k = "negated" if negated else "reported" if reported else "threat" if threat else "aimed" if aimed else "heaped" if T.INSULT in sym[:i] else "insult"
                w = lex.weights[T.KINDS.index(k)]
                if best is None or w > best[0]:
                    best = (w, k)
        if best:
            total[best[1]] += 1
    logit = weights[0] + sum(w * min(T.BINS - 1, n if n < 3 else 1 + (n - 1).bit_length())
                             for w, n in zip(weights[1:], total.values()))
    return 1 / (1 + math.exp(-max(-30, min(30, logit))))


def test_scores_equal_a_plain_reading(spark, make_docs):
    """All scores of the query's path against word-by-word rules."""
    rnd = random.Random(5)
    vocabulary = ["idiot", "scum", "kill", "you", "euch", "not", "never", "said", "quoted", "the", "big", "house", ".", "!", "don't", "path"]
    docs = make_docs([(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(0, 24)))) for i in range(400)])
    labels = spark.createDataFrame([(i, 1, int("idiot" in t or i % 9 == 0)) for i, t in ((r.doc_id, r.text) for r in docs.collect())],
                                   "doc_id long, quality int, toxic int")
    lex, weights = T.model(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = T.scored(docs, labels).collect()
    assert len(got) == 400 and len({tuple(r)[4:] for r in got}) > 20
    for r in got:
        assert abs(r.score - plain_score(lex, weights, texts[r.doc_id])) < 1e-9


def test_the_grammar_decides_not_the_word(spark):
    """Ablation: the same insult in different clauses scores differently after the
    fit on the given tables, which a count of words can't do."""
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    lex, weights = T.model(docs, labels)
    by_kind = dict(zip(T.KINDS, weights[1:]))
    assert by_kind["aimed"] > 1 and by_kind["insult"] > 1 and by_kind["threat"] > 1
    assert by_kind["negated"] < 1 and by_kind["reported"] < 1
    insult, aimed, negated, reported, nothing = (float(T.score(weights, lex.features(t))[0]) for t in SAID)
    assert aimed > T.THRESHOLD > reported and insult > T.THRESHOLD > negated and nothing < T.THRESHOLD
    counts = [len(lex.any.findall(t)) for t in SAID]
    assert counts == [1, 1, 1, 1, 0]  # what an ablated scorer would see


def test_softeners_and_targets_are_learned(spark, make_docs):
    name = ["".join(p) for p in itertools.product("bcdfgklm", repeat=2)]
    texts = [(i, f"this {x} grobian y{x}", 1) for i, x in enumerate(name)] + [(i, f"kaum {x} grobian z{x}", 0) for i, x in enumerate(name)]
    texts += [(i, f"plain text {x}", 0) for i, x in enumerate(name)]
    train = spark.createDataFrame([(t, x) for _, t, x in texts], "text string, toxic int")
    soft, hard = T.learn_context(train, T.Lexicon(["grobian"]))
    assert soft == ["kaum"] and hard == ["this"]


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    rows = T.scored(docs, labels).join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    # few labels here: a rare insult's stem is not learned from a handful of texts
    assert len(rows) > 50 and sum(r.toxic == r.predicted for r in rows) >= 0.9 * len(rows)


def test_edge_rows(spark, make_docs):
    texts = [(i, f"text {i} with schurke{'abcdefgh'[i % 8]} and word{i}") if i % 2 else (i, f"plain text {i}") for i in range(80)]
    edge = [(None, None), (None, "x"), (200, ""), (201, "word " * 200_000 + "you idiot"), (201, "same"), (201, "same")]
    docs = make_docs(texts + edge)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)] + [(None, 0, 1), (200, 1, None), (999, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = T.scored(docs, labels).collect()
    assert len(rows) == 86 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[33].predicted == 1 and by[32].predicted == 0 and by[200].score == by[32].score
    assert by[None].held_out is False
    kept = T.keep_clean(docs, labels)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {0, 2, 200, None}
    assert T.scored(docs.limit(0), labels).count() == 0
    # no labels: the fixed lists score
    assert {r.doc_id: r.predicted for r in T.scored(docs, labels.limit(0)).collect()}[32] == 0


def test_bounded_training_rows(spark, make_docs, monkeypatch):
    monkeypatch.setattr(T, "MAX_TRAIN", 50)
    docs = make_docs([(i, f"t {i}") for i in range(400)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id long, quality int, toxic int")
    n = T.training_rows(docs, labels).count()
    assert 20 < n < 90
    assert T.training_rows(docs, labels).agg(F.countDistinct("text")).first()[0] == n
