"""Language ID: the model is a distribution, held-out accuracy, edge cases."""

import numpy as np

from llm_tables import SF_MID, make_docs  # noqa: F401
from rowcast.llm import langid as L
from rowcast.llm.common import table


def test_model_is_a_distribution():
    rng = np.random.RandomState(0)
    keys, counts = np.unique(rng.randint(0, 5, (3000, L.ORDER)) @ (L.BASE ** np.arange(L.ORDER)[::-1]), return_counts=True)
    m = L.Model(keys, counts)
    for context in (0, int(keys[5] // L.BASE), L.BASE ** 3 - 1):
        p = np.exp(m.log_prob(context * L.BASE + np.arange(L.BASE, dtype=np.int64)))
        assert abs(p.sum() - 1) < 1e-6 and (p > 0).all()


def test_keys_are_those_of_a_plain_loop():
    s = L.Symbols("abcé")
    texts = ["ab c", "", "É1b", "  a--b  ", "ж"]
    key, row, letters = s.keys(texts)
    code = {"a": 2, "b": 3, "c": 4, "é": 5}
    for i, t in enumerate(texts):
        symbols, want = [0], []
        for ch in (" " + t + " ").lower()[1:]:
            x = code.get(ch, 1 if ch.isalpha() else 0)
            if x or symbols[-1]:
                symbols.append(x)
                padded = [0] * L.ORDER + symbols
                want.append(sum(c * L.BASE ** k for k, c in enumerate(reversed(padded[-L.ORDER:]))))
        assert key[row == i].tolist() == want
        assert letters[i] == sum(ch.isalpha() for ch in t)


def test_held_out_accuracy(spark):
    docs = table(spark, SF_MID, "documents")
    rows = L.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_calibration_is_that_of_every_row(spark):
    """More rows than any sample: temperature and rejection are those of all."""
    rng = np.random.RandomState(1)
    ce, letters, own = rng.rand(6000, 3) * 2 + 1, rng.randint(1, 400, 6000), rng.randint(0, 3, 6000)
    ce[np.arange(6000), own] -= 0.05
    ce[:7] += np.array([90, 80, 80, 80, 70, 60, 50])[:, None]  # few rows decide what is rejected
    rows = spark.createDataFrame([(["a", "b", "c"][o], int(n), c.tolist()) for o, n, c in zip(own, letters, ce, strict=True)],
                                 "lang string, letters long, entropies array<double>").repartition(5)
    scale, reject = L._calibrate(rows, ["a", "b", "c"])
    def loss(x):
        z = -ce * np.sqrt(letters)[:, None] * x
        return (np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(6000), own]).mean()
    assert scale == min(np.geomspace(0.05, 20, 30), key=loss)
    assert abs(reject - np.quantile(ce.min(1), 1 - L.REJECT_SHARE) * 1.05) < 1e-9
    same = rows.limit(0).union(rows.limit(1)).crossJoin(spark.range(50)).drop("id")
    assert L._calibrate(same, ["a", "b", "c"])[1] > 0 and L._calibrate(rows.limit(0), ["a", "b", "c"]) == (20.0, float("inf"))


def test_edge_rows(spark, make_docs):
    en, xx = "the cat sat on the mat and then it went home ", "zuk pra luz kra pluz zzat kluz prak zu "
    rows = [(i, en * (1 + i % 3) if i % 2 else xx * (1 + i % 3), "en" if i % 2 else "xx") for i in range(60)]
    rows += [(None, None, "en"), (None, "...123", None), (70, "", "en"), (71, en * 20_000, None), (71, "the cat", None),
             (72, "日本語", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as letters", "'x' as entropies")
    got = L.identified(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 66 and by[31].lang_pred == "en" and by[30].lang_pred == "xx" and by[71].lang_pred == "en"
    assert by[70].lang_pred == "und" and by[70].score == 0 and by[None].lang_pred == "und" and by[None].held_out is False
    assert by[72].lang_pred in ("en", "xx") and by[72].rejected
    assert all(0 <= r.score <= 1 for r in got)
    assert L.identified(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in L.identified(docs.where("lang is null")).collect()} == {"und"}
