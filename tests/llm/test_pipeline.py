"""The pipeline against the stages done one by one in plain Python."""

import hashlib
import re

from pyspark.sql import functions as F
from test_neardup import brute

from llm_tables import SF_SMALL, make_docs  # noqa: F401
import corpus_pipeline
from rowcast.llm import queries, toxicity
from rowcast.llm.common import table, written

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def words(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def test_stages_take_effect_in_order(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    scored = toxicity.scored(docs, table(spark, SF_SMALL, "labels")).collect()
    left = {r.doc_id: rows[r.doc_id] for r in scored if r.predicted == 0}
    steps = [set(left)]
    seen = set()
    for i in sorted(left):
        d = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", left[i] or "").encode()).digest()
        if d in seen:
            del left[i]
        seen.add(d)
    steps.append(set(left))
    near = brute(list(left.items()))
    left = {i: t for i, t in left.items() if near[i][2]}
    steps.append(set(left))
    items = [words(r.text) for r in table(spark, SF_SMALL, "benchmark").collect()]
    leaks = {i for i, t in left.items() for b in items if f" {' '.join(b)} " in f" {' '.join(words(t))} "}
    left = {i: t for i, t in left.items() if i not in leaks}
    frame = docs
    for (name, stage), want in zip(corpus_pipeline.STAGES[:3], steps, strict=False):
        frame = written(stage(spark, frame, SF_SMALL), name)
        assert frame.columns == NAMES and {r.doc_id for r in frame.collect()} == want, name
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == set(left)
    last = out.agg(F.sum("length"), F.max("sequence_id"), F.max(F.col("offset") + F.col("length"))).first()
    assert last[2] <= 2048 and last[1] == (last[0] - 1) // 2048


def test_edges(spark, make_docs):
    docs = make_docs([(1, "one two three"), (1, "one two three"), (2, None), (3, ""), (None, "null id"), (4, "x " * 30_000)])
    frame = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        frame = written(stage(spark, frame, SF_SMALL), "s")
        assert frame.columns == docs.columns
    assert sorted(str(r.doc_id) for r in frame.collect()) == ["1", "2", "4", "None"]
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_SMALL).count() > 4
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).count() == 0


def test_all_queries_are_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert set(queries.ORACLES) <= set(queries.QUERIES) and len(corpus_pipeline.STAGES) == 5
