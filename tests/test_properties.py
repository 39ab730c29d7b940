"""Property tests: the rule fold against a plain-Python fold, and GTID-set
text round trips."""

import re

from conftest import LOG_DDL, row
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowcast.functions.gtid import format_gtid_set, parse_gtid_set
from rowcast.operators.envelope import build_events
from rowcast.operators.rules import Rule, apply_rules

EVENTS = [("test_a", "test_x"), ("test_b", "other"), ("prod", "test_x"), ("prod", "entity_1"), ("tenant_q", "entity_1")]
PATTERNS = ["", "test_.*", "prod", "entity", "^test_a$", "nomatch"]
VERDICTS = [None, 0, 1, 2, "odd"]   # "odd": DROP when gtid_seq is odd, else CONT

rule_st = st.tuples(st.sampled_from(PATTERNS), st.sampled_from(PATTERNS), st.sampled_from(VERDICTS))


def py_fold(rules):
    """The upstream fold, written directly."""
    out = []
    for seq, (schema, table) in enumerate(EVENTS, start=1):
        v = 0
        for ms, mt, verdict in rules:
            if verdict is None:
                v = 0
                continue
            if not (re.search(ms, schema) and re.search(mt, table)):
                v = 0
                continue
            v = (1 if seq % 2 else 0) if verdict == "odd" else verdict
            if v == 1:
                break
        if v == 0:
            out.append(seq)
    return out


@settings(max_examples=15, deadline=None)
@given(st.lists(rule_st, min_size=0, max_size=5))
def test_fold_matches_reference(spark, rules):
    log = spark.createDataFrame([(s, t, "insert", [row(i, "x")], [], "u", i, 0)
                                 for i, (s, t) in enumerate(EVENTS, start=1)], LOG_DDL)
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    spark_rules = []
    for i, (ms, mt, verdict) in enumerate(rules):
        if verdict is None:
            spark_rules.append(Rule(f"r{i}", ms, mt))
        elif verdict == "odd":
            spark_rules.append(Rule(f"r{i}", ms, mt, verdict=F.when(F.col("gtid_seq") % 2 == 1, 1).otherwise(0)))
        else:
            spark_rules.append(Rule(f"r{i}", ms, mt, verdict=F.lit(verdict)))
    got = sorted(r.gtid_seq for r in apply_rules(ev, spark_rules).select("gtid_seq").collect())
    assert got == py_fold(rules)


UUIDS = ["fa632d10-864b-11ed-843e-0242c0a86002", "3e11fa47-71ca-11e1-9e33-c80aa9429562"]


def canonical(intervals):
    """Sorted, one member per uuid, the text the formatter must produce."""
    by = {}
    for u, lo, hi in sorted(set(intervals)):
        by.setdefault(u, []).append(f"{lo}" if lo == hi else f"{lo}-{hi}")
    return ",".join(f"{u}:{':'.join(ivs)}" for u, ivs in sorted(by.items()))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(UUIDS), st.integers(1, 10**12), st.integers(0, 10**6)),
                min_size=1, max_size=6))
def test_gtid_text_round_trip(spark, raw):
    intervals = [(u, lo, lo + span) for u, lo, span in raw]
    text = canonical(intervals)
    df = spark.createDataFrame([(text,)], "g string")
    got = df.select(format_gtid_set(parse_gtid_set("g")).alias("f")).collect()[0].f
    assert got == text


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=5))
def test_text_survives_encode_in_both_layouts(spark, texts):
    import json

    from rowcast.operators.codec import decode, encode
    from rowcast.operators.mixed import to_mixed_log

    log = spark.createDataFrame([("s", "t", "insert", [row(i, t)], [], "u", i, 0) for i, t in enumerate(texts)],
                                LOG_DDL)
    typed = encode(build_events(log, pipeline="p", timestamp=F.lit(0)))
    mixed = encode(build_events(to_mixed_log(log), pipeline="p", timestamp=F.lit(0)))
    by_seq = lambda df: {r.gtid_seq: json.loads(r.value) for r in df.collect()}
    t, m = by_seq(typed), by_seq(mixed)
    assert t == m
    assert [t[i]["after"][0]["text_col"] for i in range(len(texts))] == texts
    back = decode(typed.select("gtid_seq", "value"), "struct<event_id:bigint,text_col:string,user_id:bigint,value:double>")
    assert {r.gtid_seq: r.after[0].text_col for r in back.collect()} == dict(enumerate(texts))


@settings(max_examples=8, deadline=None)
@given(st.lists(rule_st, min_size=1, max_size=4))
def test_python_rules_fold_like_expression_rules(spark, rules):
    from rowcast.operators.pyrule import PythonRule
    from rowcast.plans.pipeline import apply_chain

    log = spark.createDataFrame([(s, t, "insert", [row(i, "x")], [], "u", i, 0)
                                 for i, (s, t) in enumerate(EVENTS, start=1)], LOG_DDL)
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    py, ex = [], []
    for i, (ms, mt, verdict) in enumerate(rules):
        if verdict is None:
            py.append(PythonRule(f"r{i}", ms, mt, None))
            ex.append(Rule(f"r{i}", ms, mt))
        elif verdict == "odd":
            py.append(PythonRule(f"r{i}", ms, mt, lambda e: 1 if e["after"][0]["event_id"] % 2 else 0))
            ex.append(Rule(f"r{i}", ms, mt, verdict=F.when(F.col("gtid_seq") % 2 == 1, 1).otherwise(0)))
        else:
            py.append(PythonRule(f"r{i}", ms, mt, (lambda v: (lambda e: v))(verdict)))
            ex.append(Rule(f"r{i}", ms, mt, verdict=F.lit(verdict)))
    got_py = sorted(r.gtid_seq for r in apply_chain(ev, py).select("gtid_seq").collect())
    got_ex = sorted(r.gtid_seq for r in apply_chain(ev, ex).select("gtid_seq").collect())
    assert got_py == got_ex == py_fold(rules)
