"""Python rules (U1): same fold, mutation through the event dict."""

import pytest
from conftest import row
from pyspark.sql import functions as F

from rowcast.operators.envelope import build_events
from rowcast.operators.pyrule import PythonRule
from rowcast.operators.rules import Rule
from rowcast.plans.pipeline import apply_chain
from rowcast.plans.samples import generic_rule, generic_script

U = "u"


@pytest.fixture()
def ev(make_log):
    log = make_log([
        ("test_a", "test_x", "insert", [row(1, "change-kafka")], ["event_id"], U, 1, 0),
        ("test_a", "test_x", "insert", [row(2, "ignore")], ["event_id"], U, 2, 0),
        ("test_a", "test_x", "delete", [row(3, "ignore")], ["event_id"], U, 3, 0),
        ("prod", "test_x", "update", [row(4, "a"), row(4, "<&> 😀 long")], ["event_id"], U, 4, 0),
        ("test_a", "test_x", "update", [row(5, "a"), row(5, "abcd")], ["event_id"], U, 5, 0),
    ])
    return build_events(log, pipeline="p", timestamp=F.lit(0))


def rows_of(df):
    return {r.gtid_seq: (r.kafka.topic, r.kafka.key, [x.text_col for x in (r.after or [])]) for r in df.collect()}


def test_python_rule_equals_expression_rule(ev):
    py = apply_chain(ev, [PythonRule("g", "test_.*", "test_.*", generic_script)])
    ex = apply_chain(ev, [generic_rule()])
    assert rows_of(py) == rows_of(ex)
    got = rows_of(py)
    assert got[1][:2] == ("another-topic", "another-msg-key") and 2 not in got
    assert got[4][2] == ["<&> 😀 long"]      # not matched: untouched, text survives the JSON round trip
    assert got[5][2] == ["****"]


def test_python_rule_verdicts_and_mixing(ev):
    hold = PythonRule("hold", "", "", lambda e: 2 if e["action"] == "delete" else 0)
    assert sorted(r.gtid_seq for r in apply_chain(ev, [hold]).collect()) == [1, 2, 4, 5]
    # a later expression rule that does not match resets the verdict
    assert apply_chain(ev, [hold, Rule("r", "nomatch", "", verdict=F.lit(1))]).count() == 5


def test_python_rule_null_verdict(ev):
    none = PythonRule("none", "", "", lambda e: None)
    with pytest.raises(Exception, match="returned no verdict"):
        apply_chain(ev, [none]).collect()
    assert apply_chain(ev, [none], on_null_verdict="drop").count() == 0


def test_python_rule_on_mixed_layout(ev):
    from rowcast.operators.codec import encode
    from rowcast.plans.samples import generic_rule_mixed

    mixed = ev.withColumn("before", F.transform("before", lambda r: F.map_from_arrays(
        F.array(*[F.lit(n) for n in ["event_id", "text_col", "user_id", "value"]]),
        F.array(*[r[n].cast("variant") for n in ["event_id", "text_col", "user_id", "value"]])))) \
        .withColumn("after", F.transform("after", lambda r: F.map_from_arrays(
            F.array(*[F.lit(n) for n in ["event_id", "text_col", "user_id", "value"]]),
            F.array(*[r[n].cast("variant") for n in ["event_id", "text_col", "user_id", "value"]]))))
    py = encode(apply_chain(mixed, [PythonRule("g", "test_.*", "test_.*", generic_script)]))
    ex = encode(apply_chain(mixed, [generic_rule_mixed()]))
    typed = encode(apply_chain(ev, [generic_rule()]))
    import json
    vals = lambda df: sorted((json.loads(r.value) for r in df.collect()), key=lambda e: e["kafka"]["key"])
    # equal as JSON; a number the Python function saw may come back as 1 instead of 1.0 in the mixed layout
    assert vals(py) == vals(ex) == vals(typed)


def test_python_rule_errors_follow_the_policy(ev):
    def bad(e):
        for r in e["after"] or []:
            r["user_id"] = "not a number"
        return 0

    def crash(e):
        if e["action"] == "insert":
            raise KeyError("x")
        return 0

    for fn in (bad, crash, lambda e: True, lambda e: 1.7):
        with pytest.raises(Exception):
            apply_chain(ev, [PythonRule("r", "test_.*", "test_.*", fn)]).collect()
    for fn, left in ((bad, [3, 4]), (crash, [3, 4, 5])):
        kept = apply_chain(ev, [PythonRule("r", "test_.*", "test_.*", fn, on_error="drop")])
        assert sorted(r.gtid_seq for r in kept.collect()) == left
        passed = {r.gtid_seq: r for r in apply_chain(ev, [PythonRule("r", "test_.*", "test_.*", fn, on_error="pass")]).collect()}
        assert sorted(passed) == [1, 2, 3, 4, 5] and passed[1].after[0].user_id == 1
    with pytest.raises(ValueError, match="on_error"):
        PythonRule("r", fn=bad, on_error="maybe")


def test_python_rule_adds_no_image_fields(ev):
    def extra(e):
        for r in e["after"] or []:
            r["extra"] = 1
        return 0
    out = {r.gtid_seq: r for r in apply_chain(ev, [PythonRule("e", "test_.*", "test_.*", extra)]).collect()}
    assert "extra" not in out[1].after[0].asDict() and out[1].after[0].text_col == "change-kafka"
