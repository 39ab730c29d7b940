"""Rule fold semantics (T1-T10, F1-F4) and quirks Q6-Q9, Q26."""

import pytest
from conftest import row
from pyspark.sql import functions as F

from rowcast import functions as RF
from rowcast.model import ACTION_CONT, ACTION_DROP
from rowcast.operators.envelope import build_events
from rowcast.operators.rules import Rule, SourceFilter, apply_rules, drop_rule, java_regex, matches, verdicts

U = "u"


@pytest.fixture()
def ev(make_log):
    log = make_log([
        ("test_a", "test_x", "insert", [row(1, "keep")], ["event_id"], U, 1, 0),
        ("test_a", "other", "insert", [row(2, "keep")], ["event_id"], U, 2, 0),
        ("prod", "test_x", "insert", [row(3, "ignore")], ["event_id"], U, 3, 0),
        ("test_a", "test_x", "delete", [row(4, "ignore")], ["event_id"], U, 4, 0),
        ("test_a", "test_x", "update", [row(5, "x"), row(5, "ignore")], ["event_id"], U, 5, 0),
    ])
    return build_events(log, pipeline="p", timestamp=F.lit(0))


def seqs(df):
    return sorted(r.gtid_seq for r in df.select("gtid_seq").collect())


def test_guard_is_unanchored_regex(spark):
    df = spark.createDataFrame([("test_a",), ("my_test_b",), ("prod",), (None,)], "schema string")
    got = [r.m for r in df.select(matches("schema", "test_").alias("m")).collect()]
    assert got == [True, True, False, False]
    assert [r.m for r in df.select(matches("schema", "").alias("m")).collect()] == [True] * 4
    assert java_regex("(?P<db>test)_.*") == "(?<db>test)_.*"


def test_drop_any_row_under_guard(ev):
    rule = Rule("r", "test_.*", "test_.*",
                verdict=F.when(RF.any_row("after", "text_col", lambda v: v == "ignore"), ACTION_DROP).otherwise(0))
    # 3 is not matched (schema prod); 4 is a delete (null after: no-op); 5's after row says ignore
    assert seqs(apply_rules(ev, [rule])) == [1, 2, 3, 4]


def test_drop_table_rule(ev):
    assert seqs(apply_rules(ev, [drop_rule("d", "test_.*", "test_x")])) == [2, 3]


def test_noop_rule_resets_verdict_and_verdict_2(ev):
    hold = Rule("hold", "", "", verdict=F.lit(2))
    # verdict 2 in last position: not delivered (Q8)
    assert seqs(apply_rules(ev, [hold])) == []
    # a rule without function afterwards resets it to CONT (Q26)
    assert seqs(apply_rules(ev, [hold, Rule("empty")])) == [1, 2, 3, 4, 5]
    # a non-matching rule afterwards resets it too
    nomatch = Rule("nm", "nothing", "", verdict=F.lit(ACTION_DROP))
    assert seqs(apply_rules(ev, [hold, nomatch])) == [1, 2, 3, 4, 5]
    # a matching CONT rule afterwards overrides it; the events it does not match are reset too
    assert seqs(apply_rules(ev, [hold, Rule("c", "test_a", "", verdict=F.lit(0))])) == [1, 2, 3, 4, 5]
    # verdict 2 from a matching last rule only
    assert seqs(apply_rules(ev, [Rule("h2", "prod", "", verdict=F.lit(2))])) == [1, 2, 4, 5]


def test_drop_stops_the_chain(ev):
    # the second rule would raise for the dropped events; they never reach it
    boom = Rule("boom", "", "", verdict=F.when(F.col("gtid_seq") <= 2, F.raise_error(F.lit("reached")).cast("int"))
                .otherwise(0))
    assert seqs(apply_rules(ev, [drop_rule("d", "test_a", ""), boom])) == [3]


def test_later_rules_see_mutations_but_topic_stays(ev):
    rename = Rule("rename", "prod", "", set={"schema": F.lit("test_prod")})
    drop_renamed = drop_rule("d", "test_prod", "")
    out = apply_rules(ev, [rename])
    r3 = out.filter("gtid_seq = 3").collect()[0]
    assert r3.schema == "test_prod" and r3.kafka.topic == "prod.test_x"    # Q6
    assert seqs(apply_rules(ev, [rename, drop_renamed])) == [1, 2, 4, 5]     # Q7


def test_assignments_use_values_as_the_event_entered(ev):
    # the verdict reads text_col before this rule's mask is applied
    rule = Rule("mask-then-test", "", "",
                verdict=F.when(RF.any_row("after", "text_col", lambda v: v == "keep"), 0).otherwise(0),
                set={"after": RF.mask_field("after", "text_col", 3)})
    out = {r.gtid_seq: r.after for r in apply_rules(ev, [rule]).collect()}
    assert out[1][0].text_col == "****" and out[4] is None


def test_null_verdict_policies(ev):
    bad = Rule("bad", "", "", verdict=F.when(F.col("gtid_seq") == 1, F.lit(None).cast("int")).otherwise(0))
    with pytest.raises(Exception, match="returned no verdict"):
        apply_rules(ev, [bad]).collect()
    assert seqs(apply_rules(ev, [bad], on_null_verdict="drop")) == [2, 3, 4, 5]
    assert seqs(apply_rules(ev, [bad], on_null_verdict="pass")) == [1, 2, 3, 4, 5]


def test_verdicts_keeps_everything(ev):
    v = {r.gtid_seq: r._verdict for r in verdicts(ev, [drop_rule("d", "test_a", "test_x"), Rule("e")]).collect()}
    assert v == {1: 1, 2: 0, 3: 0, 4: 1, 5: 1}


def test_reroute_and_key(ev):
    rule = Rule("rr", "test_.*", "", set={"kafka.topic": F.lit("t2"), "kafka.key": F.concat(F.col("kafka.key"), F.lit("!"))})
    out = {r.gtid_seq: r.kafka for r in apply_rules(ev, [rule]).collect()}
    assert out[1].topic == "t2" and out[1].key == "1!" and out[3].topic == "prod.test_x"


def test_guarded_type_change_is_refused(ev):
    rule = Rule("reshape", "test_a", "", set={"after": RF.drop_fields("after", "text_col")})
    with pytest.raises(Exception):
        apply_rules(ev, [rule]).collect()
    # without a guard the image shape may change
    ok = apply_rules(ev, [Rule("reshape", set={"after": RF.drop_fields("after", "text_col")})])
    assert "text_col" not in ok.schema["after"].dataType.elementType.names


def test_source_filter(spark):
    df = spark.createDataFrame([("test_a", "table_1"), ("test_a", "table_2"), ("test_123", "table_2"),
                                ("prod", "table_2"), ("test_b", "other")], "schema string, table string")
    f = SourceFilter(include_schemas=["test_.*", ""], exclude_schemas=["test_123"],
                     include_tables=["table_.*"], exclude_tables=["table_1"])
    assert [tuple(r) for r in f.apply(df).collect()] == [("test_a", "table_2")]
    assert SourceFilter().apply(df).count() == 5


def test_rule_with_set_only_is_cont(ev):
    r = Rule("set-only", "", "", set={"meta.pipeline": F.lit("x")})
    out = apply_rules(ev, [r])
    assert out.count() == 5 and {x.meta.pipeline for x in out.collect()} == {"x"}
    assert ACTION_CONT == 0


def test_bad_patterns_are_reported_before_processing(spark, make_log):
    from rowcast.operators.rules import validate_rules
    from rowcast.plans.pipeline import PipelineSpec, run_events

    with pytest.raises(ValueError, match="rule 'bad' match_table"):
        validate_rules(spark, [Rule("ok", "test_.*"), Rule("bad", "", "entity_[", verdict=F.lit(1))])
    with pytest.raises(ValueError, match="source filter exclude_tables"):
        run_events(PipelineSpec(name="p", source_filter=SourceFilter(exclude_tables=["(unclosed"])),
                   make_log([("s", "t", "insert", [row(1, "a")], [], U, 1, 0)]))
    validate_rules(spark, [Rule("named", "(?P<db>test)_.*")])   # Go-style named group is accepted


def test_rules_are_checked_when_built():
    from rowcast.operators.pyrule import PythonRule

    with pytest.raises(TypeError, match="verdict"):
        Rule("r", verdict="DROP")
    with pytest.raises(TypeError, match="assignments"):
        Rule("r", set={"kafka.topic": "plain text"})
    with pytest.raises(TypeError, match="callable"):
        PythonRule("p", fn="function transform(e) {}")


def test_row_level_assignments(ev):
    sql = Rule("sql", "test_.*", "", set={"after[].text_col": "upper(r.text_col)", "after[].extra": "r.event_id * 10"})
    py = Rule("py", "test_.*", "", set={"after[].text_col": lambda r: F.upper(r["text_col"]),
                                         "after[].extra": lambda r: r["event_id"] * 10})
    a = {r.gtid_seq: r.after for r in apply_rules(ev.filter("schema = 'test_a'"), [Rule("m", set={
        "after[].extra": "CAST(NULL AS BIGINT)"}), sql]).collect()}
    b = {r.gtid_seq: r.after for r in apply_rules(ev.filter("schema = 'test_a'"), [Rule("m", set={
        "after[].extra": "CAST(NULL AS BIGINT)"}), py]).collect()}
    assert a == b
    assert a[1][0].text_col == "KEEP" and a[1][0].extra == 10 and a[4] is None


def test_row_level_assignments_mixed_layout(make_log):
    from rowcast.operators.mixed import to_mixed_log

    log = to_mixed_log(make_log([("test_a", "t", "insert", [row(1, "keep")], [], U, 1, 0)]))
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    sql = Rule("sql", set={"after[].text_col": "upper(cast(r['text_col'] AS string))", "after[].n": "1 + 1"})
    py = Rule("py", set={"after[].text_col": lambda r: F.upper(r["text_col"].cast("string")),
                         "after[].n": lambda r: F.lit(2)})
    for rule in (sql, py):
        img = apply_rules(ev, [rule]).collect()[0].after[0]
        assert img["text_col"].toPython() == "KEEP" and img["n"].toPython() == 2 and img["user_id"].toPython() == 1
