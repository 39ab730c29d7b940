"""Edge cases: empty inputs, nulls in envelope fields, keys missing from images."""

import pytest
from conftest import LOG_DDL, row
from pyspark.sql import functions as F

from rowcast.operators.codec import encode
from rowcast.operators.delivery import dedupe, enrich_rows, sequence_in_key
from rowcast.operators.envelope import build_events
from rowcast.operators.position import check_ahead, latest_state, resume_filter, state_from_batch
from rowcast.operators.rules import apply_rules, verdicts
from rowcast.plans import samples


def test_everything_runs_on_empty_input(spark):
    log = spark.createDataFrame([], LOG_DDL)
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    recs = encode(apply_rules(ev, samples.sample_rules()))
    assert recs.count() == 0
    assert dedupe(recs).count() == 0 and sequence_in_key(recs).count() == 0
    assert verdicts(ev, samples.sample_rules()).count() == 0
    states = spark.createDataFrame([], "name string, gtid string, timestamp bigint")
    assert latest_state(states).count() == 0 and check_ahead(ev, states).count() == 0
    assert resume_filter(ev.withColumn("pipeline", F.lit("p")), states).count() == 0
    assert state_from_batch(ev.withColumn("pipeline", F.lit("p"))).count() == 0
    dim = spark.createDataFrame([], "id bigint, name string")
    assert enrich_rows(ev, "after", dim, on=("user_id", "id"), fields=["name"]).count() == 0


def test_null_schema_or_table_gives_empty_parts(make_log):
    ev = build_events(make_log([(None, "t", "insert", [row(1, "a")], [], "u", 1, 0),
                                ("s", None, "insert", [row(2, "a")], [], "u", 2, 0)]),
                      pipeline="p", timestamp=F.lit(0))
    assert sorted(r.kafka.topic for r in ev.collect()) == [".t", "s."]
    # a null schema never matches a guard (no error either)
    assert apply_rules(ev, [samples.tenant_drop_rule()]).count() == 2


def test_per_row_key_column_missing_from_image(make_log):
    ev = build_events(make_log([("s", "t", "insert", [row(1, "a")], ["no_such_col"], "u", 1, 0)]),
                      pipeline="p", timestamp=F.lit(0), on_error="mark")
    assert ev.collect()[0]._error == "null key value"


def test_missing_key_column_in_list_fails_early(make_log):
    with pytest.raises(ValueError, match="not in the row image"):
        build_events(make_log([("s", "t", "insert", [row(1, "a")], [], "u", 1, 0)]), pk=["nope"])


def test_unknown_uuid_passes_resume(spark, make_log):
    ev = build_events(make_log([("s", "t", "insert", [row(1, "a")], [], "other-uuid", 5, 0)]),
                      pipeline="p", timestamp=F.lit(0)).withColumn("pipeline", F.lit("p"))
    states = spark.createDataFrame([("p", "u:1-100", 1)], "name string, gtid string, timestamp bigint")
    assert resume_filter(ev, states).count() == 1
    assert check_ahead(ev, states).collect()[0].foreign is True
