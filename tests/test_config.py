"""Pipelines from configuration files give the same result as the code rules."""

import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from rowcast.plans import samples
from rowcast.plans.config import load_configs
from rowcast.plans.pipeline import PipelineSpec, run_batch
from rowcast.sources import fixtures as fx
from rowcast.streaming.statelog import segments

SAMPLE = '''
[mysql]
name = "p1"
addr = "ignored:3306"

[source_rules]
include_schemas = ["", ".*"]

[[transform_rule]]
name = "generic"
match_schema = "test_.*"
match_table = "test_.*"
verdict = "CASE WHEN coalesce(array_contains(after.text_col, 'ignore'), false) THEN 1 ELSE 0 END"
[transform_rule.set]
"kafka.topic" = "CASE WHEN coalesce(array_contains(after.text_col, 'change-kafka'), false) THEN 'another-topic' ELSE kafka.topic END"
"kafka.key" = "CASE WHEN coalesce(array_contains(after.text_col, 'change-kafka'), false) THEN 'another-msg-key' ELSE kafka.key END"
"after[].text_col" = "CASE WHEN octet_length(encode(r.text_col, 'UTF-16BE')) / 2 > 3 THEN '****' ELSE r.text_col END"

[[transform_rule]]
name = "another-rule"
match_schema = "tenant_.*"
match_table = "entity_1"
verdict = 1

[[transform_rule]]

[kafka_sink]
addr = "b1:9092,b2:9092"

[state_tracking]
state_topic = ""
'''


def test_config_pipeline_equals_code_pipeline(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/conf/sub")
    with open(f"{tmp_dir}/conf/sub/p1.toml", "w") as f:
        f.write(SAMPLE)
    [cfg] = load_configs(f"{tmp_dir}/conf", pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    assert cfg.spec.name == "p1" and cfg.kafka_servers == "b1:9092,b2:9092" and cfg.state_name == "p1-state"
    assert cfg.spec.rules[2].is_noop
    log = fx.chg_events(spark, SF_SMALL)
    got = run_batch(cfg.spec, log).select("gtid_seq", "topic", "key", "value")
    want = run_batch(PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"],
                                  timestamp=F.col("gtid_seq") * 1000), log).select("gtid_seq", "topic", "key", "value")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_javascript_rules_are_refused(tmp_dir):
    with open(f"{tmp_dir}/js.toml", "w") as f:
        f.write('[mysql]\nname = "x"\n[[transform_rule]]\nname = "js"\ntransform_func = "function transform(e) { return 0 }"\n')
    with pytest.raises(ValueError, match="JavaScript"):
        load_configs(f"{tmp_dir}/js.toml")


def test_command_line_runs_the_configured_pipelines(spark, tmp_dir):
    from rowcast.cli import main

    with open(f"{tmp_dir}/p1.toml", "w") as f:
        f.write(SAMPLE)
    log = fx.chg_events(spark, SF_SMALL)
    log.repartition(3).write.parquet(f"{tmp_dir}/log")
    main(["run", "-c", f"{tmp_dir}/p1.toml", "--log", f"{tmp_dir}/log", "--out", f"{tmp_dir}/out",
          "--checkpoint", f"{tmp_dir}/ck", "--pk", "user_id", "--files-per-trigger", "1", "--once"])
    got = spark.read.parquet(f"{tmp_dir}/out/p1/records")
    assert got.count() == run_batch(PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"]), log).count()
    assert segments(spark, f"{tmp_dir}/out/p1/p1-state") == [(0, 0), (1, 1), (2, 2)]
    assert spark.read.parquet(f"{tmp_dir}/out/p1/metrics").count() == 3
