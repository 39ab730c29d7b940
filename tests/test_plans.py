"""Plan shape: the per-event path is narrow, guards prune partitions, and
projections reach the scan."""

import contextlib
import io

from pyspark.sql import functions as F

from rowcast.operators.rules import SourceFilter
from rowcast.plans import samples
from rowcast.plans.pipeline import PipelineSpec, run_batch
from rowcast.sources import fixtures as fx
from rowcast.sources.changelog import read_log
from conftest import SF_SMALL


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def spec(**kw):
    return PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"],
                        timestamp=F.col("gtid_seq") * 1000, **kw)


def test_pipeline_over_a_log_has_no_shuffle(spark, tmp_dir):
    fx.chg_events(spark, SF_SMALL).write.parquet(f"{tmp_dir}/log")
    p = plan(run_batch(spec(), read_log(spark, f"{tmp_dir}/log")))
    assert "Exchange" not in p and "Sort " not in p
    assert "BroadcastHashJoin" not in p and "SortMergeJoin" not in p


def test_guards_prune_partitions_of_a_partitioned_log(spark, tmp_dir):
    fx.chg_events(spark, SF_SMALL).write.partitionBy("schema", "table").parquet(f"{tmp_dir}/log")
    log = read_log(spark, f"{tmp_dir}/log")
    out = run_batch(spec(source_filter=SourceFilter(include_schemas=["^test_"])), log)
    p = plan(out)
    assert "PartitionFilters: [" in p and "RLIKE(schema" in p.split("PartitionFilters: [", 1)[1].split("]")[0]
    want = run_batch(spec(), fx.chg_events(spark, SF_SMALL)).filter(F.col("value").contains('"schema":"test_'))
    assert out.count() == want.count()


def test_scan_reads_only_needed_columns(spark, tmp_dir):
    fx.chg_events(spark, SF_SMALL).write.parquet(f"{tmp_dir}/log")
    log = read_log(spark, f"{tmp_dir}/log")
    p = plan(log.filter(F.col("action") == "delete").select("gtid_seq", "action"))
    assert "PushedFilters: [IsNotNull(action), EqualTo(action,delete)]" in p
    read_schema = p.split("ReadSchema: ", 1)[1].split("\n", 1)[0]
    assert read_schema == "struct<action:string,gtid_seq:bigint>"


def test_no_python_in_expression_pipelines(spark, tmp_dir):
    fx.chg_events(spark, SF_SMALL).write.parquet(f"{tmp_dir}/log")
    p = plan(run_batch(spec(), read_log(spark, f"{tmp_dir}/log")))
    assert "MapInPandas" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_long_rule_chains_plan_linearly(spark):
    """Each rule reads the previous rule's outputs more than once; the plan
    must still grow linearly with the number of rules (no filter inlining)."""
    from rowcast import functions as RF
    from rowcast.operators.envelope import build_events
    from rowcast.operators.rules import Rule, apply_rules

    ev = build_events(fx.chg_events(spark, SF_SMALL), pipeline="p", timestamp=F.lit(0))

    def chain(n):
        rules = []
        for i in range(n):
            hit = RF.any_row("after", "text_col", (lambda t: (lambda v: v == t))(f"x{i}"))
            rules.append(Rule(f"r{i}", "test_.*" if i % 2 else "", "", verdict=F.when(hit, 1).otherwise(0),
                              set={"after": RF.mask_field("after", "text_col", 3 + i % 5)}))
        return apply_rules(ev, rules)

    size = {n: len(chain(n)._jdf.queryExecution().optimizedPlan().toString()) for n in (6, 12, 24)}
    per_rule_small = (size[12] - size[6]) / 6
    per_rule_large = (size[24] - size[12]) / 12
    assert per_rule_large < 1.5 * per_rule_small
    assert chain(24).count() == ev.count()


def test_leading_drop_rule_prunes_partitions(spark, tmp_dir):
    from rowcast.operators.rules import drop_rule

    fx.chg_events(spark, SF_SMALL).write.partitionBy("schema", "table").parquet(f"{tmp_dir}/log")
    log = read_log(spark, f"{tmp_dir}/log")
    rules = [drop_rule("drop-tenants", "tenant_.*", "entity_1")] + samples.sample_rules()
    out = run_batch(PipelineSpec(name="p1", rules=rules, pk=["user_id"], timestamp=F.col("gtid_seq") * 1000), log)
    p = plan(out)
    part = p.split("PartitionFilters: [", 1)[1].split("\n", 1)[0]
    assert "RLIKE(schema" in part and "entity_1" in part
    assert out.count() == run_batch(spec(), fx.chg_events(spark, SF_SMALL)).count()


def test_per_key_windows_are_bucketed(spark):
    p = plan(fx.chg_events(spark, SF_SMALL))
    windows = [line for line in p.splitlines() if line.startswith("Arguments: [lag(")]
    assert windows and all("_ord_bucket" in w for w in windows)


def test_chained_ordered_calls_scan_their_input_once(spark):
    from rowcast.operators.ordered import keyed_lag, keyed_running_sum, keyed_windows

    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_id", "user_id", "value")
    d = keyed_lag(df, ["user_id"], ["event_id"], ["value"], width=64)
    d = keyed_running_sum(d, ["user_id"], ["event_id"], "value", "s", width=64)
    d = keyed_windows(d, ["user_id"], ["event_id"], number="n", lasts={"l": "value"}, width=64)
    scans = [line for line in plan(d).splitlines() if "Location" in line and "events.parquet" in line]
    assert len(scans) == 1


def test_hot_key_is_spread_over_window_tasks(spark):
    from rowcast.operators.ordered import keyed_row_number

    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(100_000).select(F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                         F.col("id").alias("o"))
        # an input that is partitioned by the key already must be split all the same
        out = keyed_row_number(df.repartition("k"), ["k"], ["o"], "rn", width=500)
        tasks = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("rn").alias("s")).collect()]
        assert len(tasks) == 8 and max(tasks) < 2.5 * 100_000 / 8
        assert out.agg(F.sum(F.when(F.col("k") == "hot", F.col("rn")))).first()[0] == 90_000 * 90_001 // 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_many_pipelines_have_one_scan(spark, tmp_dir):
    """Twenty pipelines over a stored log: one scan, one envelope, and each gives
    what it gives alone."""
    from rowcast import functions as RF
    from rowcast.operators.rules import Rule, SourceFilter
    from rowcast.plans.pipeline import PipelineSpec, run_batch, run_many

    log = fx.chg_events(spark, SF_SMALL)
    log.write.parquet(f"{tmp_dir}/log")
    log = spark.read.parquet(f"{tmp_dir}/log")
    drop = Rule("drop", "test_.*", "", verdict=F.when(RF.any_row_eq("after", "text_col", "ignore"), 1).otherwise(2))
    specs = [PipelineSpec(f"p{k}", [drop, Rule("t", set={"kafka.topic": F.lit(f"t{k}")})][: 1 + k % 2],
                          source_filter=SourceFilter(exclude_schemas=["audit"]) if k % 3 == 0 else None,
                          pk=["user_id"] if k % 4 else None, timestamp=F.lit(0)) for k in range(20)]
    out = run_many(specs, log)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Union") == 0
    for k in (0, 3, 5, 6):
        alone = run_batch(specs[k], log)
        mine = out.where(F.col("pipeline") == f"p{k}").select(alone.columns)
        assert mine.count() == alone.count() > 0 and mine.exceptAll(alone).count() == 0


def test_many_chains_are_a_few_projections(spark, tmp_dir):
    """Thirty chains of their own rules: as many projections as the longest chain
    needs, and each chain gives what it gives alone."""
    from rowcast import functions as RF
    from rowcast.operators.rules import Rule
    from rowcast.plans.pipeline import PipelineSpec, run_batch, run_many

    log = fx.chg_events(spark, SF_SMALL)
    log.write.parquet(f"{tmp_dir}/log")
    log = spark.read.parquet(f"{tmp_dir}/log")
    kinds = [
        [Rule("odd", "^test", "", verdict=F.when(F.col("gtid_seq") % 2 == 1, 1).otherwise(2)), Rule("noop")],
        [Rule("null", "", "entity", verdict=F.when(F.col("gtid_seq") % 3 == 0, 0))],
        [Rule("whole", "", "entity", set={"kafka": F.struct(F.lit("w").alias("topic"), F.col("kafka.topic").alias("key"))}),
         Rule("field", set={"kafka.key": F.concat("kafka.key", F.lit("+"))})],
        [Rule("rows", "", "", set={"after[].text_col": "upper(r.text_col)", "kafka.topic": F.lit("t")})],
        [Rule("table", "^test", "", set={"table": F.lit("renamed"), "meta.timestamp": F.col("gtid_seq")}), Rule("seen", "", "renamed", verdict=1)],
        []]
    specs = [PipelineSpec(f"p{k}", [Rule(r.name, r.match_schema, r.match_table, r.verdict, r.set) for r in kinds[k % 6]], pk=["user_id"],
                          timestamp=F.lit(0), on_null_verdict="drop" if k % 2 else "pass") for k in range(30)]
    out = run_many(specs, log)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("Project [") <= 8
    for k in range(12):
        alone = run_batch(specs[k], log)
        mine = out.where(F.col("pipeline") == f"p{k}").select(alone.columns)
        assert mine.count() == alone.count() > 0 and mine.exceptAll(alone).count() == 0


def test_guard_matrix_equals_guards(spark):
    """The fold with guard bits: no-ops, rules that match nothing before, between
    and after others, and guards after a rule that renames the table."""
    from rowcast.operators.rules import GuardMatrix, Rule, apply_rules
    from rowcast.operators.envelope import build_events

    log = fx.chg_events(spark, SF_SMALL)
    ev = build_events(log, pipeline="p", timestamp=F.lit(0), pk=["user_id"])
    none = Rule("none", "^nowhere$", "", verdict=1)
    odd = Rule("odd", "^test", "entity", verdict=F.when(F.col("gtid_seq") % 2 == 1, 2).otherwise(0))
    rename = Rule("rename", "^tenant", "", set={"table": F.lit("renamed")})
    after = Rule("after", "", "^renamed$", verdict=F.when(F.col("gtid_seq") % 3 == 0, 1).otherwise(0))
    for rules in ([none, odd], [odd, none], [odd, Rule("noop")], [none, none], [none, odd, rename, after, none],
                  [*[Rule(f"x{i}", f"^no{i}$", "", verdict=1) for i in range(130)], odd]):
        want = apply_rules(ev, rules).select("gtid_seq", "table")
        guards = GuardMatrix(log, rules)
        got = apply_rules(ev, rules, guards=guards)
        assert got.columns == ev.columns
        got = got.select("gtid_seq", "table")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert sum(guards.needed(i) for i in range(131)) == 1
