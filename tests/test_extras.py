"""ENUM/SET labels, drop audit, schema evolution, partitioned logs, sizing."""

from conftest import row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowcast import functions as RF
from rowcast.operators.envelope import build_events
from rowcast.operators.rules import drop_rule, verdicts
from rowcast.plans import samples
from rowcast.session import cluster_conf
from rowcast.sources.changelog import evolve_rows, read_log, write_log


def test_enum_and_set_labels(spark):
    df = spark.createDataFrame([(1, 5), (3, 0), (0, 7), (9, 2)], "e int, s bigint")
    got = [(r.e, r.s) for r in df.select(RF.enum_label("e", ["1", "2", "3"]).alias("e"),
                                         RF.set_labels("s", ["a", "b", "c"]).alias("s")).collect()]
    assert got == [("1", ["a", "c"]), ("3", []), ("", ["a", "b", "c"]), (None, ["b"])]


def test_dropped_by_audit(make_log):
    log = make_log([("test_a", "test_x", "insert", [row(1, "ignore")], [], "u", 1, 0),
                    ("tenant_a", "entity_1", "insert", [row(2, "x")], [], "u", 2, 0),
                    ("prod", "t", "insert", [row(3, "x")], [], "u", 3, 0)])
    ev = build_events(log, pipeline="p", timestamp=F.lit(0))
    got = {r.gtid_seq: r._dropped_by for r in verdicts(ev, samples.sample_rules()).collect()}
    assert got == {1: "generic", 2: "another-rule", 3: None}
    counts = {r._dropped_by: r["count"] for r in verdicts(ev, [drop_rule("all")]).groupBy("_dropped_by").count().collect()}
    assert counts == {"all": 3}


def test_evolve_rows_unions_versions(spark):
    v1 = spark.createDataFrame([("s", "t", "insert", [(1, "a")], 1)],
                               "schema string, table string, action string, rows array<struct<id:int,name:string>>, gtid_seq bigint")
    v2 = spark.createDataFrame([("s", "t", "insert", [(2, "b", 9.5)], 2)],
                               "schema string, table string, action string, "
                               "rows array<struct<id:bigint,name:string,score:double>>, gtid_seq bigint")
    target = v2.schema["rows"].dataType.elementType
    both = evolve_rows(v1, target).unionByName(v2)
    ev = {r.gtid_seq: r.after[0] for r in build_events(both, pipeline="p", timestamp=F.lit(0)).collect()}
    assert ev[1].score is None and ev[1].id == 1 and ev[2].score == 9.5
    assert isinstance(both.schema["rows"].dataType.elementType["id"].dataType, T.LongType)


def test_partitioned_log_round_trip(make_log, tmp_dir):
    log = make_log([("a", "t1", "insert", [row(1, "x")], [], "u", 1, 0), ("b", "t2", "insert", [row(2, "y")], [], "u", 2, 0)])
    write_log(log, f"{tmp_dir}/log")
    back = read_log(log.sparkSession, f"{tmp_dir}/log")
    assert sorted(r.schema for r in back.select("schema").collect()) == ["a", "b"]


def test_cluster_conf_sizes():
    conf = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = cluster_conf(1 << 30, executors=2, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_image_row_helpers(spark):
    df = spark.createDataFrame([([(1, "a"), (2, "bb")],)], "img array<struct<id:int,t:string>>")
    out = df.select(RF.add_field("img", "n", lambda r: F.length(r["t"])).alias("a"),
                    RF.filter_rows("img", lambda r: r["id"] > 1).alias("f")).collect()[0]
    assert [x.n for x in out.a] == [1, 2] and [x.id for x in out.f] == [2]


def test_enrich_event_and_cut_lineage(spark, make_log):
    from rowcast.operators.delivery import enrich_event
    from rowcast.session import cut_lineage

    ev = build_events(make_log([("s", "t", "insert", [row(1, "a", user_id=7)], [], "u", 1, 0)]),
                      pipeline="p", timestamp=F.lit(0))
    dim = spark.createDataFrame([(7, "seven")], "id bigint, name string")
    out = enrich_event(ev, dim, on=(RF.first_row("after")["user_id"], "id"), fields=["name"])
    assert out.collect()[0].name == "seven"
    cut = cut_lineage(out)
    assert cut.count() == 1 and "LogicalRDD" in cut._jdf.queryExecution().logical().toString()
