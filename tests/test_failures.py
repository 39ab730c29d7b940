"""Failures: a crashed micro-batch is replayed without duplicates, and task
retries give the same results."""

import os
import subprocess
import sys

from conftest import SF_SMALL
from pyspark.sql import functions as F

from rowcast.plans import samples
from rowcast.plans.pipeline import PipelineSpec, run_batch
from rowcast.sources import fixtures as fx
from rowcast.sources.changelog import stream_log
from rowcast.operators.position import state_text
from rowcast.streaming.statelog import read_state, segments
from rowcast.streaming.stream import start_pipeline

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def spec():
    return PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)


def test_crashed_batch_is_replayed_without_duplicates(spark, tmp_dir):
    log = fx.chg_events(spark, SF_SMALL)
    log.repartition(3).write.parquet(f"{tmp_dir}/log")
    marker = f"{tmp_dir}/crashed"

    def crash_once(records, batch_id):
        records.write.mode("overwrite").parquet(f"{tmp_dir}/out/batch_id={batch_id}")
        if batch_id == 1 and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("simulated crash after writing")

    args = dict(state_path=f"{tmp_dir}/state", metrics_path=f"{tmp_dir}/metrics", writer=crash_once)
    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1),
                       None, f"{tmp_dir}/ck", **args)
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 - the query stops on the simulated crash
        pass
    assert os.path.exists(marker)
    q = start_pipeline(spec(), stream_log(spark, f"{tmp_dir}/log", log.schema, max_files_per_trigger=1),
                       None, f"{tmp_dir}/ck", **args)
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").select("gtid_seq", "topic", "key", "value")
    want = run_batch(spec(), log).select("gtid_seq", "topic", "key", "value")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert segments(spark, f"{tmp_dir}/state") == [(0, 0), (1, 1), (2, 2)]
    assert state_text(read_state(spark, f"{tmp_dir}/state")).first().n_events == log.count()
    assert spark.read.parquet(f"{tmp_dir}/metrics").count() == 3


RETRY_SCRIPT = r'''
import sys
sys.path.insert(0, REPO)
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from rowcast.session import configure
from rowcast.plans import samples
from rowcast.plans.pipeline import PipelineSpec, run_batch
from rowcast.sources import fixtures as fx
from rowcast.operators.delivery import dedupe, sequence_in_key

spark = configure(SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
                  .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4")
                  .getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("simulated executor loss")
    yield from batches

def result(fail):
    log = fx.chg_events(spark, SF, width=64)
    if fail:
        log = log.mapInArrow(flaky, log.schema)
    spec = PipelineSpec(name="p1", rules=samples.sample_rules(), pk=["user_id"], timestamp=F.col("gtid_seq") * 1000)
    recs = run_batch(spec, log)
    recs = sequence_in_key(dedupe(recs.unionByName(recs), copies="copies"), width=16)
    return sorted(tuple(r) for r in recs.collect())

clean, retried = result(False), result(True)
print("SAME" if clean == retried and len(clean) > 0 else "DIFFERENT")
'''


def test_task_retries_give_the_same_result(tmp_dir):
    script = f"{tmp_dir}/retry.py"
    with open(script, "w") as f:
        f.write(f"REPO = {REPO!r}\nSF = {SF_SMALL!r}\n" + RETRY_SCRIPT)
    out = subprocess.run([sys.executable, script], capture_output=True, text=True, timeout=600)
    assert "SAME" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
