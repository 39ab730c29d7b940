"""Session helpers: configuration, shared folders and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on.  Everything else is left to the cluster.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "rowcast") -> SparkSession:
    """Session for tests and local benchmarks (UI off, small shuffle count)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the event operators assume."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large batch run (to pass to the session builder).

    The per-event path is scan-bound: ``maxPartitionBytes`` sizes the scan
    tasks.  Shuffles (dedupe, per-key order, enrichment) start with enough
    partitions for ``partition_bytes`` each and AQE coalesces the small ones
    and splits skewed ones.
    """
    slots = executors * cores_per_executor
    shuffle = max(slots * 2, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a shared file system); the
    library never falls back to a machine-local folder there.  Only when it is
    unset in local mode (tests) a fresh temporary folder is configured.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
    root = tempfile.mkdtemp(prefix="rowcast-ckpt-")
    sc.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's outputs."""
    return f"{checkpoint_root(spark)}/rowcast/{name}-{uuid.uuid4().hex[:12]}"


def save_shared(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder (one job); the result reads it.

    Cuts lineage without a copy on any executor: a lost executor costs nothing,
    and plans built on the result don't contain the plan of ``df``."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads ([] if there is none)."""
    fs, p = _folder(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.mkdirs(p)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = _folder(spark, path)
    fs.delete(p, True)


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=eager)


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
