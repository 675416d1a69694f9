"""Session helpers: a tuned SparkSession for local runs and the
checkpoint folder used to cut lineage in iterative jobs."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Shuffle partitions scale with the cluster; AQE coalesces small ones and
# splits skewed join partitions at runtime.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of frontiers no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "quire", driver_memory: str = "8g") -> SparkSession:
    """A local[N] session for tests and the bench (one JVM)."""
    n = os.cpu_count() if cores == "*" else int(cores)
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(2, n)))
    b = b.config("spark.default.parallelism", str(max(2, n)))
    b = b.config("spark.driver.memory", driver_memory)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared,
    fault-tolerant file system). Only when nothing is configured -- local
    tests -- a fresh scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative jobs")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_table(spark: SparkSession, df):
    """Write ``df`` once to the shared checkpoint folder and read it back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cluster_settings(input_bytes: int, executors: int, cores_per_executor: int) -> dict[str, str]:
    """Suggested settings for a cluster run over ``input_bytes`` of landed
    data: ~256 MB input splits, enough shuffle partitions for ~200 MB per
    partition before AQE coalesces them, skew splitting on."""
    slots = max(1, executors * cores_per_executor)
    parts = max(slots * 3, input_bytes // (200 << 20))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
