"""Session construction and cluster-facing settings.

Everything scale-related lives here so operators stay declarative:
AQE (coalesce + skew join) re-plans at runtime from real shuffle statistics, broadcast decisions
above the explicit seed/dimension hints are left to Spark's own size check
(``spark.sql.autoBroadcastJoinThreshold``), and lineage cuts go to the shared folder named by
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "gondola", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``shuffle_partitions`` should be sized so one partition stays in the low hundreds of MB at the
    target scale; AQE then coalesces small ones. Local tests pass the core count.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():   # runtime SQL settings also apply to an already running session
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts.

    Read ``spark.checkpoint.dir`` from the session (a cluster names a shared, fault-tolerant
    path there). Only when it is unset in local mode — one machine, as in tests — take a fresh
    scratch folder; on a cluster a machine-local folder would lose data, so an unset one is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="gondola-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables that cut lineage."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet file lies at or below ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    files = fs.listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def read_if_written(spark: SparkSession, path: str):
    """The Parquet table at ``path``, or None when it holds no data file yet. A table that is there
    but can't be read is an error, not an empty table."""
    return spark.read.parquet(path) if has_parquet(spark, path) else None


def spread(df, min_partitions: int | None = None):
    """Round-robin ``df`` over the cluster when its scan yields fewer partitions than the default
    parallelism (e.g. one large row group), before a CPU-heavy narrow stage (tokenising, n-grams).
    On real inputs — many files and row groups — this is a no-op and adds no shuffle."""
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
