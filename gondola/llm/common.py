"""Helpers shared by the training-data operators: shared-folder tables and column packing."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.session import checkpoint_dir


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor and the driver share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors.

    The job's shuffle files go when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread_scan(df: DataFrame) -> DataFrame:
    """A scan of one small file is one task; deal its rows out before heavy per-row work.

    Tables of several files or row groups keep their own splits, so nothing is shuffled there.
    """
    files = len(df.inputFiles())
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted) if files == 1 else df
