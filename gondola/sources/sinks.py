"""Sinks (SNK-1 … SNK-12) as plain writer helpers.

Mutations never overwrite the path being read: a new version is written next to it and then
becomes current (SNK-2). Appends evolve the schema by name (SNK-3).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gondola.session import has_parquet


def overwrite_table(df: DataFrame, name: str) -> None:
    """SNK-1: overwrite a managed table."""
    df.write.mode("overwrite").saveAsTable(name)


def append_table(spark: SparkSession, df: DataFrame, name: str) -> None:
    """SNK-3 / SNK-4: append by column name; target columns missing from ``df`` are NULL, and new
    columns in ``df`` evolve the table (rewritten once as a new version with the union schema)."""
    if not spark.catalog.tableExists(name):
        df.write.saveAsTable(name)
        return
    cur = spark.table(name)
    new = [f for f in df.schema.fields if f.name not in cur.columns]
    if new:   # a change of metadata only: old rows read the new columns as null
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
        cur = spark.table(name)
    types = {f.name: f.dataType for f in cur.schema.fields}
    aligned = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c)
                          for c in cur.columns])
    aligned.write.insertInto(name)


def insert_overwrite(df: DataFrame, name: str) -> None:
    """SNK-5: ``INSERT OVERWRITE`` by position into an existing table."""
    df.write.insertInto(name, overwrite=True)


def write_version(df: DataFrame, base: str, version: int) -> str:
    """SNK-2 / SNK-8: write a new version of a table to its own path and return it (callers switch
    the current pointer only after the write succeeded)."""
    path = f"{base.rstrip('/')}/v={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def current_version(spark: SparkSession, base: str) -> int:
    """The version that readers see, 0 before the first switch."""
    if not has_parquet(spark, f"{base}/switched"):
        return 0
    return spark.read.schema("version int").parquet(f"{base}/switched").agg({"version": "max"}).first()[0]


def switch_version(spark: SparkSession, base: str, version: int, view: str | None = None) -> None:
    """Make a written version current: one row is added to the table of switches, and ``view``, if given, is replaced.
    Older versions stay readable for queries that began before."""
    spark.createDataFrame([(version,)], "version int").coalesce(1).write.mode("append").parquet(f"{base}/switched")
    if view:
        read_current(spark, base).createOrReplaceTempView(view)


def read_current(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/v={current_version(spark, base)}")


def publish(df: DataFrame, base: str, view: str | None = None) -> int:
    """Recompute a table as a new version (SNK-2, SNK-8): written whole, then switched to. A crash before the
    switch leaves the old version current, and the next call writes the same version number anew."""
    spark = df.sparkSession
    version = current_version(spark, base) + 1
    write_version(df, base, version)
    switch_version(spark, base, version, view)
    return version


def append_run(df: DataFrame, name: str, run_col: str, run: str, path: str | None = None) -> None:
    """SNK-3 / SNK-5: write the rows of one run into a table partitioned by ``run_col`` (a string). The run's
    own partition is replaced and no other, so a retry gives the same table. Columns that the table lacks are added
    (older rows read null), columns that ``df`` lacks are null."""
    spark = df.sparkSession
    df = df.drop(run_col)
    if not spark.catalog.tableExists(name):
        writer = df.withColumn(run_col, F.lit(run)).write.format("parquet").partitionBy(run_col)
        (writer.option("path", path) if path else writer).saveAsTable(name)
        return
    have = spark.table(name).columns
    new = [f for f in df.schema.fields if f.name not in have]
    if new:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
    fields = [f for f in spark.table(name).schema.fields if f.name != run_col]
    aligned = df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (`{run_col}` = :run) SELECT * FROM {_view(aligned)}", args={"run": run})


def _view(df: DataFrame) -> str:
    name = f"rows_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    return name


def insert_columns(df: DataFrame, name: str) -> None:
    """SNK-4: ``INSERT INTO t (columns) SELECT``: by name, the columns not listed are null."""
    listed = ", ".join(f"`{c}`" for c in df.columns)
    df.sparkSession.sql(f"INSERT INTO {name} ({listed}) SELECT {listed} FROM {_view(df)}")


def land_csv_by_date(df: DataFrame, root: str, date_col: str = "week_date") -> None:
    """SNK-10: pipe-separated CSV with header, one folder per date (``<root>/<date_col>=<date>/``)."""
    (df.write.mode("append").partitionBy(date_col).option("sep", "|").option("header", True)
     .csv(root))
