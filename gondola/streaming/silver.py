"""Three feed streams into silver (SRC-1, STR-1, STR-2, SNK-7, SNK-8).

Products, stores and chains arrive as files per date folder, in any order. Every micro-batch lands in its
own folder of the bronze table, split by week, and notes the weeks it touched; a chain touches the weeks
in which its products have arrived. ``refresh`` recomputes only the noted weeks of silver and replaces just
their partitions. What was recomputed is noted after the write, so a crash between any two steps is mended by
running the step again: a replayed micro-batch overwrites its own folder, and a week not noted as done is
recomputed from all that has landed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gondola.operators.silver import silver_prices
from gondola.session import has_parquet, read_if_written
from gondola.streaming.bronze import all_string, bronze_stream

KINDS = {
    "productos": ["id_comercio", "id_sucursal", "id_producto", "productos_descripcion", "presentacion", "productos_precio_lista",
                  "productos_precio_referencia", "productos_cantidad_referencia"],
    "sucursales": ["id_sucursal", "id_comercio", "sucursales_barrio", "sucursales_localidad", "sucursales_calle", "sucursales_numero", "sucursal_nombre"],
    "comercio": ["id_comercio", "cadena"],
}
#: Names in the raw files that differ from those of the tables (fixed values of the feed).
RAW_NAMES = {"presentacion": "productos_unidad_medida_presentacion", "sucursal_nombre": "sucursales_nombre", "cadena": "comercio_bandera_nombre"}


def raw_columns(kind: str) -> list[str]:
    return [RAW_NAMES.get(c, c) for c in KINDS[kind]]


def _schema(kind: str) -> T.StructType:
    return all_string([*KINDS[kind], "week_date", "batch_id"])


def bronze_table(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All that has landed of one kind; empty before its first file."""
    path = f"{root}/bronze/{kind}"
    if not has_parquet(spark, path):
        return spark.createDataFrame([], _schema(kind)).drop("batch_id")
    return spark.read.schema(_schema(kind)).parquet(path).drop("batch_id")


def ingest(spark: SparkSession, landing: str, root: str, kind: str) -> None:
    """Read the files of ``kind`` that are new below ``<landing>/<kind>/*/``, then stop; every file exactly once."""
    stream = bronze_stream(spark, f"{landing}/{kind}/*/*.csv", raw_columns(kind))
    stream = stream.select("week_date", *[F.col(RAW_NAMES.get(c, c)).alias(c) for c in KINDS[kind]])

    def land(batch: DataFrame, batch_id: int) -> None:
        path = f"{root}/bronze/{kind}/batch_id={batch_id}"
        batch.write.mode("overwrite").partitionBy("week_date").parquet(path)
        if not has_parquet(spark, path):  # a batch without rows
            return
        mine = spark.read.schema(all_string([*KINDS[kind], "week_date"])).parquet(path)
        if kind == "comercio":  # a chain has no week of its own; one that is known by this name touches none
            known = spark.read.schema(_schema(kind)).parquet(f"{root}/bronze/{kind}").where(F.col("batch_id").cast("long") < batch_id)
            fresh = mine.join(known.select("id_comercio", "cadena"), ["id_comercio", "cadena"], "left_anti")
            weeks = bronze_table(spark, root, "productos").join(fresh, "id_comercio", "left_semi").select("week_date")
        else:
            weeks = mine.select("week_date")
        weeks = weeks.where(F.col("week_date").isNotNull()).distinct().withColumn("kind", F.lit(kind)).withColumn("batch", F.lit(batch_id).cast("long"))
        weeks.coalesce(1).write.mode("overwrite").parquet(f"{root}/touched/{kind}-{batch_id}")

    query = (stream.writeStream.foreachBatch(land).option("checkpointLocation", f"{root}/_chk/{kind}").trigger(availableNow=True).start())
    query.awaitTermination()


def pending_weeks(spark: SparkSession, root: str) -> DataFrame:
    """(kind, batch, week_date) noted and not yet refreshed."""
    def notes(name: str) -> DataFrame | None:
        if not has_parquet(spark, f"{root}/{name}"):
            return None
        return spark.read.option("recursiveFileLookup", True).schema("week_date string, kind string, batch long").parquet(f"{root}/{name}")

    touched, done = notes("touched"), notes("done")
    if touched is None:
        return spark.createDataFrame([], "week_date string, kind string, batch long")
    return touched if done is None else touched.join(done, ["week_date", "kind", "batch"], "left_anti")


def refresh(spark: SparkSession, root: str, areas: Sequence[str], localities: Sequence[str]) -> list[str]:
    """Recompute the pending weeks of ``<root>/silver`` and return them, oldest first (calendar weeks: a short list)."""
    pending = pending_weeks(spark, root).cache()
    weeks = sorted(r.week_date for r in pending.select("week_date").distinct().collect())
    if weeks:
        here = F.col("week_date").isin(weeks)  # prunes the partitions of other weeks
        silver = silver_prices(bronze_table(spark, root, "productos").where(here), bronze_table(spark, root, "sucursales").where(here).distinct(),
                               bronze_table(spark, root, "comercio"), areas, localities)
        (silver.withColumn("week", F.date_format("week_date", "yyyy-MM-dd")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("week").parquet(f"{root}/silver"))
        pending.write.parquet(f"{root}/done/{uuid.uuid4().hex}")
    pending.unpersist()
    return weeks


def silver_table(spark: SparkSession, root: str) -> DataFrame | None:
    out = read_if_written(spark, f"{root}/silver")
    return None if out is None else out.drop("week")
