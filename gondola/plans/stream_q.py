"""Query keys for streaming ingest: each lands data derived from the driver tables into a fresh
folder under ``spark.checkpoint.dir``, runs the stream to completion (``availableNow``) and returns
the sink read back as a batch table — which must equal the batch result (the oracle)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gondola.operators import vectors as V
from gondola.plans import silver_q, vectors_q
from gondola.plans.registry import REGISTRY, register
from gondola.plans.sql_standins import BRONZE_PRODUCTS, with_
from gondola.session import scratch_path
from gondola.sources import sinks, standins
from gondola.streaming import bronze
from gondola.streaming import silver as stream_silver

FEED_RENAME = {"presentacion": "productos_unidad_medida_presentacion"}


@register("bronze_stream", with_(BRONZE_PRODUCTS) + """
SELECT week_date, CAST(l.id_comercio AS VARCHAR) AS id_comercio, id_sucursal, id_producto, productos_descripcion,
       presentacion, productos_precio_lista, CAST(NULL AS VARCHAR) AS productos_precio_referencia,
       CAST(NULL AS VARCHAR) AS productos_cantidad_referencia
FROM bronze_products l""", ids="SRC-1 SRC-2 STR-1 STR-2 STR-3 SNK-7 SNK-10")
def bronze_stream(t):
    spark = t.spark
    root = scratch_path(spark, f"landing/{uuid.uuid4().hex[:8]}")
    feed = standins.bronze_products(t.lineitem, t.part).withColumnRenamed(
        "presentacion", FEED_RENAME["presentacion"])
    sinks.land_csv_by_date(feed, f"{root}/productos")
    stream = bronze.bronze_stream(spark, f"{root}/productos/*/*.csv", bronze.PRODUCT_COLUMNS)
    stream = stream.withColumnRenamed(FEED_RENAME["presentacion"], "presentacion")
    bronze.ingest_available(stream, f"{root}/bronze_products", f"{root}/_chk/bronze_products")
    return spark.read.parquet(f"{root}/bronze_products")


@register("stream_classify", "WITH hier AS (" + REGISTRY["classify_hier"].sql + ")\nSELECT * FROM hier",
          ids="STR-4 SNK-3 JN-5")
def stream_classify(t):
    spark = t.spark
    root = scratch_path(spark, f"stream_classify/{uuid.uuid4().hex[:8]}")
    emb = t.embeddings.select("vec_id", "embedding", "label")
    emb.repartition(4, "vec_id").write.parquet(f"{root}/incoming")   # arriving files
    macro_c, cat_c = vectors_q._macro_centroids(t), vectors_q._cat_centroids(t)

    def classify(df):
        return V.classify_hierarchical(df, ["vec_id", "label"], "embedding", macro_c, "id_macro", cat_c,
                                       "id_categoria", "id_macro", vectors_q.HIER_MACRO, vectors_q.HIER_CAT)

    stream = spark.readStream.schema(emb.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/incoming")
    bronze.classify_stream(stream.select("vec_id", "label", "embedding"), "vec_id", "embedding",
                           f"{root}/staging", f"{root}/_chk", lambda df: classify(df))
    return spark.read.parquet(f"{root}/staging").drop("batch_id")


def land_feeds(t, landing: str, kinds=("productos", "sucursales", "comercio")) -> None:
    """The raw files of the three feeds: stores in every week in which they sell, chains in the first week."""
    products = standins.bronze_products(t.lineitem, t.part)
    first = products.select(F.min("week_date")).scalar()
    stores = standins.bronze_stores(t.supplier, t.nation, t.region)
    feeds = {"productos": products,
             "sucursales": products.select("week_date", "id_sucursal", "id_comercio").distinct().join(stores, ["id_sucursal", "id_comercio"]),
             "comercio": standins.bronze_chains(t.region).withColumn("week_date", first)}
    for kind in kinds:
        feed = feeds[kind].withColumnsRenamed(stream_silver.RAW_NAMES)
        sinks.land_csv_by_date(feed.select("week_date", *stream_silver.raw_columns(kind)).repartition("week_date"), f"{landing}/{kind}")


@register("silver_from_streams", silver_q.SILVER_SQL, ids="SRC-1 STR-1 STR-2 SNK-7 SNK-8 PIP-1")
def silver_from_streams(t):
    """Silver from three streams that arrive one after the other, stores last."""
    spark = t.spark
    root = scratch_path(spark, f"silver_from_streams/{uuid.uuid4().hex[:8]}")
    land_feeds(t, f"{root}/landing")
    for kind in ("productos", "comercio", "sucursales"):
        stream_silver.ingest(spark, f"{root}/landing", root, kind)
    stream_silver.refresh(spark, root, silver_q._AREAS, silver_q._LOCS)
    return stream_silver.silver_table(spark, root)
