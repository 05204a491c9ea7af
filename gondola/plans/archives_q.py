"""Query key ``archive_expand``: feed lines are packed the way the source publishes them (outer ZIP ->
inner ZIP named with the date -> productos / sucursales / comercio CSV, the chains file with a UTF-8
BOM), in archives of bounded size, then expanded and landed per date with Spark, and the landed rows
are counted per week and kind."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F

from gondola.plans.registry import register
from gondola.plans.sql_standins import BRONZE_CHAINS, BRONZE_PRODUCTS, BRONZE_STORES, with_
from gondola.session import checkpoint_dir, scratch_path
from gondola.sources import archives, standins

COLUMNS = {
    "productos": ["id_comercio", "id_sucursal", "id_producto", "productos_descripcion",
                  "productos_unidad_medida_presentacion", "productos_precio_lista",
                  "productos_precio_referencia", "productos_cantidad_referencia"],
    "sucursales": ["id_sucursal", "id_comercio", "sucursales_barrio", "sucursales_localidad",
                   "sucursales_calle", "sucursales_numero", "sucursales_nombre"],
    "comercio": ["id_comercio", "comercio_bandera_nombre"],
}


#: Lines of one archive, about; a week with more of one kind is published in several.
ARCHIVE_LINES = 20_000


def _line(cols):
    return F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in cols])


def _feed_lines(t):
    p = standins.bronze_products(t.lineitem, t.part)
    s = standins.bronze_stores(t.supplier, t.nation, t.region).withColumnRenamed("sucursal_nombre", "sucursales_nombre")
    c = standins.bronze_chains(t.region).withColumnRenamed("cadena", "comercio_bandera_nombre")
    prod = p.withColumnRenamed("presentacion", "productos_unidad_medida_presentacion").select(
        "week_date", F.lit("productos").alias("kind"), _line(COLUMNS["productos"]).alias("line"))
    active = p.select("week_date", "id_sucursal", "id_comercio").distinct()
    stores = active.join(s, ["id_sucursal", "id_comercio"]).select(
        "week_date", F.lit("sucursales").alias("kind"), _line(COLUMNS["sucursales"]).alias("line"))
    chains = active.select("week_date", "id_comercio").distinct().join(c, "id_comercio").select(
        "week_date", F.lit("comercio").alias("kind"), _line(COLUMNS["comercio"]).alias("line"))
    return prod.unionByName(stores).unionByName(chains)


def _archive(pdf: pd.DataFrame) -> pd.DataFrame:
    """One archive of a part's lines: outer ZIP -> inner ZIP named with the week -> the kind's CSV."""
    week, kind, part = (pdf[c].iloc[0] for c in ("week_date", "kind", "part"))
    text = "\n".join(["|".join(COLUMNS[kind]), *sorted(pdf["line"])]) + "\n"
    body = (("\ufeff" if kind == "comercio" else "") + text).encode("utf-8")
    inner = archives.build_zip({f"{kind}.csv": body})
    return pd.DataFrame({"path": [f"sepa_{week}_{kind}_{part}.zip"], "content": [archives.build_zip({f"sepa_{week}.zip": inner})]})


def _archives(lines, archive_lines: int = ARCHIVE_LINES):
    """(path, content): the feed packed as archives of about ``archive_lines`` lines each, however long a week is."""
    sizes = lines.groupBy("week_date", "kind").agg(F.ceil(F.count(F.lit(1)) / archive_lines).alias("parts"))
    dealt = lines.join(sizes, ["week_date", "kind"]).withColumn("part", F.pmod(F.xxhash64("n"), F.col("parts")))
    return dealt.select("week_date", "kind", "part", "line").groupBy("week_date", "kind", "part").applyInPandas(_archive, "path string, content binary")


@register("archive_expand", with_(BRONZE_PRODUCTS, BRONZE_STORES, BRONZE_CHAINS, """
active AS (SELECT DISTINCT week_date, id_sucursal, id_comercio FROM bronze_products)""") + """
SELECT week_date, 'productos' AS kind, count(*) AS n_rows FROM bronze_products GROUP BY week_date
UNION ALL
SELECT a.week_date, 'sucursales', count(*) FROM active a JOIN bronze_stores s
  ON a.id_sucursal = s.id_sucursal AND a.id_comercio = s.id_comercio GROUP BY a.week_date
UNION ALL
SELECT a.week_date, 'comercio', count(*) FROM (SELECT DISTINCT week_date, id_comercio FROM active) a
  JOIN bronze_chains c ON a.id_comercio = c.id_comercio GROUP BY a.week_date""",
          ids="SRC-5 SRC-6 PIP-56 SNK-10 SET-1")
def archive_expand(t):
    spark = t.spark
    root = scratch_path(spark, f"archives/{uuid.uuid4().hex[:8]}")
    checkpoint_dir(spark)
    # numbered rows are checkpointed, so equal lines are dealt apart and a lost task deals them alike
    feed = _feed_lines(t).withColumn("n", F.monotonically_increasing_id()).checkpoint()
    lines = archives.expand_archives(_archives(feed)).checkpoint()   # expanded once, landed three times
    for kind, cols in COLUMNS.items():
        archives.land_lines(lines, kind, cols, f"{root}/landing")
    counts = None
    for kind in COLUMNS:
        landed = (spark.read.option("sep", "|").option("header", True)
                  .option("recursiveFileLookup", False).csv(f"{root}/landing/{kind}"))
        c = (landed.groupBy(F.col("week_date").cast("string").alias("week_date"))
             .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("kind", F.lit(kind)))
        counts = c if counts is None else counts.unionByName(c)
    return counts.select("week_date", "kind", "n_rows")
