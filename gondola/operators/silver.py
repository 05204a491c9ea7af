"""Silver price refinement (PIP-1, PIP-2, PRJ-9).

Plan shape of ``silver_prices`` at scale:
  * the product feed (the only large input) is reduced to one row per (store, chain, week) by a
    partial + final count before it meets any join — that aggregate is tiny;
  * stores ⋈ chains and the area filter run on dimension-sized data;
  * the top-1 store per (chain, area group, week) is a ``row_number`` window over the tiny counts
    (Spark plans it as a ``WindowGroupLimit`` that prunes before the shuffle);
  * the single wide join is feed ⋈ chosen stores on (store, chain, week). The right side has at
    most stores × weeks rows; AQE turns it into a broadcast join when its runtime size is under the
    threshold and otherwise splits skewed feed partitions (a hot store) with the skew-join rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.seeds import TARGET_AREAS as REFERENCE_AREAS          # fixed values of the original feed
from gondola.seeds import TARGET_LOCALITIES as REFERENCE_LOCALITIES

# Stand-in parameters for the driver tables: three named areas + two whole localities (regions).
FIXTURE_AREAS = ["nation_3", "nation_7", "nation_12"]
FIXTURE_LOCALITIES = ["africa", "america"]

OTHER_GROUP = "caba"


def norm(c: Column | str) -> Column:
    """Case- and blank-insensitive key (pin D4: lower(trim()))."""
    return F.lower(F.trim(F.col(c) if isinstance(c, str) else c))


def parse_price(text: Column) -> Column:
    """Decimal-comma price text -> double; malformed text ('1.234,50') -> NULL (pin D2)."""
    return F.expr("try_cast(replace({0}, ',', '.') as double)".format(text._jc.toString()))


def area_group(barrio: Column, areas: Sequence[str], other: str = OTHER_GROUP) -> Column:
    """CASE chain built from a list (PRJ-3): the named area itself, else the catch-all group."""
    expr = F.lit(other)
    for a in areas:
        expr = F.when(norm(barrio) == F.lit(a), F.lit(a)).otherwise(expr)
    return expr


def dedupe_chains(chains: DataFrame) -> DataFrame:
    """One row per chain id; the name is the smallest one (pin D1, deterministic)."""
    return chains.groupBy("id_comercio").agg(F.min("cadena").alias("cadena"))


def best_stores(products: DataFrame, stores: DataFrame, chains: DataFrame,
                areas: Sequence[str], localities: Sequence[str]) -> DataFrame:
    """Representative store per chain × area group × week (WIN-1), ties to the smallest store id. Stores with
    a ``week_date`` of their own meet the products of that week only (pin D3)."""
    areas = [a.lower() for a in areas]
    localities = [x.lower() for x in localities]
    st = (stores.join(dedupe_chains(chains), "id_comercio", "inner")
          .filter(norm("sucursales_barrio").isin(areas) | norm("sucursales_localidad").isin(localities))
          .withColumn("barrio_group", area_group(F.col("sucursales_barrio"), areas)))
    counts = (products.groupBy("id_sucursal", "id_comercio", "week_date")
              .agg(F.count("id_producto").alias("product_count")))
    w = Window.partitionBy("id_comercio", "barrio_group", "week_date").orderBy(
        F.col("product_count").desc(), F.col("id_sucursal").asc())
    on = ["id_sucursal", "id_comercio"] + (["week_date"] if "week_date" in stores.columns else [])
    return (st.join(counts, on, "inner")
            .withColumn("rank", F.row_number().over(w))
            .filter(F.col("rank") == 1)
            .drop("rank"))


def silver_prices(products: DataFrame, stores: DataFrame, chains: DataFrame,
                  areas: Sequence[str] = REFERENCE_AREAS,
                  localities: Sequence[str] = REFERENCE_LOCALITIES) -> DataFrame:
    """PIP-1: bronze feed -> one price row per product at the representative store.

    Output: week_date date, id_producto, id_comercio, producto, presentacion, cadena,
    sucursal_nombre, sucursales_barrio, sucursales_direccion, precio double.
    """
    best = best_stores(products, stores, chains, areas, localities).select(
        "id_sucursal", "id_comercio", "week_date", "cadena", "sucursal_nombre", "sucursales_barrio",
        F.concat_ws(" ", "sucursales_calle", "sucursales_numero").alias("sucursales_direccion"))
    feed = products.select("id_sucursal", "id_comercio", "week_date", "id_producto",
                           "productos_descripcion", "presentacion", "productos_precio_lista")
    return (feed.join(best, ["id_sucursal", "id_comercio", "week_date"], "inner")
            .select(
                F.expr("try_to_date(week_date, 'yyyy-MM-dd')").alias("week_date"),
                "id_producto", "id_comercio",
                F.col("productos_descripcion").alias("producto"),
                "presentacion", "cadena", "sucursal_nombre", "sucursales_barrio",
                "sucursales_direccion",
                parse_price(F.col("productos_precio_lista")).alias("precio"))
            .filter(F.col("precio").isNotNull() & (F.col("precio") > 0)))


def expectation_counts(products: DataFrame) -> DataFrame:
    """PRJ-9: data-quality expectations counted in one pass (warn, keep rows).

    Returns one row: rows, and the number of rows violating each expectation. In a write job the
    same expressions go into ``DataFrame.observe`` so the counts come for free with the write.
    """
    price = parse_price(F.col("productos_precio_lista"))
    return products.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(price > 0, F.lit(False))).alias("fail_valid_price"),
        F.count_if(F.col("productos_descripcion").isNull()).alias("fail_valid_product_name"),
        F.count_if(F.expr("try_to_date(week_date, 'yyyy-MM-dd')").isNull()).alias("fail_valid_week_date"),
    )


def latest_local_prices(products: DataFrame, stores: DataFrame, chains: DataFrame,
                        areas: Sequence[str], chain_names: Sequence[str]) -> DataFrame:
    """PIP-2: newest week only (SRC-3), selected areas and named chains, one row per
    product × chain × area with the store chosen by name (WIN-3).

    The newest week is a scalar subquery: Spark evaluates it once and, on a feed partitioned by
    ``week_date``, prunes every other folder from the scan.
    """
    areas = [a.lower() for a in areas]
    names = [c.lower() for c in chain_names]
    latest = products.select(F.max("week_date")).scalar()
    ch = dedupe_chains(chains).filter(norm("cadena").isin(names))
    st = (stores.join(ch, "id_comercio", "inner")
          .filter(norm("sucursales_barrio").isin(areas))
          .select("id_sucursal", "id_comercio", "cadena", "sucursal_nombre", "sucursales_barrio"))
    feed = (products.filter(F.col("week_date") == latest)
            .select("week_date", "id_sucursal", "id_comercio", "id_producto",
                    F.col("productos_descripcion").alias("producto"),
                    parse_price(F.col("productos_precio_lista")).alias("precio")))
    w = Window.partitionBy("id_producto", "id_comercio", "sucursales_barrio").orderBy(
        F.col("sucursal_nombre").asc(), F.col("precio").asc_nulls_last())
    return (feed.join(st, ["id_sucursal", "id_comercio"], "inner")
            .filter(F.col("precio").isNotNull() & (F.col("precio") > 0))
            .withColumn("rn", F.row_number().over(w))
            .filter("rn = 1")
            .select(F.expr("try_to_date(week_date, 'yyyy-MM-dd')").alias("week_date"),
                    "id_producto", "producto", "id_comercio", "cadena", "sucursales_barrio",
                    "sucursal_nombre", "precio"))
