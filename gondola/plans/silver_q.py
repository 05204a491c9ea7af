"""Query keys for price refinement: silver_best_store (flagship), silver_latest_local, dq_expectations."""

from __future__ import annotations

from gondola.operators import silver
from gondola.plans.registry import register
from gondola.plans.sql_standins import BRONZE_CHAINS, BRONZE_PRODUCTS, BRONZE_STORES, with_
from gondola.sources import standins


def _bronze(t):
    return (standins.bronze_products(t.lineitem, t.part),
            standins.bronze_stores(t.supplier, t.nation, t.region),
            standins.bronze_chains(t.region))


def _in(values):
    return ", ".join("'" + v + "'" for v in values)


_AREAS = silver.FIXTURE_AREAS
_LOCS = silver.FIXTURE_LOCALITIES
_GROUP_CASE = "CASE " + " ".join(
    f"WHEN lower(trim(s.sucursales_barrio)) = '{a}' THEN '{a}'" for a in reversed(_AREAS)) + " ELSE 'caba' END"

SILVER_SQL = with_(BRONZE_PRODUCTS, BRONZE_STORES, BRONZE_CHAINS, f"""
chains AS (SELECT id_comercio, min(cadena) AS cadena FROM bronze_chains GROUP BY id_comercio)""", f"""
st AS (
  SELECT s.id_sucursal, s.id_comercio, s.sucursales_barrio, s.sucursales_calle, s.sucursales_numero,
         s.sucursal_nombre, c.cadena, {_GROUP_CASE} AS barrio_group
  FROM bronze_stores s JOIN chains c ON s.id_comercio = c.id_comercio
  WHERE lower(trim(s.sucursales_barrio)) IN ({_in(_AREAS)})
     OR lower(trim(s.sucursales_localidad)) IN ({_in(_LOCS)}))""", """
counts AS (
  SELECT id_sucursal, id_comercio, week_date, count(id_producto) AS product_count
  FROM bronze_products GROUP BY id_sucursal, id_comercio, week_date)""", """
ranked AS (
  SELECT st.*, k.week_date, k.product_count,
         row_number() OVER (PARTITION BY st.id_comercio, st.barrio_group, k.week_date
                            ORDER BY k.product_count DESC, st.id_sucursal ASC) AS rk
  FROM st JOIN counts k ON st.id_sucursal = k.id_sucursal AND st.id_comercio = k.id_comercio)""") + """
SELECT * FROM (
  SELECT CAST(try_strptime(p.week_date, '%Y-%m-%d') AS DATE) AS week_date, p.id_producto, p.id_comercio,
         p.productos_descripcion AS producto, p.presentacion, b.cadena, b.sucursal_nombre,
         b.sucursales_barrio, concat_ws(' ', b.sucursales_calle, b.sucursales_numero) AS sucursales_direccion,
         try_cast(replace(p.productos_precio_lista, ',', '.') AS DOUBLE) AS precio
  FROM bronze_products p
  JOIN ranked b ON p.id_sucursal = b.id_sucursal AND p.id_comercio = b.id_comercio
               AND p.week_date = b.week_date AND b.rk = 1)
WHERE precio IS NOT NULL AND precio > 0
"""


def silver_best_store(t):
    """PIP-1 flagship: representative store per chain × area group × week, typed prices."""
    p, s, c = _bronze(t)
    return silver.silver_prices(p, s, c, _AREAS, _LOCS)


register("silver_best_store", SILVER_SQL, "PIP-1 WIN-1 JN-1 JN-2 AGG-1 PRJ-3 PRJ-6 SCA-4 PRJ-10")(
    silver_best_store)


@register("dq_expectations", with_(BRONZE_PRODUCTS) + """
SELECT count(*) AS "rows",
       count(*) FILTER (WHERE NOT coalesce(try_cast(replace(productos_precio_lista, ',', '.') AS DOUBLE) > 0, false))
         AS fail_valid_price,
       count(*) FILTER (WHERE productos_descripcion IS NULL) AS fail_valid_product_name,
       count(*) FILTER (WHERE try_strptime(week_date, '%Y-%m-%d') IS NULL) AS fail_valid_week_date
FROM bronze_products""", ids="PRJ-9")
def dq_expectations(t):
    p, _, _ = _bronze(t)
    return silver.expectation_counts(p)


# Named chains for the local view: regions double as chain names in the stand-in.
LOCAL_CHAINS = ["ASIA", "EUROPE", "AMERICA", "AFRICA"]
LOCAL_AREAS = ["nation_0", "nation_1", "nation_2", "nation_3", "nation_4"]


@register("silver_latest_local", with_(BRONZE_PRODUCTS, BRONZE_STORES, BRONZE_CHAINS, f"""
chains AS (SELECT id_comercio, min(cadena) AS cadena FROM bronze_chains GROUP BY id_comercio
           HAVING lower(trim(min(cadena))) IN ({_in([c.lower() for c in LOCAL_CHAINS])}))""", f"""
st AS (SELECT s.id_sucursal, s.id_comercio, c.cadena, s.sucursal_nombre, s.sucursales_barrio
       FROM bronze_stores s JOIN chains c ON s.id_comercio = c.id_comercio
       WHERE lower(trim(s.sucursales_barrio)) IN ({_in(LOCAL_AREAS)}))""", """
feed AS (SELECT week_date, id_sucursal, id_comercio, id_producto, productos_descripcion AS producto,
                try_cast(replace(productos_precio_lista, ',', '.') AS DOUBLE) AS precio
         FROM bronze_products WHERE week_date = (SELECT max(week_date) FROM bronze_products))""") + """
SELECT CAST(try_strptime(week_date, '%Y-%m-%d') AS DATE) AS week_date, id_producto, producto, id_comercio,
       cadena, sucursales_barrio, sucursal_nombre, precio
FROM (SELECT f.*, st.cadena, st.sucursal_nombre, st.sucursales_barrio,
             row_number() OVER (PARTITION BY f.id_producto, f.id_comercio, st.sucursales_barrio
                                ORDER BY st.sucursal_nombre ASC, f.precio ASC NULLS LAST) AS rn
      FROM feed f JOIN st ON f.id_sucursal = st.id_sucursal AND f.id_comercio = st.id_comercio
      WHERE f.precio IS NOT NULL AND f.precio > 0)
WHERE rn = 1
""", ids="PIP-2 SRC-3 WIN-3 JN-7")
def silver_latest_local(t):
    p, s, c = _bronze(t)
    return silver.latest_local_prices(p, s, c, LOCAL_AREAS, LOCAL_CHAINS)

