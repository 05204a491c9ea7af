"""DuckDB-side stand-in CTEs, the SQL twins of ``gondola.sources.standins`` (oracle only)."""

BRONZE_PRODUCTS = """
bronze_products AS (
  SELECT strftime(date_trunc('week', l.l_shipdate), '%Y-%m-%d') AS week_date,
         CAST(l.l_suppkey % 5 AS VARCHAR) AS id_comercio,
         CAST(l.l_suppkey AS VARCHAR) AS id_sucursal,
         '779' || lpad(CAST(l.l_partkey AS VARCHAR), 10, '0') AS id_producto,
         p.p_name AS productos_descripcion,
         CAST(p.p_size AS VARCHAR) || ' un' AS presentacion,
         CASE WHEN l.l_orderkey % 11 = 0 AND (c.cents // 100) >= 1000
              THEN CAST((c.cents // 100) // 1000 AS VARCHAR) || '.' ||
                   lpad(CAST((c.cents // 100) % 1000 AS VARCHAR), 3, '0')
              ELSE CAST(c.cents // 100 AS VARCHAR) END
           || ',' || lpad(CAST(c.cents % 100 AS VARCHAR), 2, '0') AS productos_precio_lista
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  CROSS JOIN LATERAL (SELECT CAST(round(l.l_extendedprice * 100) AS BIGINT)
                             // CAST(l.l_quantity AS BIGINT) AS cents) c
)"""

BRONZE_STORES = """
bronze_stores AS (
  SELECT CAST(s.s_suppkey AS VARCHAR) AS id_sucursal,
         CAST(s.s_suppkey % 5 AS VARCHAR) AS id_comercio,
         n.n_name AS sucursales_barrio,
         r.r_name AS sucursales_localidad,
         'calle ' || CAST(s.s_nationkey AS VARCHAR) AS sucursales_calle,
         CAST(s.s_suppkey AS VARCHAR) AS sucursales_numero,
         s.s_name AS sucursal_nombre
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

BRONZE_CHAINS = """
bronze_chains AS (
  SELECT CAST(r_regionkey AS VARCHAR) AS id_comercio, r_name AS cadena FROM region
)"""

CATALOG_PRODUCTS = """
catalog_products AS (
  SELECT '779' || lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS id_producto, p_name AS producto
  FROM part
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
