"""Query keys joining silver prices with the catalog mapping: gold_enriched, price_comparison."""

from __future__ import annotations

from gondola import schemas as S
from gondola.operators import prices
from gondola.plans.catalog_q import CATEGORIES_SQL, GOLD_SQL, _full_mapping
from gondola.plans.registry import register
from gondola.plans.silver_q import SILVER_SQL, silver_best_store
from gondola.plans.sql_standins import CATALOG_PRODUCTS

COMPARE_CATEGORY = 4  # gears

_BASE = ("WITH silver AS (" + SILVER_SQL + "),\n" + ",\n".join(
    c.strip() for c in [CATALOG_PRODUCTS, *GOLD_SQL, CATEGORIES_SQL]) + """,
enriched AS (SELECT s.*, g.id_categoria, g.id_subcategoria, g.metodo, c.nombre AS categoria
             FROM silver s LEFT JOIN gold g ON s.id_producto = g.id_producto
             LEFT JOIN categories c ON g.id_categoria = c.id_categoria)
""")


def _enriched(t):
    return prices.enrich_prices(silver_best_store(t), _full_mapping(t), S.categories_df(t.spark))


@register("gold_enriched", _BASE + "SELECT * FROM enriched", ids="JN-20")
def gold_enriched(t):
    return _enriched(t)


@register("price_comparison", _BASE + f"""
SELECT week_date, cadena, id_producto, producto, count(*) AS n, min(precio) AS precio_min, max(precio) AS precio_max,
       sum(CAST(round(precio * 100) AS BIGINT)) / count(*) / 100.0 AS precio_promedio
FROM enriched WHERE id_categoria = {COMPARE_CATEGORY}
GROUP BY week_date, cadena, id_producto, producto""", ids="PIP-49 AGG-22 JN-20")
def price_comparison(t):
    return prices.price_comparison(_enriched(t), COMPARE_CATEGORY)
