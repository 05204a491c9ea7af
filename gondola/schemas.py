"""Table schemas (§1.5, canonical English names) and seed data kept as data.

Seeds are tiny, fixed-size tables (taxonomy, rules); they are built with explicit schemas — never
inferred — and are the only inputs the operators broadcast without a runtime size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

PRODUCT_CATEGORY = T.StructType([
    T.StructField("id_producto", T.StringType()),
    T.StructField("id_categoria", T.LongType()),
    T.StructField("id_subcategoria", T.LongType()),
    T.StructField("metodo", T.StringType()),
    T.StructField("confianza", T.DoubleType()),
])

CATEGORIES = T.StructType([
    T.StructField("id_categoria", T.LongType()),
    T.StructField("nombre", T.StringType()),
    T.StructField("nivel", T.IntegerType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("id_macro", T.IntegerType()),
])

MACROS = T.StructType([
    T.StructField("id_macro", T.IntegerType()),
    T.StructField("nombre", T.StringType()),
])

STAGING = T.StructType(PRODUCT_CATEGORY.fields + [
    T.StructField("run_id", T.StringType()),
    T.StructField("iteration", T.IntegerType()),
])

ITERATION_METRICS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("iteration", T.IntegerType()),
    T.StructField("batch_size", T.LongType()),
    T.StructField("auto_assigned", T.LongType()),
    T.StructField("review_queue", T.LongType()),
    T.StructField("threshold", T.DoubleType()),
])

# ---------------------------------------------------------------------------------------------
# Stand-in taxonomy for the fixture catalog (part names = adjective + noun). Own seed data.
MACRO_ROWS = [(1, "hardware"), (2, "machinery"), (3, "misc")]

CATEGORY_ROWS = [
    # id, name, level, parent, macro
    (1, "bolts", 1, None, 1),
    (2, "rods", 1, None, 1),
    (3, "rings", 1, None, 1),
    (4, "gears", 1, None, 2),
    (5, "gizmos", 1, None, 2),
    (6, "anvils", 1, None, 2),
    (7, "plates", 1, None, 3),
    (8, "widgets", 1, None, 3),
    (9, "otros", 1, None, 3),
    (10, "fasteners", 1, None, 1),     # duplicate of bolts, merged by taxonomy normalisation
    (11, "_OLD_gears", 1, None, 2),    # deprecated, excluded from centroids and listings
    (41, "hot gears", 2, 4, 2),
    (42, "cold gears", 2, 4, 2),
    (43, "large gears", 2, 4, 2),
    (51, "coloured gizmos", 2, 5, 2),
    (52, "small gizmos", 2, 5, 2),
    (21, "old rods", 2, 2, 1),
    (22, "new rods", 2, 2, 1),
    (31, "red rings", 2, 3, 1),
    (32, "blue rings", 2, 3, 1),
]

# Keyword rules, in rule order: (category id, keywords). Substring test on the lower-cased name.
KEYWORD_RULES = [
    (1, ["bolt"]),
    (2, ["rod", "hot rod", " rod"]),
    (3, ["ring", "red ring"]),
    (4, ["gear", "cog"]),
    (5, ["gizmo", "gadget"]),
    (6, ["anvil"]),
]

# n-gram pattern rules (fill-only): (pattern, category id, method). First pattern in order wins.
PATTERN_RULES = [
    ("blue plate", 7, "llm_discovery"),
    ("plate", 7, "regla"),
    ("new widget", 8, "llm_discovery"),
    ("old widget", 8, "regla"),
    ("small widget", 8, "regla"),
]

# Sub-category reassignment rules: (parent id, pattern, target sub id, rule order, excluded words).
SUBCATEGORY_RULES = [
    (4, "hot gear", 41, 1, []),
    (4, "cold gear", 42, 2, []),
    (4, "large", 43, 3, ["blue"]),
    (5, "blue", 51, 1, []),
    (5, "red", 51, 2, []),
    (5, "small", 52, 3, []),
    (2, "old", 21, 1, ["cold"]),
    (2, "new", 22, 2, []),
    (3, "red", 31, 1, []),
    (3, "blue", 32, 2, []),
]

# Correction rules applied in order: (from category, LIKE patterns, target category or None).
CORRECTION_RULES = [
    (4, ["%cold%gear%"], 6),          # move
    (6, ["%small%", "%new%"], None),  # null-out
    (1, ["%red%"], 3),
    (3, ["%red ring%"], 2),           # sees the rows moved by the previous rule
]

# Taxonomy normalisation: duplicate merges (old -> kept) and renames.
CATEGORY_REMAP = [(10, 1), (11, 4)]
CATEGORY_RENAMES = [(9, "other"), (5, "gizmos and gadgets")]

CATCH_ALL = "otros"


def seed_df(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def categories_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, CATEGORY_ROWS, CATEGORIES)


def macros_df(spark: SparkSession) -> DataFrame:
    return seed_df(spark, MACRO_ROWS, MACROS)
