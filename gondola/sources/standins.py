"""Fixture stand-ins: the driver's TPC-H-like tables re-shaped into the price-feed data model.

Mapping (see FIXTURES.md part C):
  products feed  = lineitem ⋈ part   store = l_suppkey, product = l_partkey, week = week of l_shipdate,
                                      price text with a decimal comma
  stores         = supplier ⋈ nation ⋈ region   area = n_name, locality = region name of the nation
  chains         = region with r_regionkey = s_suppkey % 5 (a chain spans several areas)
  catalog names  = part.p_name

Every column of the bronze frames is a string, as in the raw feed; typing happens in silver.
All expressions are built-ins so the scans keep column pruning and whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_CHAINS = 5


def barcode_of(partkey: Column) -> Column:
    """13-digit product code: country prefix 779 + zero-padded part key (leading zeros matter)."""
    return F.concat(F.lit("779"), F.lpad(partkey.cast("string"), 10, "0"))


def unit_cents(extendedprice: str = "l_extendedprice", quantity: str = "l_quantity") -> Column:
    """Unit price in integer cents (exact in any engine, no float rounding ties)."""
    return F.expr(f"cast(round({extendedprice} * 100) as bigint) div cast({quantity} as bigint)")


def _price_text_expr(cents: Column, orderkey: Column) -> Column:
    """Unit price as feed text with a decimal comma.

    Every 11th order writes prices of 1000 or more with a '.' thousands separator, which the
    silver cast must reject (pin D2).
    """
    units = (cents / 100).cast("long")          # cents >= 0, so truncation == floor
    frac = F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.concat((units / 1000).cast("long").cast("string"), F.lit("."),
                       F.lpad((units % 1000).cast("string"), 3, "0"))
    body = F.when((orderkey % 11 == 0) & (units >= 1000), grouped).otherwise(units.cast("string"))
    return F.concat(body, F.lit(","), frac)


def bronze_products(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                         "l_shipdate")
    p = part.select("p_partkey", "p_name", "p_size")
    cents = unit_cents()
    return (li.join(p, li.l_partkey == p.p_partkey, "inner")
            .select(
                F.date_format(F.date_trunc("week", "l_shipdate"), "yyyy-MM-dd").alias("week_date"),
                (F.col("l_suppkey") % N_CHAINS).cast("string").alias("id_comercio"),
                F.col("l_suppkey").cast("string").alias("id_sucursal"),
                barcode_of(F.col("l_partkey")).alias("id_producto"),
                F.col("p_name").alias("productos_descripcion"),
                F.concat(F.col("p_size").cast("string"), F.lit(" un")).alias("presentacion"),
                _price_text_expr(cents, F.col("l_orderkey")).alias("productos_precio_lista"),
                F.lit(None).cast("string").alias("productos_precio_referencia"),
                F.lit(None).cast("string").alias("productos_cantidad_referencia"),
            ))


def bronze_stores(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    s = supplier.select("s_suppkey", "s_name", "s_nationkey")
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("loc"))
    # nation/region are fixed 25/5-row dimensions: safe broadcast
    dims = F.broadcast(n.join(F.broadcast(r), "n_regionkey"))
    return (s.join(dims, s.s_nationkey == dims.n_nationkey, "inner")
            .select(
                F.col("s_suppkey").cast("string").alias("id_sucursal"),
                (F.col("s_suppkey") % N_CHAINS).cast("string").alias("id_comercio"),
                F.col("n_name").alias("sucursales_barrio"),
                F.col("loc").alias("sucursales_localidad"),
                F.concat(F.lit("calle "), F.col("s_nationkey").cast("string")).alias("sucursales_calle"),
                F.col("s_suppkey").cast("string").alias("sucursales_numero"),
                F.col("s_name").alias("sucursal_nombre"),
            ))


def bronze_chains(region: DataFrame) -> DataFrame:
    return region.select(F.col("r_regionkey").cast("string").alias("id_comercio"),
                         F.col("r_name").alias("cadena"))


def catalog_products(part: DataFrame) -> DataFrame:
    """Distinct catalog names to classify: (id_producto, producto)."""
    return part.select(barcode_of(F.col("p_partkey")).alias("id_producto"),
                       F.col("p_name").alias("producto"))


def money_text(cents: Column) -> Column:
    """Non-negative integer cents -> '1234,56'."""
    return F.concat((cents / 100).cast("long").cast("string"), F.lit(","),
                    F.lpad((cents % 100).cast("string"), 2, "0"))


def noisy_barcode(true13: Column, orderkey: Column, linenumber: Column) -> Column:
    """OCR-style noise on purchase codes, fixed by row: r = (order + line) % 7; r = 0 one digit
    changed (4th digit -> 8), r = 3 leading 7 read as 0, r = 5 an extra leading 0 (14 digits)."""
    r = (orderkey + linenumber) % 7
    return (F.when(r == 0, F.concat(F.substring(true13, 1, 3), F.lit("8"), F.substring(true13, 5, 9)))
            .when(r == 3, F.concat(F.lit("0"), F.substring(true13, 2, 12)))
            .when(r == 5, F.concat(F.lit("0"), true13))
            .otherwise(true13))


def ticket_lines(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Receipt text lines (file, pos, line_text): per order a TICKET and a FECHA header, then two
    lines per item — ``NAME CODE10 BARCODE [TOTAL]`` and a second line with the total (when it is
    missing on the first), a ``PROMO OFF -discount`` line, or the quantity.

    Item order inside a ticket is a window over one order's lines (a bounded group)."""
    from pyspark.sql import Window

    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    p = part.select("p_partkey", "p_name")
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice")
    it = li.join(p, li.l_partkey == p.p_partkey).withColumn("k", F.row_number().over(w))
    code10 = F.lpad(F.col("l_partkey").cast("string"), 10, "0")
    noisy = noisy_barcode(F.concat(F.lit("779"), code10), F.col("l_orderkey"), F.col("l_linenumber"))
    tot = F.round(F.col("l_extendedprice") * 100).cast("long")
    disc = F.round(F.col("l_extendedprice") * F.col("l_discount") * 100).cast("long")
    l1 = F.concat_ws(" ", F.upper("p_name"), code10, noisy,
                     F.when(F.col("l_linenumber") % 4 != 2, money_text(tot)))
    l2 = (F.when(F.col("l_linenumber") % 4 == 2, F.concat(F.lit("SUBTOTAL "), money_text(tot)))
          .when(F.col("l_discount") >= 0.05, F.concat(F.lit("PROMO OFF -"), money_text(disc)))
          .otherwise(F.concat(F.lit("CANT "), F.col("l_quantity").cast("long").cast("string"), F.lit(" UN"))))
    fname = F.concat(F.lit("ticket_"), F.col("l_orderkey").cast("string"), F.lit(".jpg"))
    items = it.select(fname.alias("file"), F.inline(F.array(
        F.struct((F.col("k") * 2).cast("int").alias("pos"), l1.alias("line_text")),
        F.struct((F.col("k") * 2 + 1).cast("int").alias("pos"), l2.alias("line_text")))))
    oname = F.concat(F.lit("ticket_"), F.col("o_orderkey").cast("string"), F.lit(".jpg"))
    heads = orders.select(oname.alias("file"), F.inline(F.array(
        F.struct(F.lit(0).alias("pos"), F.concat(F.lit("TICKET "), F.col("o_orderkey").cast("string")).alias("line_text")),
        F.struct(F.lit(1).alias("pos"), F.concat(F.lit("FECHA "), F.date_format("o_orderdate", "yyyy-MM-dd"))
                 .alias("line_text")))))
    return heads.unionByName(items)


def catalog_prices(part: DataFrame) -> DataFrame:
    """Catalog stand-in for receipt matching: (id_producto, producto, precio)."""
    return part.select(barcode_of(F.col("p_partkey")).alias("id_producto"), F.col("p_name").alias("producto"),
                       F.col("p_retailprice").alias("precio"))
