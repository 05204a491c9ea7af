"""Receipt text -> purchase rows (PIP-36 … PIP-42, PIP-47, PIP-48, WIN-6/7/8, JN-10/12/13).

Receipts are small ordered groups of lines. Every neighbour access is a window partitioned by the
file and ordered by position (``lead``, bounded ``rowsBetween``) — the reference's positional
self-joins (``pos + 1``, ``pos + 2``) become one sort per file, no join. Prices are parsed from
decimal-comma text; sums of money are taken in integer cents so totals are exact.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gondola.operators.scan import running

PRICE_RE = r"(-?[0-9]+[,.][0-9]{2})"
CODE10_RE = r"(^|[^0-9])([0-9]{10})([^0-9]|$)"    # pin D13: digit boundaries
CODE13_RE = r"(^|[^0-9])([0-9]{13,14})([^0-9]|$)"


def money(text: Column) -> Column:
    return F.expr("try_cast(replace({0}, ',', '.') as double)".format(text._jc.toString()))


def cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


def _file_window(file_col: str = "file") -> Window:
    return Window.partitionBy(file_col).orderBy("pos")


def items_from_lines(lines: DataFrame, catalog: DataFrame | None = None, file_col: str = "file",
                     lookahead: int = 3) -> DataFrame:
    """PIP-38 + PIP-39 + PIP-40: item lines -> (name, codes, price, discount, base, source).

    * item = a line holding a 10-digit and a 13/14-digit run (D13 boundaries); name = text before
      the first digit; extracted price = the last price on the line (SCA-6, SCA-22);
    * next-line context via ``lead`` (WIN-8); a next line with OFF/PROMO carries the discount;
    * price cascade (WIN-7): extracted -> first non-promo price within the next ``lookahead`` lines
      -> catalog price by barcode with leading zeros stripped (JN-12); the winner is recorded;
    * base = paid + discount (pin D26).
    """
    w = _file_window(file_col)
    t = F.col("line_text")
    prices = F.regexp_extract_all(t, F.lit(PRICE_RE), 1)
    promo = F.coalesce(t.like("%OFF%") | t.like("%PROMO%"), F.lit(False))
    ctx = (lines
           .withColumn("_prices", prices).withColumn("_promo", promo)
           .withColumn("next_line_1", F.lead("line_text", 1).over(w))
           .withColumn("next_line_2", F.lead("line_text", 2).over(w))
           .withColumn("_ahead", F.first(F.when(~F.col("_promo") & (F.size("_prices") > 0),
                                                F.try_element_at("_prices", F.lit(1))), ignorenulls=True)
                       .over(w.rowsBetween(1, lookahead))))
    items = ctx.filter(t.rlike(CODE10_RE) & t.rlike(CODE13_RE))
    n1 = F.col("next_line_1")
    next_promo = F.coalesce(n1.like("%OFF%") | n1.like("%PROMO%"), F.lit(False))
    items = items.select(
        file_col, "pos",
        F.trim(F.regexp_extract(t, r"^([^0-9]*)", 1)).alias("producto"),
        F.nullif(F.regexp_extract(t, CODE10_RE, 2), F.lit("")).alias("product_id"),   # pin D12
        F.nullif(F.regexp_extract(t, CODE13_RE, 2), F.lit("")).alias("barcode"),
        money(F.try_element_at("_prices", F.lit(-1))).alias("_extracted"),
        money(F.col("_ahead")).alias("_ahead"),
        next_promo.alias("next_line_is_promo"),
        F.when(next_promo, money(F.regexp_extract(n1, r"-([0-9]+[,.][0-9]{2})", 1))).alias("_disc"))
    if catalog is not None:
        # a price table lists a product per store and week: one row per code, with its mean price
        cat = (catalog.groupBy(F.regexp_replace("id_producto", "^0+", "").alias("_k"))
               .agg(F.avg("precio").alias("_catalog")))
        items = (items.withColumn("_k", F.regexp_replace("barcode", "^0+", ""))
                 .join(cat, "_k", "left").drop("_k"))
    else:
        items = items.withColumn("_catalog", F.lit(None).cast("double"))
    paid = F.coalesce("_extracted", "_ahead", "_catalog")
    source = (F.when(F.col("_extracted").isNotNull(), "extracted").when(F.col("_ahead").isNotNull(), "lookahead")
              .when(F.col("_catalog").isNotNull(), "catalog"))
    disc = F.coalesce(F.col("_disc"), F.lit(0.0))
    return items.select(file_col, "pos", "producto", "product_id", "barcode", "next_line_is_promo",
                        paid.alias("precio_pagado"), disc.alias("descuento"), (paid + disc).alias("precio_base"),
                        source.alias("price_source"))


def ticket_dates(lines: DataFrame, file_col: str = "file") -> DataFrame:
    """Header field: the date of a ticket from its ``FECHA yyyy-mm-dd`` line (shape-guarded)."""
    d = F.expr("try_to_date(regexp_extract(line_text, 'FECHA ([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), 'yyyy-MM-dd')")
    return lines.groupBy(file_col).agg(F.max(d).alias("fecha"))


def load_purchases(items: DataFrame, dates: DataFrame, catalog: DataFrame, file_col: str = "file",
                   default_confidence: float = 0.90) -> DataFrame:
    """PIP-42: ticket id = md5(file) (SCA-10), date from the header, left match on barcode to the
    catalog (JN-3), default confidence; rows without name or price are gated out (PRJ-13)."""
    # one row per code, or a catalog that repeats codes would repeat purchases
    cat = catalog.select(F.col("id_producto").alias("barcode"), F.col("id_producto").alias("id_producto")).distinct()
    return (items.join(dates, file_col, "left").join(cat, "barcode", "left")
            .filter(F.col("producto").isNotNull() & (F.col("producto") != "") & F.col("precio_pagado").isNotNull())
            .select(F.md5(F.col(file_col)).alias("ticket_id"), "fecha", "id_producto", "producto",
                    "precio_pagado", "precio_base", "descuento", F.col("barcode").alias("barcode_ean13"),
                    F.col(file_col).alias("source_file"), F.lit(default_confidence).alias("confidence")))


def load_parsed_purchases(items: DataFrame, catalog: DataFrame, store_col: str = "comercio", id_col: str = "ticket_id",
                          default_confidence: str = "0.90") -> DataFrame:
    """PIP-42, parsed answers: purchases with quantity, unit, unit price and store. The date is text yyyy-mm-dd (else
    null), money is DECIMAL(12,2) and the confidence DECIMAL(3,2) (SCA-19), a missing one the default; the barcode
    matches the catalog from the left, each code once. Rows without name or price are gated out."""
    money_type, n = "decimal(12,2)", F.count(F.lit(1))
    codes = catalog.filter(F.col("id_producto").isNotNull()).groupBy(F.col("id_producto").alias("barcode")).agg(
        n.alias("_n")).select("barcode", F.col("barcode").alias("id_producto"))
    given = F.col("confidence") if "confidence" in items.columns else F.lit(None)
    paid = F.col("precio_final").cast(money_type)
    disc = F.coalesce(F.col("descuento"), F.lit(0.0)).cast(money_type)
    return (items.join(codes, "barcode", "left")
            .filter((F.coalesce(F.col("producto"), F.lit("")) != "") & F.col("precio_final").isNotNull())
            .select(id_col, F.expr("try_to_date(fecha, 'yyyy-MM-dd')").alias("fecha"), "id_producto", "producto",
                    F.col("cantidad").cast("decimal(12,3)").alias("cantidad"), "unidad",
                    F.col("precio_unitario").cast(money_type).alias("precio_unitario"), paid.alias("precio_pagado"),
                    (paid + disc).cast(money_type).alias("precio_base"), disc.alias("descuento"),
                    F.col("barcode").alias("barcode_ean13"), F.col(store_col).alias("id_comercio"),
                    F.coalesce(given.cast("decimal(3,2)"), F.lit(default_confidence).cast("decimal(3,2)")).alias("confidence")))


def ticket_summary(purchases: DataFrame) -> DataFrame:
    """PIP-47: per date × ticket × file — items, total paid, saved, saved % (safe ratio, AGG-21),
    matched items. Money sums in integer cents; the percentage is rounded at the integer step."""
    g = purchases.groupBy("fecha", "ticket_id", "source_file").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum(cents(F.col("precio_pagado"))).alias("_paid"),
        F.sum(cents(F.col("descuento"))).alias("_saved"),
        F.count("id_producto").alias("matched"))
    pct = F.round(F.col("_saved") * 10000.0 / F.nullif(F.col("_paid") + F.col("_saved"), F.lit(0))) / 100.0
    return g.select("fecha", "ticket_id", "source_file", "items", (F.col("_paid") / 100.0).alias("total_pagado"),
                    (F.col("_saved") / 100.0).alias("ahorro"), pct.alias("ahorro_pct"), "matched")


def weight_fix(items: DataFrame, unit_threshold: float = 20000.0) -> DataFrame:
    """PIP-41: for by-weight items whose price looks like a unit price (> threshold), paid =
    round(weight × unit price, 2); then base = paid + discount; confidence 0.85 when fixed else 0.95.
    Rounding is done on the integer-cent scale (same result in every engine)."""
    fix = F.col("is_weight") & (F.col("precio") > unit_threshold)
    paid = F.when(fix, F.round(F.col("cantidad") * F.col("precio") * 100) / 100.0).otherwise(F.col("precio"))
    return items.select("*", paid.alias("precio_pagado"), fix.alias("weight_fixed"),
                        F.when(fix, 0.85).otherwise(0.95).alias("confidence")) \
        .withColumn("precio_base", F.col("precio_pagado") + F.col("descuento"))


def group_ocr_fragments(frags: DataFrame, doc_col: str, y_col: str, text_col: str, conf_col: str,
                        gap: float = 20.0) -> DataFrame:
    """PIP-48 / WIN-6: y-sorted fragments -> lines. A new line starts where the y gap to the
    previous fragment exceeds ``gap``; then joined text (in y order) and mean confidence per line.
    Gaps and line numbers are scanned over ranges of (document, y), so a document that holds most fragments is
    spread over tasks; only one line's fragments are gathered."""
    seen = running(frags, [doc_col], [y_col, text_col], previous={"_y": y_col})
    seen = seen.withColumn("_new", F.when(F.col(y_col) - F.col("_y") > gap, 1).otherwise(0))
    lines = running(seen, [doc_col], [y_col, text_col], sums={"line_no": F.col("_new")}).withColumn("line_no", F.col("line_no").cast("int"))
    return (lines.groupBy(doc_col, "line_no")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(y_col, text_col))),
                                          lambda s: s[text_col]), " ").alias("text"),
                 F.avg(conf_col).alias("confidence"), F.count(F.lit(1)).alias("fragments")))


NON_ITEM_WORDS = ("SUBTOTAL", "TOTAL", "PROMO", "CANT", "TICKET", "FECHA")


def price_only_items(lines: DataFrame, file_col: str = "file", non_items=NON_ITEM_WORDS) -> DataFrame:
    """Second extractor (PIP-46): any line that starts with an upper-case name and ends with a price,
    whatever codes it holds; header/total/promo words are not items."""
    t = F.col("line_text")
    name = F.trim(F.regexp_extract(t, r"^([A-Z][A-Z ]*[A-Z])", 1))
    first = F.regexp_extract(t, r"^([A-Z]+)", 1)
    price = money(F.try_element_at(F.regexp_extract_all(t, F.lit(PRICE_RE), 1), F.lit(-1)))
    return (lines.filter(t.rlike(r"[0-9]+[,.][0-9]{2}$") & (name != "") & ~first.isin(list(non_items)))
            .select(file_col, "pos", name.alias("producto"), price.alias("precio")))


def combine_strategies(by_ids: DataFrame, by_price: DataFrame, file_col: str = "file") -> DataFrame:
    """PIP-46 / SET-2 / AGG-6 / AGG-11: union of two extractors on (file, name, price) — distinct —
    then per file: found by both, only by codes, only by price, union size, first item name."""
    a = by_ids.select(file_col, "pos", "producto", F.col("precio_pagado").alias("precio"),
                      F.lit(True).alias("_a"), F.lit(False).alias("_b"))
    b = by_price.select(file_col, "pos", "producto", "precio", F.lit(False).alias("_a"), F.lit(True).alias("_b"))
    u = (a.unionByName(b).groupBy(file_col, "producto", "precio")
         .agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"), F.min("pos").alias("pos")))
    return u.groupBy(file_col).agg(
        F.count_if(F.col("_a") & F.col("_b")).alias("both"),
        F.count_if(F.col("_a") & ~F.col("_b")).alias("ids_only"),
        F.count_if(~F.col("_a") & F.col("_b")).alias("price_only"),
        F.count(F.lit(1)).alias("union_items"),
        F.min_by("producto", "pos").alias("first_item"))


def match_context(lines: DataFrame, pattern: str, before: int = 1, after: int = 2,
                  file_col: str = "file") -> DataFrame:
    """WIN-10: lines from ``before`` lines ahead of to ``after`` lines past any matching line,
    labelled match / context — a bounded window per file, no self-join."""
    w = Window.partitionBy(file_col).orderBy("pos").rowsBetween(-after, before)
    flag = F.col("line_text").like(pattern).cast("int")
    return (lines.withColumn("_m", flag).withColumn("_near", F.max("_m").over(w))
            .filter(F.col("_near") == 1)
            .select(file_col, "pos", "line_text",
                    F.when(F.col("_m") == 1, "match").otherwise("context").alias("label")))


def attach_discounts_by_code(items: DataFrame, discount_lines: DataFrame, file_col: str = "file") -> DataFrame:
    """PIP-39 / JN-13: discount lines that carry an item's internal 10-digit code. Discounts are
    summed per (file, code) *before* the join (pin D11), so a repeated code never fans out; the
    discount is the negated negative amount and base = paid + discount."""
    t = F.col("line_text")
    d = (discount_lines
         .select(file_col, F.nullif(F.regexp_extract(t, CODE10_RE, 2), F.lit("")).alias("product_id"),
                 money(F.regexp_extract(t, r"-([0-9]+[,.][0-9]{2})", 1)).alias("_d"))
         .filter(F.col("product_id").isNotNull() & F.col("_d").isNotNull())
         .groupBy(file_col, "product_id").agg(F.sum(cents(F.col("_d"))).alias("_dc")))
    return (items.join(d, [file_col, "product_id"], "left")
            .withColumn("descuento", F.coalesce(F.col("_dc") / 100.0, F.lit(0.0)))
            .withColumn("precio_base", F.col("precio_pagado") + F.col("descuento"))
            .drop("_dc"))


PROFILE_GROUPS = 4096   # element types a task holds before it hands its partial profiles on
PROFILE_SALTS = 256     # partial profiles of one type meet in this many groups first


def element_profile(elements: DataFrame, type_col: str, content_col: str, samples: int = 5,
                    width: int = 100) -> DataFrame:
    """AGG-23 / PIP-36: per element type its number, characters in all, longest content and the ``samples``
    smallest distinct contents (first ``width`` characters), in one scan.

    The state is bounded as it is built: a task keeps ``samples`` strings a type (Arrow batches, only the cut
    contents and their lengths travel), partial profiles merge by salt and then by type, so a type that holds
    most rows never has its contents in one place. A null type is a type of its own; a null content counts as an
    element without characters or sample. Equal contents are one sample; an empty table gives no rows.
    """
    cut = elements.select(F.col(type_col).cast("string").alias("kind"),
                          F.substring(F.col(content_col), 1, width).alias("sample"),
                          F.coalesce(F.length(content_col), F.lit(0)).cast("long").alias("chars"))

    def partial(batches):
        state = {}

        def flush():
            keys = list(state)
            held = [state[key] for key in keys]
            state.clear()
            return pa.RecordBatch.from_pydict({
                "kind": pa.array(keys, pa.string()), "n": pa.array([h[0] for h in held], pa.int64()),
                "chars": pa.array([h[1] for h in held], pa.int64()), "longest": pa.array([h[2] for h in held], pa.int64()),
                "samples": pa.array([h[3] for h in held], pa.list_(pa.string()))})

        for batch in batches:
            table = pa.Table.from_batches([batch])
            sums = table.group_by("kind").aggregate([([], "count_all"), ("chars", "sum"), ("chars", "max")])
            for kind, n, chars, longest in zip(*(sums.column(c).to_pylist()
                                                 for c in ("kind", "count_all", "chars_sum", "chars_max"))):
                old = state.get(kind, (0, 0, 0, []))
                state[kind] = (old[0] + n, old[1] + chars, max(old[2], longest), old[3])
            given = table.filter(pc.is_valid(table.column("sample"))).group_by(["kind", "sample"]).aggregate([])
            given = given.sort_by([("kind", "ascending"), ("sample", "ascending")])
            taken = {}
            for kind, sample in zip(given.column("kind").to_pylist(), given.column("sample").to_pylist()):
                new = taken.setdefault(kind, [])
                if len(new) < samples:
                    new.append(sample)
            for kind, new in taken.items():
                n, chars, longest, old = state[kind]
                merged = sorted(set(old) | set(new), key=lambda v: v.encode())
                state[kind] = (n, chars, longest, merged[:samples])
            if len(state) > PROFILE_GROUPS:
                yield flush()
        if state:
            yield flush()

    def merge(df: DataFrame, *keys: str) -> DataFrame:
        least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("samples")))), 1, samples)
        return df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("chars").alias("chars"),
                                     F.max("longest").alias("longest"), least.alias("samples"))

    parts = cut.mapInArrow(partial, "kind string, n long, chars long, longest long, samples array<string>")
    salted = parts.withColumn("_salt", F.spark_partition_id() % PROFILE_SALTS)
    return merge(merge(salted, "kind", "_salt"), "kind").withColumnRenamed("kind", type_col)


def full_texts(elements: DataFrame, file_col: str, pos_col: str, type_col: str, content_col: str,
               kind: str = "text") -> DataFrame:
    """PIP-36: per file the contents of the elements of type ``kind`` in page order, one a line, with the length
    and the number of elements. Null contents are left out of the text but counted; equal positions go by content."""
    piece = F.struct(F.col(pos_col).alias("p"), F.col(content_col).alias("c"))
    return (elements.filter(F.col(type_col) == kind).groupBy(file_col)
            .agg(F.count(F.lit(1)).alias("elements"), F.array_sort(F.collect_list(piece)).alias("_e"))
            .select(file_col, "elements", F.array_join(F.transform("_e", lambda e: e["c"]), "\n").alias("full_text"))
            .withColumn("text_length", F.length("full_text").cast("long")))
