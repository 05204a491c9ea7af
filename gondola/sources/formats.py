"""Semi-structured inputs: JSON text, VARIANT documents, HTML links, parse status, e-mail shape
(SRC-7, SRC-9, SCA-24, SCA-25, SCA-30, PIP-37, PIP-57). Built-in functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gondola.functions.text import email_ok

# an href in any letter case, its value with either kind of quotes
HREF_RE = r"""(?i)href\s*=\s*("[^"]*"|'[^']*')"""

# Receipt answer schema (A7): header fields + items.
RECEIPT_SCHEMA = ("struct<fecha:string,comercio:string,productos:array<struct<producto:string,cantidad:double,"
                  "unidad:string,precio_unitario:double,precio_final:double,descuento:double,barcode:string>>>")


def json_fields(df: DataFrame, json_col: str, schema: str) -> DataFrame:
    """SCA-24: typed struct from JSON text (malformed text -> NULL fields, never an error)."""
    return df.withColumn("_j", F.from_json(F.col(json_col), schema))


def receipt_items_from_json(answers: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """PIP-37: model answers ``{fecha, comercio, productos:[…]}`` -> one row per item (SRC-9)."""
    parsed = answers.select(id_col, F.from_json(F.col(json_col), RECEIPT_SCHEMA).alias("r"))
    return parsed.select(id_col, F.col("r.fecha").alias("fecha"), F.col("r.comercio").alias("comercio"),
                         F.posexplode("r.productos").alias("item_pos", "it")).select(
        id_col, "fecha", "comercio", F.col("item_pos").cast("int").alias("item_pos"), "it.*")


def variant_elements(docs: DataFrame, id_col: str, variant_col: str) -> DataFrame:
    """SCA-25 / PIP-36 first step: ``doc:document:elements`` of a VARIANT document -> (pos, type,
    content) rows, via ``variant_get``; elements of unexpected shape give NULLs, not errors."""
    els = F.expr(f"try_variant_get({variant_col}, '$.document.elements', 'array<variant>')")
    return (docs.select(id_col, F.posexplode(els).alias("pos", "el"))
            .select(id_col, F.col("pos").cast("int").alias("pos"),
                    F.expr("try_variant_get(el, '$.type', 'string')").alias("element_type"),
                    F.expr("try_variant_get(el, '$.content', 'string')").alias("content")))


def html_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """SRC-7 (list form): every ``href`` of a page in document order."""
    quoted = F.regexp_extract_all(F.col(html_col), F.lit(HREF_RE), 1)
    return (pages.select(id_col, F.posexplode(quoted).alias("link_pos", "href"))
            .select(id_col, F.col("link_pos").cast("int").alias("link_pos"),
                    F.expr("substring(href, 2, length(href) - 2)").alias("href")))


def block_links(pages: DataFrame, tag: str = "div", cls: str | None = "pkg-container", label: str | None = None,
                href_part: str = "/download/", id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """SRC-7 (block form): (id, block, heading, link) of the containers ``<tag class=cls>`` of each page.

    heading: the container's first text, or ``label`` where one of its trimmed texts equals it; containers
    without the label are left out when one is given. link: the first ``<a href>`` in it that holds
    ``href_part``; containers without such a link are left out. A text or link belongs to the innermost
    container around it. ``cls`` is one of the class names, None takes every ``tag``. block counts a page's
    containers from 0 in page order.

    A page becomes rows of tags and texts, shuffled by page once. The nesting depth of ``tag`` is a running sum
    over them; an open tag ends at the next event of its depth, whatever lies between. The depth among containers
    is a second running sum, and a text belongs to the last container opened at its depth: no join of texts with
    containers. An unclosed container reaches to the end of the page. Comments, scripts and styles are dropped
    first; pages without ``tag`` never leave the scan. References stay as written, a ``>`` inside an attribute ends
    its tag. Null or empty html gives no rows.
    """
    name = tag.lower()
    dull = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    pieces = F.regexp_extract_all(F.regexp_replace(F.col(html_col), dull, ""), F.lit(r"(?s)<[^>]*>|[^<]+"), 0)
    bare = F.lower(F.regexp_extract("piece", r"^<(/?[A-Za-z][A-Za-z0-9]*)", 1))
    classes = F.regexp_extract("piece", r"""(?is)\sclass\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", 1)
    quoted = F.regexp_extract("piece", HREF_RE.replace("href", r"\shref"), 1)
    opens = bare == name
    wanted = opens if cls is None else opens & F.array_contains(F.split(F.regexp_replace(classes, "[\"']", ""), r"\s+"), cls)
    text = F.trim(F.regexp_replace("piece", r"^\s+|\s+$", ""))
    events = (pages.filter(F.lower(html_col).contains("<" + name)).select(id_col, F.posexplode(pieces).alias("pos", "piece"))
              .select(id_col, "pos", F.when(opens, 1).when(bare == "/" + name, -1).otherwise(0).alias("step"),
                      wanted.alias("wanted"),
                      F.when(~F.col("piece").startswith("<"), F.nullif(text, F.lit(""))).alias("text"),
                      F.when((bare == "a") & (quoted != ""), F.substring(quoted, F.lit(2), F.length(quoted) - 2)).alias("href"))
              .filter((F.col("step") != 0) | F.col("text").isNotNull() | F.col("href").contains(href_part)))
    page = Window.partitionBy(id_col).orderBy("pos")
    running = page.rowsBetween(Window.unboundedPreceding, 0)
    # an open tag and the close that ends it have one level: the depth after the open, before the close
    level = F.sum("step").over(running) + F.when(F.col("step") < 0, 1).otherwise(0)
    events = events.withColumn("level", level).withColumn("is_tag", F.col("step") != 0)
    before = F.lag("wanted").over(Window.partitionBy(id_col, "level", "is_tag").orderBy("pos"))
    ended = (F.col("step") < 0) & F.coalesce(before, F.lit(False))
    events = (events.withColumn("depth", F.when(F.col("wanted"), 1).when(ended, -1).otherwise(0))
              .withColumn("depth", F.sum("depth").over(running))
              .withColumn("block", F.when(F.col("wanted"), F.sum(F.col("wanted").cast("int")).over(running) - 1)))
    last = F.last("block", ignorenulls=True).over(
        Window.partitionBy(id_col, "depth").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    inner = (events.withColumn("block", F.when(F.col("depth") > 0, last).cast("int"))
             .filter("not is_tag and block is not null").select(id_col, "block", "pos", "text", "href"))
    heading = F.min_by("text", F.when(F.col("text").isNotNull(), F.col("pos")))
    link = F.min_by("href", F.when(F.col("href").contains(href_part), F.col("pos")))
    if label is not None:
        heading = F.max(F.when(F.col("text") == label, F.col("text")))
    out = inner.groupBy(id_col, "block").agg(heading.alias("heading"), link.alias("link")).filter("link IS NOT NULL")
    return out if label is None else out.filter("heading IS NOT NULL")


def parse_status(docs: DataFrame, id_col: str, error_col: str) -> DataFrame:
    """PIP-57: OK / ERROR per document from its error status."""
    return docs.select(id_col, F.when(F.col(error_col).isNull(), "OK").otherwise("ERROR").alias("status"),
                       F.col(error_col).alias("error_status"))


def email_check(df: DataFrame, email_col: str) -> DataFrame:
    """SCA-30: validity flag (NULL -> false)."""
    return df.withColumn("is_valid", email_ok(email_col))


def first_by_order(df: DataFrame, key: str, order_col: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
