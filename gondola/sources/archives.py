"""Nested archive expansion and CSV landing (SRC-5, SRC-6, PIP-56, SNK-10).

Archives arrive as files read with the ``binaryFile`` source (one row per archive: path, content).
An outer ZIP holds inner ZIPs whose names carry a ``YYYY-MM-DD`` date; each inner ZIP holds the
feed CSVs. Expansion is a ``mapInPandas`` over archive rows (byte-level work Spark has no built-in
for), yielding one row per CSV line; a member is decoded as a stream, CHUNK_LINES lines at a time. Landing
is plain Spark: header line dropped (the first header defines the columns), body lines parsed with
``from_csv`` into all-string columns and written per date with the CSV writer.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_RE = re.compile(r"(\d{4}-\d{2}-\d{2})")
TARGETS = ("productos", "sucursales", "comercio")
#: Lines of a member that are held at once.
CHUNK_LINES = 50_000
LINES_SCHEMA = "archive string, week_date string, kind string, member_no int, line_no int, line string"


def read_archives(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-5: binary file scan (path, modificationTime, length, content)."""
    return spark.read.format("binaryFile").load(glob)


def _expand(batches: Iterator[pd.DataFrame], targets: Sequence[str]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(bytes(content))) as outer:
                for inner_no, inner_name in enumerate(sorted(outer.namelist())):
                    m = DATE_RE.search(inner_name)
                    if not (m and inner_name.lower().endswith(".zip")):
                        continue
                    with zipfile.ZipFile(io.BytesIO(outer.read(inner_name))) as inner:
                        for member in sorted(inner.namelist()):
                            kind = member.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower()
                            if kind not in targets:
                                continue
                            with inner.open(member) as raw:
                                text = io.TextIOWrapper(raw, encoding="utf-8-sig")     # BOM stripped
                                at = 0
                                while lines := [x.rstrip("\n") for x in islice(text, CHUNK_LINES)]:
                                    yield pd.DataFrame({
                                        "archive": path, "week_date": m.group(1), "kind": kind,
                                        "member_no": inner_no, "line_no": range(at, at + len(lines)), "line": lines})
                                    at += len(lines)


def expand_archives(archives: DataFrame, targets: Sequence[str] = TARGETS) -> DataFrame:
    """SRC-6: (path, content) archive rows -> one row per CSV line with its date and kind."""
    return archives.select("path", "content").mapInPandas(lambda it: _expand(it, targets), LINES_SCHEMA)


def land_lines(lines: DataFrame, kind: str, columns: Sequence[str], root: str, sep: str = "|") -> DataFrame:
    """PIP-56 / SNK-10: body lines of one kind -> all-string columns -> CSV per date under
    ``root/<kind>``. Header lines (line 0 of each member) are dropped; the declared ``columns`` are
    the first header's names. Returns the parsed rows (lazy)."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    rows = (lines.filter((F.col("kind") == kind) & (F.col("line_no") > 0) & (F.length("line") > 0))
            .select("week_date", F.from_csv(F.col("line"), schema, {"sep": sep}).alias("r"))
            .select("week_date", "r.*"))
    (rows.write.mode("append").partitionBy("week_date").option("sep", sep).option("header", True)
     .csv(f"{root.rstrip('/')}/{kind}"))
    return rows


def build_zip(members: dict[str, bytes]) -> bytes:
    """ZIP bytes with the given members (used to build inner and outer archives)."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members):
            z.writestr(name, members[name])
    return buf.getvalue()
