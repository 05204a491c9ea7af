"""Archives read as files, expanded in chunks and landed; archives of bounded size."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from gondola.plans import archives_q
from gondola.sources import archives


@pytest.fixture
def folder(tmp_path):
    body = "id_comercio|comercio_bandera_nombre\n" + "".join(f"{i}|chain \x85{i}\n" for i in range(7))
    inner = archives.build_zip({"x/Comercio.csv": ("\ufeff" + body).encode(), "notes.txt": b"left out\n"})
    empty = archives.build_zip({"comercio.csv": b""})
    outer = archives.build_zip({"sepa_2024-05-06.zip": inner, "sepa_2024-05-13.zip": empty, "undated.zip": inner, "2024-05-20.txt": b"no archive"})
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "sepa_2024.zip").write_bytes(outer)
    return tmp_path


def test_archives_are_read_expanded_and_landed(spark, folder):
    lines = archives.expand_archives(archives.read_archives(spark, str(folder / "in" / "*.zip")))
    got = lines.orderBy("line_no").collect()
    assert [(r.week_date, r.kind, r.line_no) for r in got] == [("2024-05-06", "comercio", i) for i in range(8)]
    assert got[0].line == "id_comercio|comercio_bandera_nombre" and got[3].line == "2|chain \x852"
    rows = archives.land_lines(lines, "comercio", archives_q.COLUMNS["comercio"], str(folder / "out"))
    assert rows.count() == 7
    landed = spark.read.option("sep", "|").option("header", True).csv(str(folder / "out" / "comercio"))
    assert sorted(r.id_comercio for r in landed.collect()) == [str(i) for i in range(7)]


def test_a_member_is_cut_into_chunks(monkeypatch):
    import pandas as pd

    monkeypatch.setattr(archives, "CHUNK_LINES", 3)
    inner = archives.build_zip({"productos.csv": b"h\r\na\nb\n\nc\nd"})
    given = pd.DataFrame({"path": ["p"], "content": [archives.build_zip({"2024-01-01.zip": inner})]})
    parts = list(archives._expand(iter([given]), archives.TARGETS))
    assert [len(p) for p in parts] == [3, 3]
    whole = pd.concat(parts)
    assert whole["line"].tolist() == ["h", "a", "b", "", "c", "d"] and whole["line_no"].tolist() == list(range(6))


def test_a_hot_week_of_equal_lines_becomes_many_archives(spark):
    feed = spark.range(1000).select(F.lit("2024-05-06").alias("week_date"), F.lit("comercio").alias("kind"), F.lit("1|same").alias("line"), F.col("id").alias("n"))
    packed = archives_q._archives(feed, archive_lines=100)
    assert packed.count() == 10
    lines = archives.expand_archives(packed)
    sizes = Counter(r.archive for r in lines.where("line_no > 0").collect())
    assert sum(sizes.values()) == 1000 and max(sizes.values()) < 200
