"""Bronze file stream: each landed file is ingested exactly once; the date comes from its path."""

from gondola.sources import sinks
from gondola.streaming import bronze


def test_bronze_stream_is_exactly_once_per_file(spark, tmp_path):
    cols = bronze.PRODUCT_COLUMNS
    row = ["1", "10", "7790000000001", "leche", "1 un", "12,50", None, None]
    land, sink, chk = str(tmp_path / "land"), str(tmp_path / "bronze"), str(tmp_path / "chk")

    def land_week(week, n):
        df = spark.createDataFrame([[week] + row] * n, ", ".join(["week_date string"] + [f"{c} string" for c in cols]))
        sinks.land_csv_by_date(df, land)

    def ingest():
        bronze.ingest_available(bronze.bronze_stream(spark, f"{land}/*/*.csv", cols), sink, chk)
        return spark.read.parquet(sink)

    land_week("2024-01-01", 3)
    assert ingest().count() == 3
    assert ingest().count() == 3                      # replay with the same checkpoint: nothing new
    land_week("2024-01-08", 2)                        # a new weekly folder arrives
    out = ingest()
    assert sorted((r.week_date, r.n) for r in out.groupBy("week_date").count().withColumnRenamed("count", "n")
                  .collect()) == [("2024-01-01", 3), ("2024-01-08", 2)]


def test_three_streams_in_any_order_give_the_same_silver(spark, tmp_path):
    """Stores after products, a week that comes later, a replay and a crash between write and note."""
    from gondola.operators.silver import silver_prices
    from gondola.streaming import silver

    weeks = ["2024-01-01", "2024-01-08", "2024-01-15"]
    products = [(w, "1" if i % 2 else "2", str(10 + i % 4), f"779{i}", f"p{i}", "1 un", f"{i + 1},50", None, None) for w in weeks for i in range(40)]
    stores = [(w, str(10 + s), "1" if s % 2 else "2", "centro" if s < 2 else "norte", "loc", "calle", str(s), f"store {s}") for w in weeks for s in range(4)]
    chains = [(weeks[0], "1", "uno"), (weeks[0], "2", "dos"), (weeks[2], "2", "dos")]
    rows = {"productos": products, "sucursales": stores, "comercio": chains}

    def frame(kind, names=None):
        cols = ["week_date", *(names or silver.KINDS[kind])]
        return spark.createDataFrame(rows[kind], ", ".join(f"{c} string" for c in cols))

    def land(kind, week):
        df = frame(kind, silver.raw_columns(kind)).where(f"week_date = '{week}'")
        sinks.land_csv_by_date(df, f"{tmp_path}/land/{kind}")
        silver.ingest(spark, f"{tmp_path}/land", root, kind)

    root, areas = f"{tmp_path}/lake", ["centro"]
    land("productos", weeks[0])
    land("productos", weeks[1])
    assert silver.refresh(spark, root, areas, ["loc"]) == weeks[:2] and silver.silver_table(spark, root) is None  # no stores yet
    land("comercio", weeks[0])
    land("sucursales", weeks[0])
    assert silver.refresh(spark, root, areas, ["loc"]) == weeks[:2]  # the chains touch both weeks, the stores one
    assert {str(r.week_date) for r in silver.silver_table(spark, root).select("week_date").distinct().collect()} == {weeks[0]}
    land("sucursales", weeks[2])
    land("sucursales", weeks[1])
    land("productos", weeks[2])
    land("comercio", weeks[2])
    assert silver.refresh(spark, root, areas, ["loc"]) == weeks[1:]
    assert silver.refresh(spark, root, areas, ["loc"]) == []  # nothing pending
    want = silver_prices(frame("productos"), frame("sucursales"), frame("comercio"), areas, ["loc"])
    key = lambda df: sorted(map(repr, df.select(sorted(df.columns)).collect()))
    assert key(silver.silver_table(spark, root)) == key(want)
    # a crash before the note: the weeks are still pending and the same rows come again
    spark._jvm.org.apache.hadoop.fs.Path(f"{root}/done").getFileSystem(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{root}/done"), True)
    assert silver.refresh(spark, root, areas, ["loc"]) == weeks
    assert key(silver.silver_table(spark, root)) == key(want)
