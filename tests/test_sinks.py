"""Sinks: overwrite, append with schema evolution, insert overwrite, versioned writes, temp views."""

from pyspark.sql import functions as F

from gondola.sources import sinks


def test_table_sinks(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS t_sink")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    sinks.overwrite_table(df, "t_sink")                                              # SNK-1
    sinks.append_table(spark, spark.createDataFrame([(2,)], "id int"), "t_sink")      # SNK-3 missing col
    sinks.append_table(spark, spark.createDataFrame([(3, "c", 1.5)], "id int, v string, x double"), "t_sink")
    got = sorted(tuple(r) for r in spark.table("t_sink").collect())
    assert got == [(1, "a", None), (2, None, None), (3, "c", 1.5)]
    sinks.insert_overwrite(spark.createDataFrame([(9, "z", 0.0)], "id int, v string, x double"), "t_sink")  # SNK-5
    assert [tuple(r) for r in spark.table("t_sink").collect()] == [(9, "z", 0.0)]
    spark.sql("DROP TABLE t_sink")


def test_versioned_write_and_view(spark, tmp_path):
    df = spark.range(3).withColumn("v", F.col("id") * 2)
    p1 = sinks.write_version(df, str(tmp_path / "t"), 1)                               # SNK-2 / SNK-8
    p2 = sinks.write_version(spark.read.parquet(p1).withColumn("v", F.col("v") + 1), str(tmp_path / "t"), 2)
    spark.read.parquet(p2).createOrReplaceTempView("t_current")                        # SNK-9
    assert [r.v for r in spark.sql("SELECT v FROM t_current ORDER BY id").collect()] == [1, 3, 5]


def test_crash_between_write_and_switch_leaves_the_old_version(spark, tmp_path):
    base, df = str(tmp_path / "t"), spark.range(3)
    assert sinks.current_version(spark, base) == 0
    assert sinks.publish(df, base, "t_now") == 1
    old = spark.table("t_now")
    sinks.write_version(spark.range(100), base, 2)                                    # written, never switched to
    assert sinks.current_version(spark, base) == 1 and sinks.read_current(spark, base).count() == 3
    assert sinks.publish(spark.table("t_now").withColumn("id", F.col("id") + 1), base, "t_now") == 2   # the retry
    assert [r.id for r in spark.table("t_now").orderBy("id").collect()] == [1, 2, 3]
    assert [r.id for r in old.orderBy("id").collect()] == [0, 1, 2]                    # a reader that began before


def test_append_run_replaces_its_own_run_only(spark, tmp_path):
    name = "runs_t"
    a = spark.createDataFrame([(1, "x", "r0"), (2, "y", "r0")], "id int, v string, run string")
    b = spark.createDataFrame([(3, 0.5, "r1")], "id int, w double, run string")
    try:
        for _ in range(2):
            sinks.append_run(a, name, "run", "r0", str(tmp_path / "runs"))
            sinks.append_run(b.union(b), name, "run", "r1")
            sinks.append_run(b, name, "run", "r1")                                          # the retry
        got = sorted((r.id, r.v, r.w, r.run) for r in spark.table(name).collect())
        assert got == [(1, "x", None, "r0"), (2, "y", None, "r0"), (3, None, 0.5, "r1")]
        sinks.insert_columns(spark.createDataFrame([("r2", 9)], "run string, id int"), name)
        assert [(r.id, r.v) for r in spark.table(name).where("run = 'r2'").collect()] == [(9, None)]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
