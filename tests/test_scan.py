"""Prefix scans over range partitions against plain Python."""

from itertools import accumulate

from pyspark.sql import functions as F

from gondola.operators.scan import exact_percentiles, numbered, running


def test_running_totals_of_hot_odd_and_empty_keys(spark):
    rows = [("hot", i, i % 7 if i % 5 else None) for i in range(500)] + [(None, i, 1) for i in range(20)] + [("one", 1, 5)]
    df = spark.createDataFrame(rows, "k string, t long, v long").repartition(7)
    got = {(r.k, r.t): (r.n, r.s) for r in running(df, ["k"], ["t"], sums={"s": F.col("v")}, count="n", parts=16).collect()}
    assert len(got) == len(rows)
    for key in ("hot", None, "one"):
        mine = sorted((t, v) for k, t, v in rows if k == key)
        sums = list(accumulate(v or 0 for _, v in mine))
        for i, ((t, v), s) in enumerate(zip(mine, sums)):
            assert got[key, t] == (i + 1, s if any(x is not None for _, x in mine[:i + 1]) else None)
    assert running(df.limit(0), ["k"], ["t"], count="n").collect() == []


def test_hot_key_is_spread_over_ranges(spark):
    df = spark.range(4000).select(F.lit("hot").alias("k"), "id")
    out = running(df, ["k"], ["id"], count="n", parts=16)
    assert [r.n for r in out.orderBy("id").collect()] == list(range(1, 4001))
    assert "range__" in out._jdf.queryExecution().optimizedPlan().toString()


def test_numbered_is_the_global_rank(spark):
    df = spark.createDataFrame([(x,) for x in ["b", "a", None, "c", "aa"]], "name string")
    assert [r.name for r in numbered(df, ["name"], parts=4).orderBy("rank").collect()] == [None, "a", "aa", "b", "c"]


def test_previous_row_over_ranges(spark):
    rows = [("hot", i * 3, f"x{i}") for i in range(300)] + [("b", 5, "y"), ("b", 5, "z")]
    out = running(spark.createDataFrame(rows, "k string, t long, s string"), ["k"], ["t", "s"], previous={"was": "t", "text": "s"}, parts=8)
    got = {(r.k, r.t, r.s): (r.was, r.text) for r in out.collect()}
    for key in ("hot", "b"):
        mine = sorted((t, s) for k, t, s in rows if k == key)
        for here, before in zip(mine, [(None, None), *mine]):
            assert got[(key, *here)] == before


def test_exact_percentiles_of_skewed_groups(spark):
    import numpy as np

    values = {"hot": [1.0] * 500 + [float(i) for i in range(100)] + [1e9], "two": [2.0, 3.0], "one": [7.0], None: [1.0, 2.0, 4.0]}
    rows = [(k, v) for k, vs in values.items() for v in vs] + [("hot", None), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in exact_percentiles(df, ["k"], "v", [0.1, 0.5, 0.9], parts=8).collect()}
    assert set(got) == set(values)
    for k, vs in values.items():
        for q in (0.1, 0.5, 0.9):
            tag = f"{round(q * 100)}"
            assert abs(got[k][f"p{tag}_interp"] - np.quantile(vs, q)) < 1e-9 * max(vs)
            assert got[k][f"p{tag}_nearest"] == sorted(vs)[int(len(vs) * q)] and got[k].n == len(vs)
    whole = exact_percentiles(df, [], "v", [0.5]).collect()
    assert [r.p50_interp for r in whole] == [1.0]
    plan = exact_percentiles(df, ["k"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile" not in plan.lower()
