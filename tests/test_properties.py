"""Properties listed in SURVEY §7.6, checked on the smallest fixture and on random inline data."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from gondola.operators import mutate


def test_coverage_shares_sum_to_100(spark):
    rows = entry.queries()["coverage_report"](spark, SF_SMALL).collect()
    assert abs(sum(r.porcentaje for r in rows) - 100.0) <= 0.01 * len(rows)


def test_repaired_barcodes_are_13_digits(spark):
    df = entry.queries()["barcode_prefix"](spark, SF_SMALL)
    assert df.filter(~F.col("repaired_barcode").rlike("^[0-9]{13}$")).count() == 0


def test_receipt_base_is_paid_plus_discount(spark):
    df = entry.queries()["receipt_items"](spark, SF_SMALL)
    assert df.filter(F.abs(F.col("precio_base") - F.col("precio_pagado") - F.col("descuento")) > 1e-9).count() == 0


@given(st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=8,
                unique_by=lambda t: t[0]),
       st.lists(st.tuples(st.integers(0, 5), st.integers(10, 19)), min_size=0, max_size=8, unique_by=lambda t: t[0]))
@settings(max_examples=15, deadline=None)
def test_fill_only_merge_never_overwrites(spark, target, source):
    tgt = spark.createDataFrame(target, "id int, v int")
    src = spark.createDataFrame(source, "id int, v int")
    got = dict(mutate.merge_update(tgt, src, "id", ["v"], fill_only=True).collect())
    s = dict(source)
    for k, v in target:
        assert got[k] == (v if v is not None else s.get(k))
