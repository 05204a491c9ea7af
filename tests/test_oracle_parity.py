"""Every registered query key against its DuckDB oracle (row count, column names/types, multiset of
values) on the smallest fixture; keys without an oracle must run and return a stable schema."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare

KEYS = sorted(entry.REGISTRY)
SQL = {k: v for k, v in entry.oracle_sql().items() if k in entry.REGISTRY}


def test_every_key_has_an_oracle_or_is_declared_rows_only():
    rows_only = {k for k in KEYS if k not in SQL}
    assert rows_only <= {"kmeans_sizes"}, rows_only
    assert set(SQL) <= set(KEYS)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == entry.entry(spark).columns


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck_small, key):
    r = compare(spark, duck_small, key, entry.queries()[key], SQL.get(key), SF_SMALL)
    assert r["status"] in ("ok", "rows-only"), r
