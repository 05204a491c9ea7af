"""Registry of query keys: each key has a Spark builder ``fn(spark, sf_dir) -> DataFrame`` and,
where the semantics are SQL-expressible, an equivalent DuckDB oracle string over the driver's
views. Column names and types of both sides are kept identical (every computed column aliased,
integer widths cast, doubles rounded)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gondola.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    """Decorator: ``@register("key", SQL)`` on ``def q(t: Tables) -> DataFrame``."""

    def deco(fn: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query key {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = f"q_{name}"
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, sql, ids)
        return fn

    return deco
