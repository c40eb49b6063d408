"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Queries that run a stand-in at a plug point, thus Python.
PLUG_POINTS: set[str] = set()


def query(sql: str | None = None, plug_point: bool = False) -> Callable[[Query], Query]:
    """Register a query under its function's name; ``sql`` is its oracle."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if plug_point:
            PLUG_POINTS.add(f.__name__)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
