"""Registered queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkledger.plans.adapters import VIEWS, view, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None, *views: str):
    """Registers a query under its function's name: it gets its views as DataFrames, the SQL gets them in front."""

    def put(build):
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(*[view(spark, sf_dir, v) if v in VIEWS else spark.read.parquet(f"{sf_dir}/{v}.parquet") for v in views])

        QUERIES[build.__name__] = query
        if sql is not None:
            ORACLES[build.__name__] = with_views(sql, *[v for v in views if v in VIEWS])
        return build

    return put
