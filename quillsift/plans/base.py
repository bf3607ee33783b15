"""Registration of queries, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of (table reader) under its name. The reader gives a driver table by name."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql
        return function

    return register
