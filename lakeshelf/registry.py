"""One list of (key, query, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lakeshelf.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is the same question in DuckDB SQL."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")

        @wraps(fn)
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = tuned
        if oracle is not None:
            ORACLES[key] = oracle
        return tuned

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
