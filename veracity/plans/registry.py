"""Registry of the driver queries: ``name → (spark, sf_dir) → DataFrame`` plus the
equivalent DuckDB SQL for the oracle check.

Every query reads the given tables (or tables Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from veracity.session import bound_batches, ship_package, table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
            bound_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = bounded
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, name))
