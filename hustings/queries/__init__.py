"""The catalogue of queries over the driver's tables and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from hustings.sources.shared import with_checkpoints

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Reads a table of a folder by its name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str | None = None):
    """Registers a function of (tables) as a query of its name; tables (Tables) reads them. sql is its DuckDB equivalent."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            with_checkpoints(spark)
            return function(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


for _module in ("temporal", "sequences", "relational", "texts", "records", "proceedings", "civic", "scans", "versions", "trees"):
    import_module(f"hustings.queries.{_module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
