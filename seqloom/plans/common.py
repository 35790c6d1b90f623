"""Tables of a data folder and pairs of a query with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Tables:
    """t.orders is the table orders of a folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")


class Registry:
    """Named queries (functions of Tables) and their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        def add(f: Callable[[Tables], DataFrame]) -> Callable:
            self.queries[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return add
