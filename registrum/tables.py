"""Queries by name over the tables of a data folder, each with the same query in DuckDB's SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder, by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, *names: str, **args) -> DataFrame:
        """A query over {name} tables."""
        return self.spark.sql(text, args or None, **{n: getattr(self, n) for n in names})


def query(name: str, sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return f

    return add


def both(name: str, sql: str, *names: str) -> None:
    """A query whose text is the same for both engines. {name} stands for a table."""

    @query(name, sql.format(**{n: n for n in names}))
    def _(t: Tables) -> DataFrame:
        return t.sql(sql, *names)
