"""A list of queries: each has a name, a function of (spark, sf_dir), and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeloom.sources.fixtures import base, self_contained, view

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Base tables and derived views of one folder, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return base(self.spark, self.sf_dir, name)

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)


class Book:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
        def keep(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
            self.queries[name] = lambda spark, sf_dir: fn(Inputs(spark, sf_dir))
            if sql is not None:
                self.oracles[name] = self_contained(sql)
            return fn

        return keep
