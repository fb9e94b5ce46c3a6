"""Snapshot operators: pages by descending key, full snapshots, ranges and bounds of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import expr as X


def page(table: DataFrame, key: list[str], limit: int, below: list | None = None) -> DataFrame:
    """Up to `limit` rows in descending key order, from the top or strictly below a key."""
    rows = table if below is None else table.where(X.key_compare(key, "<", below))
    return rows.orderBy(*[F.col(k).desc() for k in key]).limit(limit)


def full(table: DataFrame, key: list[str]) -> DataFrame:
    """A whole snapshot: all rows in descending key order by one range-partitioned sort, without pages."""
    return table.orderBy(*[F.col(k).desc() for k in key])


def columns(table: DataFrame, captured: list[tuple[str, str]]) -> DataFrame:
    """The captured columns (name, type); one that the table no longer has is null."""
    have = {c.lower(): c for c in table.columns}
    return table.select(*[F.col(have[n.lower()]).alias(n) if n.lower() in have else F.lit(None).cast(t).alias(n) for n, t in captured])


def range_condition(key: list[str], low: list, high: list) -> Column:
    """The closed range between two composite keys."""
    return X.key_compare(key, ">=", low) & X.key_compare(key, "<=", high)


def range_count(table: DataFrame, key: list[str], low: list, high: list) -> DataFrame:
    return table.where(range_condition(key, low, high)).agg(F.count("*").alias("n"))


def bounded_count(table: DataFrame, most: int) -> DataFrame:
    """The number of rows, counted no further than `most`."""
    return table.select(F.lit(1).alias("one")).limit(most).agg(F.count("*").alias("n"))


def extreme_key(table: DataFrame, key: list[str], highest: bool) -> DataFrame:
    pick = F.max if highest else F.min
    top = table.agg(pick(X.key_struct(key)).alias("k"))
    return top.select(*[F.col(f"k.{c}").alias(c) for c in key])


def has_non_null(table: DataFrame, column: str) -> DataFrame:
    """Whether a column holds any value; reads no further than the first one it meets."""
    return table.where(F.col(column).isNotNull()).select(F.lit(1).alias("one")).limit(1).agg((F.count("*") > 0).alias("has_value"))
