"""The source database: options of Spark's own reader, its clock, and the skew of that clock.

Tables come by JDBC where its driver is on the class path. A read of changes is bounded by log position and cut into
ranges, so it is as wide as asked for; column types and keys come from the DataFrame's schema and the catalog tables.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SKEW_EVERY = 300  # seconds between two measures of the clock


def jdbc_options(server: str, database: str, user: str, password: str, failover: str | None = None, read_only: bool = True, fetch_rows: int = 1000, timeout: int = 30, **extra: str) -> dict[str, str]:
    """Options of a connection; with a failover partner it goes there when the server doesn't answer."""
    parts = {"databaseName": database, "applicationIntent": "ReadOnly" if read_only else "ReadWrite", "encrypt": "true"} | ({"failoverPartner": failover} if failover else {})
    url = f"jdbc:sqlserver://{server};" + ";".join(f"{k}={v}" for k, v in parts.items())
    return {"url": url, "user": user, "password": password, "fetchsize": str(fetch_rows), "queryTimeout": str(timeout), **extra}


def change_ranges(after: str, upto: str, ranges: int) -> list[str]:
    """Predicates that cut the positions after one and up to another into ranges of equal width, one for each read task."""
    low, high = int(after, 16), int(upto, 16)
    step = max(1, -(-(high - low) // max(1, ranges)))
    cuts = [*range(low, high, step), high]
    return [f"__$start_lsn > 0x{a:020x} AND __$start_lsn <= 0x{b:020x}" for a, b in zip(cuts, cuts[1:], strict=False)]


def read_changes(spark: SparkSession, options: dict[str, str], table: str, after: str, upto: str, ranges: int = 8) -> DataFrame:
    """Rows of a change table between two positions; says so where the driver is missing."""
    properties = {k: v for k, v in options.items() if k != "url"}
    try:
        return spark.read.jdbc(options["url"], table, predicates=change_ranges(after, upto, ranges) or ["1 = 0"], properties=properties)
    except Exception as e:
        if "No suitable driver" in str(e) or "ClassNotFoundException" in str(e):
            raise RuntimeError("the database's JDBC driver isn't on the class path (spark.jars.packages)") from e
        raise


def described(table: DataFrame, key: list[str]) -> list[tuple[str, int, str, int | None, bool]]:
    """(name, ordinal, type, place in the key, nullable) of a table's columns, whatever the case of the key's names."""
    place = {k.lower(): i for i, k in enumerate(key, 1)}
    missing = set(place) - {f.name.lower() for f in table.schema.fields}
    if missing:
        raise ValueError(f"the table has no column {sorted(missing)}")
    return [(f.name, i, f.dataType.simpleString(), place.get(f.name.lower()), f.nullable) for i, f in enumerate(table.schema.fields, 1)]


def database_time(spark: SparkSession) -> dt.datetime:
    """The clock of the engine that holds the tables; for files that is Spark's own."""
    return spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("t")).first().t


class ClockSync:
    """The skew of a database's clock from UTC, in microseconds: measured when first asked for, and again every so often."""

    def __init__(self, read: Callable[[], dt.datetime], every: float = SKEW_EVERY, clock: Callable[[], float] = time.time):
        self.read, self.every, self.clock = read, every, clock
        self.skew, self.at = 0, -float("inf")

    def microseconds(self) -> int:
        """What to add to a time of the database's clock to have it in UTC; the middle of the call counts as its moment."""
        if self.clock() - self.at >= self.every:
            before = self.clock()
            told = self.read()
            after = self.clock()
            utc = dt.datetime.fromtimestamp((before + after) / 2, dt.timezone.utc).replace(tzinfo=None)
            self.skew, self.at = round((utc - told).total_seconds() * 1e6), after
        return self.skew
