"""Change-table operators: incremental scans, commit times, counts and the global order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import INDEX_COLUMNS, LOWEST_TEXT, ChangeIndex
from changeloom.sources.work import numbered

BUCKET = 1 << 16  # rows of an as-of lookup that one task puts in order


def published(ct: DataFrame) -> DataFrame:
    return ct.where(X.is_published(F.col("operation")))


def with_event_time(ct: DataFrame, ltm: DataFrame) -> DataFrame:
    """Changes with their commit time. A change whose log position the map lacks is absent, as its commit isn't known.

    The map grows with the log, so it isn't broadcast here; where it is small the optimizer does that itself.
    """
    times = ltm.select(F.col("start_lsn").alias("lsn"), F.col("tran_end_time").alias("event_time"))
    return ct.join(times, "lsn")


def scan(ct: DataFrame, ltm: DataFrame, after: ChangeIndex, max_lsn: str, limit: int | None = None, with_operation: bool = True) -> DataFrame:
    """Published changes after an index, up to a log position, in log order, with commit times.

    Both sides of the join are bounded by log position, so a page touches a slice of each. `with_operation=False` leaves
    the operation out of the start bound: a page that ends between rows that differ in nothing else then skips the rest.
    """
    upto = F.lit(max_lsn)
    rows = published(ct).where(X.after_index(after, with_operation)).where(F.col("lsn") <= upto)
    times = ltm.where((F.col("start_lsn") >= after.text()[0]) & (F.col("start_lsn") <= upto))
    out = with_event_time(rows, times).orderBy(*INDEX_COLUMNS)
    return out.limit(limit) if limit is not None else out


def max_lsn(ltm: DataFrame) -> DataFrame:
    return ltm.agg(F.max("start_lsn").alias("max_lsn"))


def latest_entry_time(ltm: DataFrame) -> DataFrame:
    return ltm.agg(F.max("tran_end_time").alias("latest_entry_time"))


def rows_per_second(ct: DataFrame, ltm: DataFrame) -> DataFrame:
    """Whole rows per whole second between the first and last commit; 0 where that is less than a second."""
    seconds = F.timestamp_diff("SECOND", F.date_trunc("second", F.min("event_time")), F.date_trunc("second", F.max("event_time")))
    per = with_event_time(ct, ltm).agg(F.count("*").alias("n"), seconds.alias("s"))
    return per.select(F.coalesce(F.expr("n div nullif(s, 0)"), F.lit(0)).cast("long").alias("rows_per_second"))


def max_index(ct: DataFrame, start_lsn: str) -> DataFrame:
    """The highest index of a change table; for an empty one, the position after its start, so there is always a row."""
    spark = ct.sparkSession
    floor = spark.range(1).select(X.increment_lsn(F.lit(start_lsn)).alias("lsn"), F.lit(0).alias("command_id"), F.lit(LOWEST_TEXT).alias("seqval"), F.lit(0).alias("operation"))
    top = ct.select(*INDEX_COLUMNS).unionByName(floor).agg(F.max(X.index()).alias("idx"))
    return top.select(*[F.col(f"idx.{c}").alias(c) for c in INDEX_COLUMNS])


def count_by_operation(ct: DataFrame, upto: ChangeIndex) -> DataFrame:
    return published(ct).where(X.upto_index(upto)).groupBy("operation").agg(F.count("*").alias("n"))


def operation_counts(ct: DataFrame, upto: ChangeIndex) -> DataFrame:
    """One row: deletes, inserts, updates."""
    rows = published(ct).where(X.upto_index(upto))
    return rows.agg(*[F.count_if(F.col("operation") == op).alias(n) for op, n in ((1, "deletes"), (2, "inserts"), (4, "updates"))])


def indexes_for_validation(ct: DataFrame, limit: int, min_lsn: str | None = None) -> DataFrame:
    rows = published(ct)
    if min_lsn is not None:
        rows = rows.where(F.col("lsn") >= min_lsn)
    return rows.select(*INDEX_COLUMNS).orderBy(*INDEX_COLUMNS).limit(limit)


def lsn_at_or_after(ltm: DataFrame, times: DataFrame) -> DataFrame:
    """For each `at` the smallest log position committed at or after it, null where there is none.

    An as-of lookup in one sort: both sides are stacked and numbered, a time asked for before the commits of that time, and
    the smallest position still to come is carried back over buckets of so many rows, whose own minima bridge from one to
    the next.
    """
    stacked = ltm.select(F.col("tran_end_time").alias("at"), F.col("start_lsn").alias("lsn")).unionByName(times.select("at", F.lit(None).cast("string").alias("lsn")))
    stacked = numbered(stacked, [F.col("at"), F.col("lsn").asc_nulls_first()], "pos").withColumn("bucket", F.floor(F.col("pos") / BUCKET))
    per_bucket = stacked.groupBy("bucket").agg(F.min("lsn").alias("least"))
    later = per_bucket.withColumn("beyond", F.min("least").over(Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)))  # one row for each bucket
    # Backwards: a frame that grows is added to, one that shrinks is made anew for each row.
    within = Window.partitionBy("bucket").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = stacked.withColumn("inside", F.min("lsn").over(within)).join(later.select("bucket", "beyond"), "bucket")
    return found.where("lsn IS NULL").select("at", F.least("inside", "beyond").alias("lsn"))


def infer_command_id(progress: DataFrame, ct: DataFrame, default: int = 1) -> DataFrame:
    """Progress kept without a command id gets that of the change at its (lsn, seqval, operation), or the default."""
    known = ct.groupBy("lsn", "seqval", "operation").agg(F.min("command_id").alias("found"))
    return progress.join(known, ["lsn", "seqval", "operation"], "left").withColumn("command_id", F.coalesce("found", F.lit(default))).drop("found")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common_ceiling(frames: dict[str, DataFrame]) -> DataFrame:
    """The least of the tables' highest indexes: below it every table has been seen."""
    tops = union_all([df.agg(F.max(X.index()).alias("idx")).withColumn("source", F.lit(name)) for name, df in frames.items()])
    return tops.agg(F.min("idx").alias("idx")).select(*[F.col(f"idx.{c}").alias(c) for c in INDEX_COLUMNS])


def globally_ordered(frames: dict[str, DataFrame], ceiling: ChangeIndex | None = None) -> DataFrame:
    """Published changes of all tables in one log order, up to a common ceiling; the table's name breaks ties."""
    rows = union_all([published(df).withColumn("source", F.lit(name)) for name, df in frames.items()])
    if ceiling is not None:
        rows = rows.where(X.upto_index(ceiling))
    return rows.orderBy(*INDEX_COLUMNS, "source")


def order_violations(rows: DataFrame, position: str, partition: list[str] | None = None) -> DataFrame:
    """Rows whose index is below that of the row before them. Without a partition, neighbours are met by position."""
    if partition:
        before = F.lag(X.index()).over(Window.partitionBy(*partition).orderBy(position))
        return rows.withColumn("_before", before).where(F.col("_before") > X.index()).drop("_before")
    before = rows.select((F.col(position) + 1).alias(position), X.index().alias("_before"))
    return rows.join(before, position).where(F.col("_before") > X.index()).drop("_before")
