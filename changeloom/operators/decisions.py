"""Decisions at start-up as expressions over metadata: start points, gaps, snapshots, schema changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import LOWEST_TEXT

SMALL_TABLE_ROWS = 5_000_000
MAX_AGE_ASSUMED_NULL_SECONDS = 3600


def start_points(cases: DataFrame, db_max_lsn: str) -> DataFrame:
    """Where each topic's changes start: recorded progress, unless another instance's is to be published again; else the end or the beginning."""
    forget = (F.col("progress_table") != F.col("change_table")) & (F.col("overlap") == "republish")
    known = F.col("lsn").isNotNull() & ~F.coalesce(forget, F.lit(False))
    fresh = F.when(F.col("start_point") == "latest", F.lit(db_max_lsn)).otherwise(LOWEST_TEXT)
    return cases.select(
        "topic", F.when(known, F.col("lsn")).otherwise(fresh).alias("lsn"), F.when(known, F.coalesce("command_id", F.lit(1))).otherwise(1).alias("command_id"), F.when(known, F.col("seqval")).otherwise(LOWEST_TEXT).alias("seqval"),
        F.when(known, F.col("operation")).otherwise(0).alias("operation"),
    )


def gap_decision(cases: DataFrame) -> DataFrame:
    """What to do when the log no longer reaches back to where a table has to start."""
    gap = (F.col("start_lsn") > LOWEST_TEXT) & (F.col("start_lsn") < F.col("min_lsn"))
    decision = (
        F.when(~gap, "no gap")
        .when(F.col("prior_max_lsn") <= F.col("start_lsn"), "proceed at min_lsn")
        .when(F.col("handling") == "ignore", "ignore")
        .when((F.col("handling") == "begin_new_snapshot") & F.col("snapshot_allowed"), "begin new snapshot")
        .otherwise("raise")
    )
    return cases.select("case_id", decision.alias("decision"))


def snapshot_decision(cases: DataFrame) -> DataFrame:
    """What becomes of snapshot progress when a topic's change table is another one now."""
    moved = F.col("progress_table") != F.col("change_table")
    decision = F.when(F.col("progress_table").isNull(), "start").when(~moved, "continue").when((F.col("handling") == "begin_new") & F.col("needs_snapshot"), "start again").otherwise("mark complete")
    return cases.select("topic", decision.alias("decision"))


def snapshot_state(cases: DataFrame) -> DataFrame:
    decision = (
        F.when(~F.col("snapshot_allowed"), "complete")
        .when(~F.col("has_key"), "raise")
        .when(F.col("sentinel"), "complete")
        .when(F.col("resume_key").isNotNull() & F.col("resume_key").eqNullSafe(F.col("min_key")), "complete")
        .when(F.col("resume_key").isNotNull(), "resume")
        .when(F.col("min_key").isNotNull(), "full")
        .otherwise("complete")
    )
    return cases.select("case_id", decision.alias("state"))


def schema_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns that one instance has and the other hasn't, or has differently. Nulls compare as values."""
    parts = ["column_type", "num_precision", "num_scale", "is_computed", "is_nullable"]
    a = old.select("column_name", F.struct(*parts).alias("before"))
    b = new.select("column_name", F.struct(*parts).alias("after"))
    both = a.join(b, "column_name", "full_outer")
    same = both["before.column_type"].isNotNull()
    for p in parts:
        same = same & F.col(f"before.{p}").eqNullSafe(F.col(f"after.{p}"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").when(~same, "changed").otherwise("same")
    return both.select("column_name", kind.alias("change"), "before", "after")


def recently_added(ddl: DataFrame, max_age: int = MAX_AGE_ASSUMED_NULL_SECONDS) -> DataFrame:
    """Columns that statements added lately and none added longer ago."""
    added = ddl.select(F.explode(X.added_columns(F.col("ddl_command"))).alias("column_name"), "age_seconds")
    return added.groupBy("column_name").agg(F.max("age_seconds").alias("oldest")).where(F.col("oldest") <= max_age).select("column_name")


def _wire_type(column: str) -> Column:
    kind = F.lower(F.col(f"{column}.column_type"))
    decimal = F.concat_ws(",", F.lit("decimal"), F.col(f"{column}.num_precision").cast("string"), F.col(f"{column}.num_scale").cast("string"))
    return F.when(kind.isin("decimal", "numeric", "money", "smallmoney"), decimal).when(kind.isin("int", "smallint", "tinyint"), "int").when(kind.isin("char", "nchar", "varchar", "nvarchar", "text", "ntext", "xml", "datetime", "datetime2", "smalldatetime", "datetimeoffset"), "string").otherwise(kind)


def _why(rule: int, text: str) -> Column:
    return F.struct(F.lit(rule).alias("rule"), F.lit(text).alias("why"))


def resnapshot(diff: DataFrame, old_exists: bool, table_rows: int, indexed: list[str], with_values: list[str], recent: DataFrame, for_drops: bool = True) -> DataFrame:
    """Whether moving to the new instance needs a new snapshot, with the first reason that holds.

    table_rows may be counted up to SMALL_TABLE_ROWS only; with_values names added columns known to hold a value.
    """
    wire = ~_wire_type("before").eqNullSafe(_wire_type("after"))
    scanned = F.lit(table_rows < SMALL_TABLE_ROWS) | F.col("column_name").isin(*indexed or [""])
    judged = diff.join(recent.withColumn("_recent", F.lit(True)), F.lower(diff["column_name"]) == recent["column_name"], "left").select(diff["*"], "_recent")
    reason = (
        F.when((F.col("change") == "removed") & F.lit(for_drops), _why(2, "column removed"))
        .when((F.col("change") == "changed") & (F.col("before.is_computed") != F.col("after.is_computed")), _why(3, "computed changed"))
        .when((F.col("change") == "changed") & wire, _why(4, "type changed"))
        .when((F.col("change") == "added") & (F.col("after.is_nullable") == 0), _why(5, "added column not null"))
        .when((F.col("change") == "added") & scanned & F.col("column_name").isin(*with_values or [""]), _why(6, "added column has values"))
        .when((F.col("change") == "added") & ~scanned & F.col("_recent").isNull(), _why(7, "added column not recent"))
    )
    first = judged.select(reason.alias("r")).agg(F.min("r").alias("r"))
    if not old_exists:
        return first.select(F.lit(True).alias("needed"), F.lit("old instance gone").alias("reason"))
    return first.select(F.col("r").isNotNull().alias("needed"), F.coalesce("r.why", F.lit("none")).alias("reason"))
