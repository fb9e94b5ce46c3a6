"""Catalog operators: capture instances, their columns and fingerprints, table filters, topic names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.functions import expr as X


def included(tables: DataFrame, include: str | None, exclude: str | None) -> DataFrame:
    """Tables whose `schema.table` the include pattern matches from the start and the exclude pattern doesn't."""
    name = F.concat_ws(".", "schema_name", "table_name")
    out = tables if include is None else tables.where(X.matches_start(name, include))
    return out if exclude is None else out.where(~X.matches_start(name, exclude))


def snapshot_allowed(tables: DataFrame, include: str | None, exclude: str | None) -> DataFrame:
    """With `snapshot_allowed`: without an include pattern no table gets a snapshot."""
    name = F.concat_ws(".", "schema_name", "table_name")
    allowed = F.lit(False) if include is None else X.matches_start(name, include)
    if exclude is not None:
        allowed = allowed & ~X.matches_start(name, exclude)
    return tables.withColumn("snapshot_allowed", allowed)


def latest_instances(instances: DataFrame, strategy: str = "create_date", regex: str | None = None) -> DataFrame:
    """For each source table its newest capture instance: by creation, or by a pattern's first group in the instance's name.

    Instances that have no start position yet are left out. Of equals the one with the greater object id counts.
    """
    ready = instances.where(F.col("start_lsn").isNotNull() & F.col("create_date").isNotNull())
    rank = F.col("create_date").cast("string") if strategy == "create_date" else F.regexp_extract("capture_instance", regex, 1)
    best = ready.groupBy("schema_name", "table_name").agg(F.max_by(F.struct("capture_instance", "start_lsn", "object_id"), F.struct(rank.alias("rank"), F.col("object_id").alias("id"))).alias("x"))
    return best.select("schema_name", "table_name", "x.capture_instance", "x.start_lsn", "x.object_id")


def column_metadata(instances: DataFrame, captured: DataFrame, names: list[str]) -> DataFrame:
    """Captured columns of the named instances, with key ordinals, precision, scale and nullability."""
    chosen = instances.where(F.col("capture_instance").isin(*names))
    return chosen.join(captured, "object_id").select("schema_name", "table_name", "capture_instance", "start_lsn", "column_ordinal", "column_name", "column_type", "is_computed", "pk_ordinal", "num_precision", "num_scale", "is_nullable")


def type_checksums(instances: DataFrame, captured: DataFrame) -> DataFrame:
    """A fingerprint of each instance's column names and types that doesn't depend on their order."""
    per = F.xxhash64("column_ordinal", "column_name", "column_type", "is_computed")
    return instances.join(captured, "object_id").groupBy("capture_instance").agg(F.bit_xor(per).alias("checksum"), F.count("*").alias("columns"))


def leading_index_columns(index_columns: DataFrame) -> DataFrame:
    """Columns that come first in an index that is enabled, unfiltered and not a heap."""
    good = (F.col("key_ordinal") == 1) & (F.col("is_disabled") == 0) & (F.col("has_filter") == 0) & (F.col("index_type") != 0)
    return index_columns.where(good).select("schema_name", "table_name", "column_name").distinct()


def unordered_indexes(index_columns: DataFrame) -> DataFrame:
    """For each change table the columns of its clustered index in order, and whether they are the change index."""
    listed = F.array_sort(F.collect_list(F.struct("key_ordinal", "column_name")))  # a handful of columns for each table
    names = F.transform(listed, lambda x: x["column_name"])
    found = index_columns.where("index_type = 1").groupBy("table_name").agg(names.alias("names"))
    return found.select("table_name", F.array_join("names", ",").alias("columns"), (F.col("names") == F.array(*[F.lit(c) for c in CLUSTERED])).alias("in_order"))


CLUSTERED = ["__$start_lsn", "__$command_id", "__$seqval", "__$operation"]


def clustered_index_in_order(columns: list[str]) -> None:
    """A change table must be clustered by the change index, or pages could skip rows."""
    if columns != CLUSTERED:
        raise ValueError(f"a change table's clustered index must be {CLUSTERED}, not {columns}")


def instance_changes(current: DataFrame, new: DataFrame, progress: DataFrame, has_rows: DataFrame) -> DataFrame:
    """For each table whose newest instance is another one, or has other columns: `defer` or `terminate`.

    Ending is put off while the old instance's change table has rows and what was published lies before the new one's start.
    """
    before = current.select("schema_name", "table_name", F.col("capture_instance").alias("old_instance"), F.col("checksum").alias("old_checksum"))
    after = new.select("schema_name", "table_name", F.col("capture_instance").alias("new_instance"), F.col("checksum").alias("new_checksum"), "start_lsn")
    both = before.join(after, ["schema_name", "table_name"]).where((F.col("old_instance") != F.col("new_instance")) | ~F.col("old_checksum").eqNullSafe(F.col("new_checksum")))
    seen = both.join(progress.select("schema_name", "table_name", F.col("lsn").alias("seen_lsn")), ["schema_name", "table_name"], "left").join(has_rows, ["schema_name", "table_name"], "left")
    behind = (F.coalesce("seen_lsn", F.lit("")) < F.col("start_lsn")) & F.coalesce("has_rows", F.lit(False))
    return seen.select("schema_name", "table_name", "old_instance", "new_instance", F.when(behind, "defer").otherwise("terminate").alias("decision"))
