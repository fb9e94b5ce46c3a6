"""Replay: folding a change topic into a table, resumable by partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.model import DELETE


def latest_per_key(messages: DataFrame, key: list[str], offset: str = "msg_offset") -> DataFrame:
    """The last message of each key. A key's messages are all in one partition, so offsets order them.

    An aggregate, not a window: map tasks reduce first, so a key with very many messages meets in no task.
    """
    rest = [c for c in messages.columns if c not in key]
    return messages.groupBy(*key).agg(F.max_by(F.struct(*rest), offset).alias("x")).select(*key, "x.*")


def split(latest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes): a last message that is a delete or a tombstone removes its key."""
    gone = F.col("operation").isNull() | (F.col("operation") == DELETE)
    return latest.where(~gone), latest.where(gone)


def without_deleted(target: DataFrame, deletes: DataFrame, key: list[str]) -> DataFrame:
    return target.join(deletes.select(*key), key, "left_anti")


def upserted(target: DataFrame, upserts: DataFrame, key: list[str]) -> DataFrame:
    """The target with rows replaced or added by key."""
    return target.join(upserts.select(*key), key, "left_anti").unionByName(upserts.select(*target.columns))


def apply(target: DataFrame | None, messages: DataFrame, key: list[str], columns: list[str], skip: list[str] | None = None) -> DataFrame:
    """The target after a batch of messages. Columns named in `skip` (whatever their case) aren't kept up."""
    left_out = {c.lower() for c in skip or []}
    kept = [c for c in columns if c.lower() not in left_out]
    upserts, deletes = split(latest_per_key(messages, key))
    if target is None:
        return upserts.select(*kept)
    return upserted(without_deleted(target.select(*kept), deletes, key), upserts.select(*kept), key)


def progress(messages: DataFrame) -> DataFrame:
    """The last offset of each partition that a batch has reached."""
    return messages.groupBy("topic", "partition_id").agg(F.max("msg_offset").alias("last_offset"))


def merged_progress(before: DataFrame, batch: DataFrame) -> DataFrame:
    return before.unionByName(batch).groupBy("topic", "partition_id").agg(F.max("last_offset").alias("last_offset"))


def resume_from(messages: DataFrame, done: DataFrame) -> DataFrame:
    """Messages after the recorded offset of their partition; all of a partition without one."""
    seen = done.select("topic", "partition_id", F.col("last_offset").alias("_seen"))
    return messages.join(seen, ["topic", "partition_id"], "left").where(F.col("_seen").isNull() | (F.col("msg_offset") > F.col("_seen"))).drop("_seen")
