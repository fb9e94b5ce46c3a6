"""Progress operators: the compacted log of what was published, resets, heartbeats and the snapshot log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import CHANGE_ROWS, HIGHEST_TEXT, INDEX_COLUMNS, MAX_COMMAND_ID, POST_UPDATE, SNAPSHOT
from changeloom.sources.work import numbered


def latest(log: DataFrame, key: list[str], present: str, offset: str = "msg_offset") -> DataFrame:
    """The last entry of each key; a last entry whose `present` column is null has deleted the key."""
    rest = [c for c in log.columns if c not in key]
    last = log.groupBy(*key).agg(F.max_by(F.struct(*rest), offset).alias("x"))
    return last.where(F.col(f"x.{present}").isNotNull()).select(*key, "x.*")


def per_topic(messages: DataFrame) -> DataFrame:
    """What a batch of messages moves progress to: the highest change index of each topic."""
    changes = messages.where(F.col("operation").isNotNull() & (F.col("operation") != SNAPSHOT))
    top = changes.groupBy("topic").agg(F.max(X.index()).alias("idx"), F.count("*").alias("n"))
    return top.select("topic", F.lit(CHANGE_ROWS).alias("progress_kind"), *[F.col(f"idx.{c}").alias(c) for c in INDEX_COLUMNS], "n")


def snapshot_per_topic(messages: DataFrame, key: list[str]) -> DataFrame:
    """Snapshots run downwards, so their progress is the least key of each topic."""
    rows = messages.where(F.col("operation") == SNAPSHOT)
    low = rows.groupBy("topic").agg(F.min(X.key_struct(key)).alias("k"))
    return low.select("topic", F.lit("snapshot_rows").alias("progress_kind"), *[F.col(f"k.{c}").alias(c) for c in key])


def heartbeats(topics: DataFrame, moved: DataFrame, ceiling_lsn: str) -> DataFrame:
    """Progress for topics without a row in a batch: everything up to the ceiling has been seen there too."""
    idle = topics.join(moved.select("topic"), "topic", "left_anti")
    return idle.select("topic", F.lit(CHANGE_ROWS).alias("progress_kind"), F.lit(ceiling_lsn).alias("lsn"), F.lit(MAX_COMMAND_ID).alias("command_id"), F.lit(HIGHEST_TEXT).alias("seqval"), F.lit(POST_UPDATE).alias("operation"))


def reset_plan(requests: DataFrame, current: DataFrame) -> DataFrame:
    """For each requested (topic_name, progress_kind): whether there is progress to reset."""
    known = current.select("topic_name", "progress_kind", F.lit(True).alias("_known"))
    return requests.join(known, ["topic_name", "progress_kind"], "left").select("topic_name", "progress_kind", F.when(F.col("_known"), "reset").otherwise("no progress").alias("action"))


def with_resets(log: DataFrame, plan: DataFrame, first_offset: int, offset: str = "msg_offset") -> DataFrame:
    """The log with an entry without a value for each reset; a plan is small, so its order needs no care for size."""
    resets = numbered(plan.where("action = 'reset'").select("topic_name", "progress_kind"), [F.col("topic_name"), F.col("progress_kind")], offset, first_offset)
    return log.unionByName(resets.withColumn(offset, F.col(offset).cast(log.schema[offset].dataType)), allowMissingColumns=True)


def snapshot_event(log: DataFrame) -> DataFrame:
    """One row for each logged event, its partitions' watermarks as text in the order of partitions."""
    marks = F.array_sort(F.collect_list(F.struct("partition_id", "high_watermark")))
    text = F.array_join(F.transform(marks, lambda m: F.concat(m["partition_id"].cast("string"), F.lit("="), m["high_watermark"].cast("string"))), ",")
    return log.groupBy("msg_offset", "topic_name", "action").agg(text.alias("watermarks"))
