"""Reports over the snapshot log: history, completion, and which topics need truncation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_actions(log: DataFrame) -> DataFrame:
    """For each topic the offsets of its last start and last completion."""
    at = lambda action: F.max(F.when(F.col("action") == action, F.col("msg_offset")))
    return log.groupBy("topic_name").agg(at("started").alias("started_at"), at("completed").alias("completed_at"))


def completion_state(log: DataFrame) -> DataFrame:
    """Whether a completion has been logged since the last start."""
    return last_actions(log).select("topic_name", F.coalesce(F.col("completed_at") > F.col("started_at"), F.col("completed_at").isNotNull()).alias("complete"))


def _last_marks(log: DataFrame, action: str) -> DataFrame:
    rows = log.where(F.col("action") == action)
    return rows.groupBy("topic_name", "partition_id").agg(F.max_by("high_watermark", "msg_offset").alias("mark"))


def truncation(log: DataFrame, low_watermarks: DataFrame) -> DataFrame:
    """For each partition whether messages from before the last complete snapshot can go."""
    starts = _last_marks(log, "started").withColumnRenamed("mark", "start_mark")
    ends = _last_marks(log, "completed").withColumnRenamed("mark", "completion_mark")
    both = starts.join(low_watermarks, ["topic_name", "partition_id"]).join(ends, ["topic_name", "partition_id"], "left")
    verdict = F.when(F.col("completion_mark").isNull() | (F.col("completion_mark") < F.col("start_mark")), "!NOT COMPLETE!").when(F.col("low_watermark") >= F.col("start_mark"), "No").otherwise("Yes")
    return both.select("topic_name", "partition_id", "start_mark", "completion_mark", "low_watermark", verdict.alias("needs_truncation"))


def history(log: DataFrame, low_watermarks: DataFrame) -> DataFrame:
    """For each topic with a start: whether it begins exactly there in all partitions, and whether that snapshot is complete."""
    starts = _last_marks(log, "started")
    begins = starts.join(low_watermarks, ["topic_name", "partition_id"], "left").groupBy("topic_name").agg(F.min(F.coalesce(F.col("low_watermark") == F.col("mark"), F.lit(False))).alias("begins_at_snapshot"))
    return begins.join(completion_state(log), "topic_name")


def truncation_commands(report: list[tuple[str, int, int]], bootstrap: str) -> str:
    """A shell script that deletes records before the given offsets: (topic, partition, offset). Driver-side text."""
    lines = ["#!/bin/sh", "set -e"]
    for topic in sorted({t for t, _, _ in report}):
        parts = ",".join(f'{{"topic":"{t}","partition":{p},"offset":{o}}}' for t, p, o in sorted(report) if t == topic)
        lines.append(f"printf '%s' '{{\"version\":1,\"partitions\":[{parts}]}}' > /tmp/delete-{topic}.json")
        lines.append(f"kafka-delete-records --bootstrap-server {bootstrap} --offset-json-file /tmp/delete-{topic}.json")
    return "\n".join(lines) + "\n"
