"""Topic logs as tables: full, bounded, timed and resumed reads, and watermarks.

A topic log has topic, partition_id, msg_offset and the message; written by `topic` and `partition_id` folders, a read of
one topic touches only its files. A broker's reader takes the same bounds as options.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.functions import expr as X


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write(messages: DataFrame, path: str, mode: str = "append") -> None:
    messages.write.mode(mode).partitionBy("topic", "partition_id").parquet(path)


def watermarks(log: DataFrame) -> DataFrame:
    """For each partition the first offset and the one after the last."""
    return log.groupBy("topic", "partition_id").agg(F.min("msg_offset").alias("low"), (F.max("msg_offset") + 1).alias("high"), F.count("*").alias("messages"))


def bounded(log: DataFrame, marks: DataFrame, most: int) -> DataFrame:
    """About the last `most` messages of a topic: each partition from its share before the end, up to but without `high`.

    Watermarks are one row for each partition, so they may be broadcast.
    """
    shares = marks.groupBy("topic").agg(F.count("*").alias("_parts"))
    starts = marks.join(F.broadcast(shares), "topic").select("topic", "partition_id", F.greatest("low", F.col("high") - F.expr(f"{int(most)} div _parts")).alias("_from"), F.col("high").alias("_to"))
    return log.join(F.broadcast(starts), ["topic", "partition_id"]).where((F.col("msg_offset") >= F.col("_from")) & (F.col("msg_offset") < F.col("_to"))).drop("_from", "_to")


def since(log: DataFrame, at_column: str, at) -> DataFrame:
    """From the first offset of each partition whose time is not before `at`; the whole partition where there is none."""
    first = log.groupBy("topic", "partition_id").agg(F.min(F.when(F.col(at_column) >= at, F.col("msg_offset"))).alias("_from"))
    return log.join(F.broadcast(first), ["topic", "partition_id"]).where(F.col("_from").isNull() | (F.col("msg_offset") >= F.col("_from"))).drop("_from")  # one row for each partition


def starting_offsets(done: dict[tuple[str, int], int], partitions: dict[str, int]) -> str:
    """The option of a broker's reader that resumes after recorded offsets; -2 stands for a partition's beginning."""
    return json.dumps({t: {str(p): done[t, p] + 1 if (t, p) in done else -2 for p in range(n)} for t, n in sorted(partitions.items())})


def broker_options(bootstrap: str, topics: list[str], starting: str = "earliest", ending: str = "latest", **extra: str) -> dict[str, str]:
    """Options of a broker's batch reader. Headers are asked for, as they carry message types and original topics."""
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": ",".join(topics), "startingOffsets": starting, "endingOffsets": ending, "includeHeaders": "true", **extra}


def broker_rows(messages: DataFrame) -> DataFrame:
    """Messages as a broker's writer takes them: its own columns only, headers as an array of names and bytes."""
    headers = F.transform(F.map_entries("headers"), lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")))
    return messages.select("topic", "key", "value", "partition_id", headers.alias("headers")).withColumnRenamed("partition_id", "partition")


def write_broker(messages: DataFrame, bootstrap: str, transactional_id: str | None = None, **extra: str) -> None:
    """Sends messages (topic, partition_id, key, value, headers) in order of their partitions; a full buffer is waited for, not an error."""
    options = {"kafka.bootstrap.servers": bootstrap, "kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.linger.ms": "200", "kafka.compression.type": "snappy", "kafka.max.block.ms": "120000", "includeHeaders": "true"}
    if transactional_id:
        options["kafka.client.id"] = transactional_id
    _connected(lambda: broker_rows(messages).write.format("kafka").options(**options | extra).save())


def _connected(run):
    """What `run` gives; says so where the connector isn't on the class path."""
    try:
        return run()
    except Exception as e:
        if "Failed to find data source" in str(e) or "DATA_SOURCE_NOT_FOUND" in str(e):
            raise RuntimeError("the broker connector isn't on the class path (spark.jars.packages)") from e
        raise


def read_broker(spark: SparkSession, **options: str) -> DataFrame:
    """Reads a broker where its connector is on the class path; says so where it isn't."""
    return _connected(lambda: spark.read.format("kafka").options(**options).load())


def parse_names(topics: DataFrame, pattern: str) -> DataFrame:
    """Schema and table names from topic names by a pattern with two groups; other topics are left out."""
    matched = topics.where(X.matches_start(F.col("topic"), pattern))
    return matched.select("topic", F.regexp_extract("topic", pattern, 1).alias("schema_name"), F.regexp_extract("topic", pattern, 2).alias("table_name"))
