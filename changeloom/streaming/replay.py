"""A stream of messages folded into a table that is kept in buckets of keys.

A batch reads and writes only the buckets that its keys are in. The commit's note says which version of each bucket
counts; versions that an earlier commit has replaced are dropped with the next one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom.operators import replay
from changeloom.sources.work import remove
from changeloom.streaming import sink

BUCKETS = 64


def _versions(spark: SparkSession, out: str) -> dict[int, int]:
    """The batch that holds each bucket."""
    done = sink.committed(spark, out)
    return {int(k): v for k, v in json.loads(sink.note(spark, out, done[-1]))["buckets"].items()} if done else {}


def _read(spark: SparkSession, out: str, versions: dict[int, int], schema=None) -> DataFrame | None:
    paths = [f"{out}/table/batch_id={v}/bucket={k}" for k, v in sorted(versions.items())]
    reader = spark.read.option("basePath", f"{out}/table")
    return (reader.schema(schema) if schema else reader).parquet(*paths) if paths else None


def replay_stream(messages: DataFrame, out: str, checkpoint: str, key: list[str], columns: list[str], order: Column, skip: list[str] | None = None, buckets: int = BUCKETS, every: str | None = None) -> StreamingQuery:
    """Each batch applies its messages, ordered by `order`, to the buckets of their keys; `buckets` is for good."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if sink.is_committed(spark, out, batch_id):
            return
        touched = {r[0] for r in batch.select(bucket.alias("b")).distinct().collect()}  # at most `buckets` numbers
        versions = _versions(spark, out)
        before = {k: v for k, v in versions.items() if k in touched}
        target = _read(spark, out, before)
        target = None if target is None else target.where("_live").drop("_live", "batch_id", "bucket")
        new = replay.apply(target, batch.withColumn("msg_offset", order), key, columns, skip)
        # Every bucket that was touched gets a version, if only an empty one: a row of nulls marks it.
        rows = new.withColumn("bucket", bucket).withColumn("_live", F.lit(True))
        marks = spark.createDataFrame([(b, False) for b in sorted(touched)] or [(0, False)], "bucket int, _live boolean")
        rows = rows.unionByName(marks, allowMissingColumns=True)
        path = f"{out}/table/batch_id={batch_id}"
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        gone = [f"{out}/table/batch_id={v}/bucket={k}" for k, v in before.items()]
        done = sink.committed(spark, out)
        stale = json.loads(sink.note(spark, out, done[-1]))["gone"] if done else []
        sink.commit({"touched": marks}, out, batch_id, json.dumps({"buckets": versions | dict.fromkeys(touched, batch_id), "gone": gone}))
        for x in stale:
            remove(spark, x)

    writer = messages.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def current_table(spark: SparkSession, out: str) -> DataFrame | None:
    found = _read(spark, out, _versions(spark, out))
    return None if found is None else found.where("_live").drop("_live", "batch_id", "bucket")


