"""Tables in the folder that driver and executors share, and rows numbered in a total order."""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a temporary folder of this machine only for a local master without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="changeloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


_open = threading.local()


@contextmanager
def scoped(spark: SparkSession) -> Iterator[None]:
    """Tables that `cut` writes in this thread go at the end: a long run must not fill the shared folder."""
    _open.scopes = [*getattr(_open, "scopes", []), []]
    try:
        yield
    finally:
        *_open.scopes, own = _open.scopes
        for path in own:
            remove(spark, path)


def cut(df: DataFrame, name: str = "table") -> DataFrame:
    """The rows written to the shared folder and read again: later plans don't repeat the work. Goes when the driver ends, or the scope around it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/changeloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    scopes = getattr(_open, "scopes", [])
    if scopes:
        scopes[-1].append(path)
    else:
        atexit.register(remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str = "pos", start: int = 1) -> DataFrame:
    """Rows with their place in a total order, without one task sorting them all.

    Ranges are sorted side by side and written; a row's place is the number of rows in the ranges before plus its own in
    its range. Only one count for each range comes to the driver.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # The id's upper bits are the partition, its lower 33 the row's place there.
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    ranged = cut(ranged.withColumn("_part", F.shiftright("_id", 33).cast("int")).withColumn("_place", F.col("_id").bitwiseAND(2**33 - 1)).drop("_id"), "numbered")
    offsets, total = [], start
    for part, n in sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        offsets.append((part, total))
        total += n
    # One row for each shuffle partition: bounded, so it may be broadcast.
    small = F.broadcast(spark.createDataFrame(offsets or [(0, start)], "_part int, _start long"))
    return ranged.join(small, "_part").withColumn(name, F.col("_start") + F.col("_place")).drop("_part", "_place", "_start")
