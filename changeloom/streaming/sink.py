"""An idempotent sink: a batch's messages, of however many topics, and progress become visible together, once.

A batch writes its files below its own id, replacing what an earlier attempt at the same id left, and then a marker, which
may hold a note. Batches are committed in order, so readers take all up to the highest marker. A batch that is run again
after a failure ends up the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def is_committed(spark: SparkSession, path: str, batch_id: int) -> bool:
    fs, where = _fs(spark, f"{path}/commits/{batch_id}")
    return fs.exists(where)


def commit(tables: dict[str, DataFrame], path: str, batch_id: int, note: str = "") -> None:
    """Writes the batch's tables, then its marker; does nothing where the marker is there."""
    spark = next(iter(tables.values())).sparkSession
    if is_committed(spark, path, batch_id):
        return
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
    fs, where = _fs(spark, f"{path}/commits/_{batch_id}")
    out = fs.create(where, True)
    if note:
        out.write(bytearray(note.encode()))
    out.close()
    fs.rename(where, _fs(spark, f"{path}/commits/{batch_id}")[1])  # a marker is there whole or not at all


def committed(spark: SparkSession, path: str) -> list[int]:
    fs, where = _fs(spark, f"{path}/commits")
    if not fs.exists(where):
        return []
    names = (x.getPath().getName() for x in fs.listStatus(where))
    return sorted(int(n) for n in names if n.isdigit())


def once(spark: SparkSession, path: str, text: str) -> str:
    """The text of a file that is written only where it isn't there yet."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        out = fs.create(where, False)
        out.write(bytearray(text.encode()))
        out.close()
    return _text(spark, path)


def note(spark: SparkSession, path: str, batch_id: int) -> str:
    """What the commit of a batch noted."""
    return _text(spark, f"{path}/commits/{batch_id}")


def _text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    source = fs.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def read(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """The rows of a table in committed batches, with their batch_id; None before the first commit or where no batch has the table."""
    done = committed(spark, path)
    fs, where = _fs(spark, f"{path}/{name}")
    if not done or not fs.exists(where):
        return None
    return spark.read.parquet(f"{path}/{name}").where(F.col("batch_id") <= done[-1])
