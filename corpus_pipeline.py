"""A corpus pipeline: quality, language, near duplicates, packing (`changeloom/llm/stages.py`).

Each stage works on all that the one before kept, written as Parquet in the shared folder and read again. The first
three return the columns of documents; the last returns where each piece of each document is packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeloom.llm.common import Workspace
from changeloom.llm.stages import keep_first_of_near_copies, keep_language, keep_quality, pack_bins

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_dedup", keep_first_of_near_copies),
    ("packing", pack_bins),
]

#: SQL can express none of the learned stages; `tests/llm/test_pipeline.py` holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.table(stage(spark, docs, sf_dir), name)
    return ws.table(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
