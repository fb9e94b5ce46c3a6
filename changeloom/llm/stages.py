"""The stages of the corpus pipeline: quality, language, near duplicates, packing.

Each takes (spark, docs, sf_dir) and works on all rows of docs; the first three return the columns of docs, whatever else
stands beside doc_id, text, lang and source, and decide by the operator that they call.

Edge cases, for all stages: an empty table gives an empty result; columns of docs whose names clash with those that a
stage adds are handed through untouched; texts are read whole however long; repeated rows are judged one by one, and of
equal ones near-dedup keeps one. Null and empty texts count as empty: the quality stage scores them like others, the
language stage rejects them (no letter), near-dedup keeps them (they link with nothing), packing gives them one token.
Rows with a null doc_id are judged by their text like all others and never learned from; near-dedup and packing tell rows
apart by a number of their own, so neither null nor shared ids decide what stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import changeloom
from changeloom.llm import language_id, minhash_dedup, packing, quality_rules
from changeloom.llm.common import Workspace, fresh_name


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the classifier's threshold."""
    changeloom.ship(spark)
    model = quality_rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rated, score = quality_rules.with_score(docs, model, docs.columns)
    return rated.where(F.col(score) >= quality_rules.THRESHOLD).drop(score)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model has learned: texts without a letter go, and those in which most passages score below a cut.

    The cut is a low quantile of what clean documents of known language reach; a passage in another language rejects nothing.
    """
    changeloom.ship(spark)
    model = language_id.learn(docs)
    rated, lang, score = language_id.with_majority(docs, model, docs.columns)
    return rated.where(F.col(score) >= language_id.learn_cut(docs, model)).drop(lang, score)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id (null ids last)."""
    changeloom.ship(spark)
    ws, row = Workspace(spark, "near"), fresh_name(docs.columns, "row")
    # Rows are numbered once and written, so that a number stands for the same row whatever is computed again.
    rows = ws.table(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    groups = minhash_dedup.near_duplicates(rows.select(F.col(row).alias("doc_id"), F.col("text").alias("text")))
    ids = rows.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = groups.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row").groupBy("component_id").agg(F.min(rank).alias("first"))
    return rows.join(kept.select(F.col("first.row").alias(row)), row, "left_semi").select(docs.columns)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document is packed."""
    changeloom.ship(spark)
    return packing.pack(docs)
