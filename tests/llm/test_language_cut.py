"""The language stage's cut is the quantile of all correct held-out documents, however many there are."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeloom.llm import language_id

SF = "/root/testdata/sf0.1"


def test_the_cut_covers_all_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.learn(docs)
    # Copies under other ids: over 7000 held-out documents, of which the later ones are cut short and score less.
    shorter = F.when(F.col("copy") == 0, F.col("text")).otherwise(F.substring("text", 1, 8))
    many = docs.crossJoin(spark.range(3).withColumnRenamed("id", "copy")).select((F.col("doc_id") + F.col("copy") * 10**6).alias("doc_id"), shorter.alias("text"), "lang")
    held = many.where(F.col("lang").isNotNull() & language_id.held_out(F.col("doc_id"), language_id.MODULUS, language_id.REMAINDER))
    rated, lang, score = language_id.with_majority(held, model, ["lang"])
    scores = [r[0] for r in rated.where(F.col(lang) == F.col("lang")).select(score).collect()]
    assert len(scores) > 7000
    assert language_id.learn_cut(many, model) == np.quantile(scores, language_id.CUT_QUANTILE, method="lower")


def test_a_letterless_text_labelled_as_unknown_sets_no_cut(spark):
    docs = spark.createDataFrame([(i, "12 34", language_id.UNKNOWN) for i in range(2000)], "doc_id long, text string, lang string")
    assert language_id.learn_cut(docs, language_id.LanguageModel()) == 0.0


@pytest.mark.parametrize("kind", ["spread", "ties", "close"])
def test_value_at(spark, kind):
    rng = random.Random(3)
    make = {"spread": rng.random, "ties": lambda: rng.choice([0.0, 0.25, 1.0]), "close": lambda: rng.choice([0.5, 0.5 + 2**-52, 0.5 + 2**-50, 1e-300, 5e-324, 1.0])}[kind]
    values = [make() for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "x double").cache()
    for place in (0, 1, 700, 1500, 2999):
        assert language_id.value_at(frame, "x", place) == sorted(values)[place]
