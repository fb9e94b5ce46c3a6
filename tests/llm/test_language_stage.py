"""The language stage rejects by the machines' decision, and keeps clean texts with a foreign passage."""

from __future__ import annotations

import random

import pytest
import corpus_pipeline

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def kept(spark):
    rng = random.Random(4)
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang IS NOT NULL AND length(text) > 2000").limit(2500)
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
    other = {lang: next(t for _, t, other in rows if other != lang) for lang in {r[2] for r in rows}}
    mixed = [(10**7 + k, t[: len(t) // 2] + " " + other[lang][: len(t) // 5] + " " + t[len(t) // 2 :], None) for k, (_, t, lang) in enumerate(rows[:300])]
    junk = [(2 * 10**7 + k, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(300)), None) for k in range(300)]
    frame = spark.createDataFrame(rows + mixed + junk, "doc_id long, text string, lang string").repartition(8).cache()
    return len(rows), {r.doc_id for r in corpus_pipeline.keep_language(spark, frame, SF).collect()}


def test_letters_without_a_language_go(kept):
    assert sum(i >= 2 * 10**7 for i in kept[1]) < 150


def test_clean_texts_stay(kept):
    n, ids = kept
    assert sum(i < 10**7 for i in ids) >= 0.99 * n
    assert sum(10**7 <= i < 2 * 10**7 for i in ids) >= 0.98 * 300


def test_without_a_learned_language_only_letterless_texts_go(spark):
    rows = [(1, "a text in some language", None), (2, "123 456 !!", None), (3, None, None), (4, "\u0434\u0430", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.keep_language(spark, docs, SF).collect()} == {1, 4}
