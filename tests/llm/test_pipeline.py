"""The corpus pipeline, stage by stage, against plain implementations over each stage's own input."""

from __future__ import annotations

import pytest

import corpus_pipeline
from changeloom.llm import language_id, quality_rules

from .test_brute_force import brute_components, words

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    out = [docs]
    for _, fn in corpus_pipeline.STAGES:
        out.append(fn(spark, out[-1], SF).cache())
    return out


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_dedup", "packing"]


def test_quality_stage_keeps_what_the_classifier_accepts(spark, stages):
    rated = quality_rules.quality(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    want = {r.doc_id for r in rated.where("predicted = 1").collect()}
    assert {r.doc_id for r in stages[1].collect()} == want and stages[1].columns == stages[0].columns


def test_language_stage(stages):
    model = language_id.learn(stages[1])
    rated, _, score = language_id.with_majority(stages[1], model, ["doc_id"])
    want = {r.doc_id for r in rated.where(f"{score} >= {language_id.learn_cut(stages[1], model)}").collect()}
    assert {r.doc_id for r in stages[2].collect()} == want


def test_near_dedup_stage_keeps_one_of_each_group(stages):
    texts = {r.doc_id: r.text for r in stages[2].collect()}
    _, groups = brute_components(texts)
    assert {r.doc_id for r in stages[3].collect()} == {i for i in texts if groups.find(i) == i}


def test_packing_stage_holds_every_token(stages):
    got = stages[4].toPandas().groupby("doc_id").tokens.sum().to_dict()
    assert got == {r.doc_id: len(words(r.text)) + 1 for r in stages[3].collect()}


def test_run(spark, stages):
    key = ["doc_id", "copy", "piece", "start", "tokens", "shard", "bin", "place"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*key).collect()))
    assert got == sorted(map(tuple, stages[4].select(*key).collect()))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, row long, component_id long, place int, _stat_n_bytes double"
PROSE = "the meeting about the new bridge over the river was moved to the next morning because the engineers needed more time"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(None, PROSE, "en", "s"), (None, PROSE, "en", "s"), (1, None, "en", None), (2, PROSE + " indeed", None, "s"), (2, "an other text stands under the same number and shares no run of words with it", "en", "s"), (3, "", None, "t"), (4, " ".join(f"word{i}" for i in range(60_000)), "en", "t"), (5, "1234 !!", None, "t"), (6, "same words here in this text", "en", "s"), (6, "same words here in this text", "en", "s")]
    return spark.createDataFrame([(*r, 0, 0.5, "zz", 7, 8, 9, 1.5) for r in rows], SCHEMA).cache()


def test_near_dedup_tells_rows_apart_without_ids(spark, odd):
    kept = sorted((r.doc_id or -1, (r.text or "")[:12]) for r in corpus_pipeline.keep_first_of_near_copies(spark, odd, SF).collect())
    assert kept == [(1, ""), (2, "an other tex"), (2, "the meeting "), (3, ""), (4, "word0 word1 "), (5, "1234 !!"), (6, "same words h")]


def test_odd_rows_pass_every_stage(spark, odd):
    docs = odd
    rows = {tuple(r) for r in odd.collect()}
    for name, fn in corpus_pipeline.STAGES[:-1]:
        out = fn(spark, odd, SF)
        assert out.columns == odd.columns and {tuple(r) for r in out.collect()} <= rows, name
        assert fn(spark, docs.where("false"), SF).count() == 0
    packed = corpus_pipeline.pack_bins(spark, odd, SF).toPandas()
    assert packed.groupby(["doc_id", "cluster", "copy"], dropna=False).ngroups == odd.count() and packed[packed.doc_id == 4].tokens.sum() == 60_001
    assert corpus_pipeline.pack_bins(spark, odd.where("false"), SF).count() == 0


def test_language_stage_rejects_letterless_texts(spark, odd):
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.keep_language(spark, odd, SF).collect()}
    assert not {i for i, _ in kept} & {1, 3, 5}


def test_quality_stage_scores_empty_texts_alike(spark, odd):
    ids = [r.doc_id for r in corpus_pipeline.keep_quality(spark, odd, SF).collect()]
    assert (1 in ids) == (3 in ids)
