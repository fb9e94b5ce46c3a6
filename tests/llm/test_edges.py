"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.llm import embedding_dedup, language_id, license_scan, lm_scoring, minhash_dedup, order_minhash, packing, quality_rules, sentencepiece, warc
from changeloom.llm.queries import PIECES

SCHEMA = "doc_id long, text string, lang string, source string, score double, lang_pred string, predicted int, n_chars long"
LONG = "word " * 60_000 + "end"
PROSE = "the quick brown fox jumps over the lazy dog and runs away from the big bad wolf"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, 0.5, "zz", 9, 1) for i, t, lang, src in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, PROSE, "en", "a"), (2, None, "en", "a"), (3, "", None, "a"), (4, LONG, "en", None), (5, PROSE, "en", "a"), (5, PROSE, "en", "a"), (None, "der hund und die katze sind im haus", "de", "a"), (7, " \t\n ", "de", "b"), (8, "12345 !!!", None, "b"), (9, "le chat et le chien sont dans la maison", "fr", "b"), (10, "x", "es", "b"), (11, "ß€😀 " * 10, None, "b")]
    return documents(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, []).select(*[f.split()[0] for f in SCHEMA.split(", ")])


def test_license_scan(spark, docs, empty):
    mit = next(t.text for t in license_scan.TEMPLATES if t[:2] == ("MIT", "text"))
    text = "intro words\n" + mit + "\nReleased under the MIT License. and later Released under the MIT License."
    extra = documents(spark, [(20, text, "en", "a"), (None, "Licensed under CC BY-NC 4.0.", "en", "a"), (21, "x " * 50_000 + "Released under the MIT License", "en", "a"), (22, "Released under the ISC License", "en", "a"), (22, "Released under the ISC License", "en", "a")])
    got = sorted(((r.doc_id or -1, r.occurrence, r.license, r.form) for r in license_scan.scan(docs.unionByName(extra)).collect()))
    assert got == [(-1, 0, "CC-BY-NC-4.0", "line"), (20, 0, "MIT", "text"), (20, 1, "MIT", "line"), (20, 2, "MIT", "line"), (21, 0, "MIT", "line"), (22, 0, "ISC", "line"), (22, 0, "ISC", "line")]
    assert license_scan.scan(empty).count() == 0


def test_packing(docs, empty):
    got = packing.pack(docs, capacity=100).toPandas()
    assert sorted(got.groupby("doc_id").tokens.sum().items())[:3] == [(1, 18), (2, 1), (3, 1)]
    assert got[got.doc_id == 4].tokens.sum() == 60_002
    assert sorted(got[got.doc_id == 5]["copy"]) == [0, 1]
    assert got.doc_id.isna().sum() == 1
    assert packing.pack(empty).count() == 0


def test_embedding(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1), (7, [float("nan"), 1.0], 1), (8, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [1.0, 0.0], 1), (10, [1.0, 0.0], 1)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")).collect()
    by = sorted((r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in got)
    assert len(got) == len(rows)
    assert (1, 3, 1, True) in by and by.count((10, 3, 1, False)) == 2 and (2, 3, 1, False) in by and (2, 0, 2, True) in by
    assert all((i, 0, i, True) in by for i in (3, 4, 5, 6, 7, 8, 9))
    assert (-1, 0, None, False) in sorted(by, key=str)
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    signed = [(-(2**63), [1.0, 0.0]), (-5, [1.0, 0.01]), (3, [1.0, 0.02]), (2**63 - 1, [0.0, 1.0]), (0, [0.01, 1.0])]
    got = embedding_dedup.near_vectors(spark.createDataFrame(signed, "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.component_id for r in got} == {-(2**63): -(2**63), -5: -(2**63), 3: -(2**63), 2**63 - 1: 0, 0: 0}


def test_minhash(docs, empty):
    got = minhash_dedup.near_duplicates(docs).collect()
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got}
    assert len(got) == docs.count()
    assert by[1] == (13, 1, True) and by[5] == (13, 1, False) and by[2] == (0, 2, True) and by[3] == (0, 3, True) and by[7] == (0, 7, True)
    assert by[4][0] == 2 and by[10] == (1, 10, True) and by[None] == (4, None, False)
    assert minhash_dedup.near_duplicates(empty).count() == 0


def test_language(docs, empty):
    got = {r.doc_id: r for r in language_id.languages(docs).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (2, 3, 7, 8))
    assert got[1].lang_pred in ("en", "de", "fr", "es") and got[11].lang_pred != "und"  # the sharp s is a letter
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.languages(empty).count() == 0
    assert {r.lang_pred for r in language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_fingerprints(spark, docs, empty):
    got = order_minhash.fingerprints(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == by[5].fingerprint and by[2].fingerprint == by[3].fingerprint
    assert by[3].near_next == 1.0 and by[None].near_next == 0 and by[4].n_chars == 300_003
    assert order_minhash.fingerprints(empty).count() == 0
    alone = order_minhash.fingerprints(documents(spark, [(1, "abcdef", "en", "a")])).first()
    assert alone.near_next == 1.0 and alone.n_chars == 6
    nulls = order_minhash.fingerprints(documents(spark, [(None, "abc", "en", "a")])).first()
    assert nulls.doc_id is None and nulls.n_chars == 3


def test_lm(docs, empty):
    got = lm_scoring.lm_scores(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == docs.count() and by[2].n_tokens == 1 and by[3].n_tokens == 1 and by[4].n_tokens == 60_002
    assert all(r.score < 0 and r.base_score < 0 for r in got)
    assert lm_scoring.lm_scores(empty).count() == 0


def test_warc(spark):
    same, small = "<p>" + "x" * 200, "<p>"
    rows = [(3, "http://a/ b\n", same, 1), (1, None, same, 1), (2, "http://a/", None, 1), (None, "u", same, 1), (4, "u", small, 1), (5, "u", small, 1), (1, None, same, 1), (6, "u", "", 1), (7, "ü" * 5000, "ß" * 100_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    got = sorted(((r.page_id or -1, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archived(pages).collect()), key=str)
    assert got == sorted([(3, 203, "revisit", 1), (1, 203, "response", None), (1, 203, "response", None), (2, 0, "response", None), (-1, 203, "response", None), (4, 3, "response", None), (5, 3, "response", None), (6, 0, "response", None), (7, 200_000, "response", None)], key=str)
    assert warc.archived(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_sentencepiece(docs, empty):
    encoded = sentencepiece.encode(docs, PIECES)
    assert "ids" in encoded.columns and encoded.where("doc_id = 2").first().ids is None and encoded.where("doc_id = 3").first().ids == []
    back = sentencepiece.decode(encoded, PIECES).collect()
    assert all(r.decoded == r.text for r in back)
    assert all(r.round_trip for r in sentencepiece.digests(docs, PIECES).collect())
    assert sentencepiece.digests(empty, PIECES).count() == 0 and sentencepiece.encode(empty, PIECES).count() == 0
    clash = docs.select("doc_id", "text", F.lit(1).alias("ids"), F.lit(2).alias("Decoded"))
    again = sentencepiece.encode(clash, PIECES)
    assert again.columns == ["doc_id", "text", "ids", "Decoded", "_ids", "ids_score"]
    assert "_decoded" in sentencepiece.decode(again, PIECES, "_ids").columns


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 0), (9, None, 0), (None, 1, 0), (10, 0, 1)], "doc_id long, quality int, toxic int")
    got = quality_rules.quality(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    none = quality_rules.quality(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_rules.quality(empty, labels).count() == 0


def test_results_have_their_own_columns_only(spark, docs):
    """Columns of the input with the names of results (score, lang_pred, predicted, n_chars) don't come through."""
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, 1), (10, 0)], "doc_id long, quality int")
    assert lm_scoring.lm_scores(docs).columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert quality_rules.quality(docs, labels).columns == ["doc_id", "held_out", "score", "predicted"]
    assert language_id.languages(docs).columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert order_minhash.fingerprints(docs).columns == [f.split()[0] for f in order_minhash.FIELDS.split(", ")]
    assert minhash_dedup.near_duplicates(docs.withColumn("kept", F.lit(1)).withColumn("rep", F.lit(2))).columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_equal_texts_get_equal_results(spark, docs):
    """Rows 1 and 5 (twice) hold the same text."""
    labels = spark.createDataFrame([(1, 1), (4, 0), (9, 1), (10, 0)], "doc_id long, quality int")
    for frame, column in ((lm_scoring.lm_scores(docs), "score"), (quality_rules.quality(docs, labels), "score"), (language_id.languages(docs), "score"), (order_minhash.fingerprints(docs), "fingerprint")):
        found = [r[column] for r in frame.where("doc_id IN (1, 5)").collect()]
        assert len(found) == 3 and len(set(found)) == 1


def test_packing_of_many_copies_and_ties(spark):
    one = documents(spark, [(1, "same few words", "en", "a"), (2, "other few words", "en", "a"), (3, "", "en", "b")])
    rows = one.crossJoin(spark.range(9000).select()).unionByName(one)  # each row 9001 times
    got = packing.pack(rows, capacity=64).toPandas()
    assert len(got) == 3 * 9001 and got.groupby("doc_id")["copy"].nunique().tolist() == [9001] * 3
    assert got.groupby(["shard", "bin"]).tokens.sum().max() <= 64
    assert not got.assign(c=got.cluster.map(bytes)).duplicated(["shard", "bin", "c"]).any()
    again = packing.pack(rows, capacity=64).toPandas()
    key = ["doc_id", "copy", "shard", "bin", "place"]
    assert sorted(map(tuple, got[key].to_numpy())) == sorted(map(tuple, again[key].to_numpy()))


def test_minhash_of_repeated_rows_and_shared_ids(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(7, text, None, None)] * 50 + [(8, text + " eleven", None, None)] * 50 + [(9, "a b c d e f g", None, None), (9, "q r s t u v w", None, None), (10, "q r s t u v w", None, None), (11, "a b c d e f g", None, None)]
    got = {(r.doc_id, r.component_id, r.kept) for r in minhash_dedup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(7, 7, True), (8, 7, False), (9, 9, True), (10, 9, False), (11, 9, False)}


def test_minhash_ties_at_the_threshold(spark):
    """Sets of 7 that share 6 (6 of 8), and of 6 that share 5 (5 of 7)."""
    words = [f"w{i}" for i in range(50)]
    rows = documents(spark, [(1, " ".join(words[:11]), None, None), (2, " ".join([*words[:10], "x"]), None, None), (3, " ".join(words[20:30]), None, None), (4, " ".join([*words[20:29], "x"]), None, None)])
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(rows).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_a_cluster_without_checkpoint_folder_is_refused(spark, monkeypatch):
    from types import SimpleNamespace

    from changeloom.llm import common

    class Fake:
        conf = SimpleNamespace(get=lambda key, default=None: None)
        sparkContext = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False))))

    with pytest.raises(RuntimeError, match="checkpoint"):
        common.shared_dir(Fake())
