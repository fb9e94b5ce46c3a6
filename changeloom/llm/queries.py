"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table.

`ORACLES` holds DuckDB SQL for those that SQL can express; the others are tested against brute force in `tests/llm`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from changeloom.llm import embedding_dedup, language_id, license_scan, lm_scoring, minhash_dedup, order_minhash, packing, quality_rules, sentencepiece, warc

#: A public vocabulary; no copy of it is in the repository.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.languages(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str, model: str = PIECES) -> DataFrame:
    return sentencepiece.digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), model)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_minhash_near_dedup": op4_minhash_near_dedup,
    "op5_language_id": op5_language_id,
    "op6_order_minhash": op6_order_minhash,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_warc": op8_warc,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_quality_classifier": op10_quality_classifier,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES: dict[str, str] = {
    "op3_embedding_near_dedup": """WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
r(vec_id, c) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
m AS (SELECT vec_id, min(c) AS c FROM r GROUP BY vec_id), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT m.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, m.c AS component_id, m.vec_id = m.c AS kept FROM m LEFT JOIN n ON n.a = m.vec_id""",
    "op4_minhash_near_dedup": f"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) >= 5 THEN array_to_string(w[i:i+4], ' ') ELSE array_to_string(w, ' ') END AS g FROM (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)) AS i FROM w) x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id)
SELECT m.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, m.c AS component_id, m.doc_id = m.c AS kept FROM m LEFT JOIN n ON n.doc_id = m.doc_id""",
    "op8_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d FROM p),
f AS (SELECT d, min(page_id) AS f FROM q WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, q.d AS payload_digest, CASE WHEN f < page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN f < page_id THEN f END AS refers_to FROM q LEFT JOIN f ON f.d = q.d AND n >= 100""",
}
