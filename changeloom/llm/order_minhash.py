"""Operator 6: document fingerprints by order MinHash.

Each run of `K` code points of a text is numbered by how often it has occurred before in the text; the pair is hashed.
For each of `SKETCHES` orders of the hash values the `LENGTH` smallest pairs are selected, put back in text order, and
their tuple is hashed: a moved or edited passage changes which pairs are smallest or how they are ordered, so the share
of equal tuples follows the edit distance, not only the sets. The orders are rotations of one random order: sketch j ranks
values by their distance above j/SKETCHES of the hash range, so one sort of a text's values serves all sketches.

Edge cases: a null text counts as empty; the empty text's fingerprint is all zeros, and two empty texts are alike (1.0).
A text shorter than K is one run; one with fewer than LENGTH runs has shorter tuples. Documents follow one another by
descending doc_id, rows that repeat a doc_id by text; after the last comes the first, so a single row follows itself.
Rows with a null doc_id have no place in that order: no text follows them, so their edited text just loses its end and
near_next is 0. An empty table gives an empty result; a text is held whole, one at a time, however long; rows that repeat
one doc_id are all one task's, which they pass through one after the other. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import U64, Workspace, mix

K, LENGTH, SKETCHES = 5, 2, 64
_STEP = np.random.default_rng(6).integers(1, 1 << 63, K + 2, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_LOW = U64((1 << 24) - 1)
_OFFSETS = (np.arange(SKETCHES, dtype=U64) * U64((1 << 40) // SKETCHES)) << U64(24)
FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _selected(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hash values in ascending order, their text positions) of the occurrence-numbered runs."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    n = max(1, len(points) - K + 1)
    run = points[:n] * _STEP[0]
    for j in range(1, min(K, len(points))):
        run += points[j : j + n] * _STEP[j]
    if len(points) < K:
        run = run[:1] + np.array([len(points)], U64) * _STEP[K + 1]
    value = mix(run)
    if n > int(_LOW):  # positions need more than the 24 bits that are packed beside a value below
        order = np.argsort(value, kind="stable")
        value, place = value[order] >> U64(24), order
    else:
        packed = (value & ~_LOW) | np.arange(n, dtype=U64)
        packed.sort()
        value, place = packed >> U64(24), (packed & _LOW).astype(np.int64)
    first = np.r_[True, value[1:] != value[:-1]]
    if not first.all():
        start = np.flatnonzero(first)
        seen = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
        again = np.flatnonzero(seen)
        value[again] = mix(value[again] + seen[again].astype(U64) * _STEP[K]) >> U64(24)
        order = np.argsort(value, kind="stable")
        value, place = value[order], place[order]
    return value, place


def fingerprint(text: str) -> np.ndarray:
    """SKETCHES 16-bit hashes."""
    if not text:
        return np.zeros(SKETCHES, np.uint16)
    value, place = _selected(text)
    n, size = len(value), min(LENGTH, len(value))
    at = np.searchsorted(value, _OFFSETS >> U64(24))
    chosen = (at[:, None] + np.arange(size)) % n
    chosen = np.take_along_axis(chosen, np.argsort(place[chosen], axis=1, kind="stable"), 1)
    acc = np.zeros(SKETCHES, U64)
    for j in range(size):
        acc = mix(acc + value[chosen[:, j]] * _STEP[j] + U64(j + 1))
    return (acc >> U64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, after: str) -> str:
    """The text whose last third is replaced by as many first code points of the next text, or all of them."""
    cut = len(text) // 3
    return text[: len(text) - cut] + after[:cut]


def _hex(prints: np.ndarray) -> str:
    return prints.astype(">u2").tobytes().hex()


def _row(doc_id: int | None, text: str, own: np.ndarray, after: str, after_print: np.ndarray | None) -> tuple:
    changed = edited(text, after)
    other = own if changed == text else fingerprint(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    return doc_id, len(text), digest, _hex(own), _hex(other), likeness(own, other), 0.0 if after_print is None else likeness(own, after_print)


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by part, then halo rows last, then in order; each waits for the next one of its part."""
    waiting = None  # (part, doc_id, text, fingerprint)
    for batch in batches:
        rows = []
        parts, halo, ids, texts = batch.column("part").to_pylist(), batch.column("halo").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")
        for i in range(batch.num_rows):
            if waiting is None and halo[i]:
                continue  # a part without rows of its own, or a second halo row
            text = texts[i].as_py() or ""
            own = fingerprint(text)
            if waiting is not None and waiting[0] == parts[i]:
                rows.append(_row(waiting[1], waiting[2], waiting[3], text, own))
            waiting = None if halo[i] else (parts[i], ids[i], text, own)
        if rows:
            yield _batch(rows)


def _alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_row(None, t or "", fingerprint(t or ""), "", None) for t in batch.column("text").to_pylist()]
        if rows:
            yield _batch(rows)


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each row of docs (doc_id, text): FIELDS.

    Documents are dealt to parts by ranges of doc_id whose upper ends are ids that exist, so a part's first document is
    known beforehand; it goes to the part before as well, as that part's last document needs it. One shuffle of the
    texts; a part streams through its task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.max("doc_id").alias("top"), F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 20 * parts).alias("cuts")).first()
    alone = rows.where("doc_id IS NULL").mapInArrow(_alone, FIELDS)
    if found.top is None:
        return alone
    cuts = np.unique(np.array([*found.cuts, found.top], np.int64))
    last = len(cuts) - 1

    @F.pandas_udf("struct<part:int,before:int>")
    def place(ids: pd.Series) -> pd.DataFrame:
        ids = ids.to_numpy(np.int64)
        part = np.searchsorted(cuts, ids)
        # The first document of a part is the next one of the last of the part below; of the top part, of the lowest.
        before = np.where(cuts[part] == ids, np.where(part == last, 0, part + 1), -1)
        return pd.DataFrame({"part": part.astype(np.int32), "before": before.astype(np.int32)})

    placed = rows.where("doc_id IS NOT NULL").withColumn("at", place("doc_id"))
    own = F.struct(F.col("at.part").alias("part"), F.lit(False).alias("halo"))
    extra = F.struct(F.col("at.before").alias("part"), F.lit(True).alias("halo"))
    dealt = placed.select("doc_id", "text", F.explode(F.when(F.col("at.before") >= 0, F.array(own, extra)).otherwise(F.array(own))).alias("x")).select("x.part", "x.halo", "doc_id", "text")
    ordered = dealt.repartitionById(last + 1, "part").sortWithinPartitions(F.col("part"), F.col("halo"), F.col("doc_id").desc(), F.col("text"))
    return ordered.mapInArrow(_in_order, FIELDS).unionByName(alone)
