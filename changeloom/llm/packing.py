"""Operator 2: conflict-constrained best-fit packing of documents into bins of a fixed number of tokens.

Bins are kept ordered by the room left. Each carries two bitmaps: of sources, with one bit for each of the
`max_per_source` places a source has in a bin, and of duplicate clusters, one place each. Items come in falling order
of size; the search starts at the smallest room that fits and goes on to its successors until a bin is compatible, which
is then the tightest one. Without one a new bin opens. So no bin ever holds two copies of a text, nor more than
`max_per_source` items of one source.

A token is a word, with one more for the end of the text. A longer document than a bin is cut into pieces: all but the
last fill a bin each, the last is packed like a document. A cluster is the documents with the same words (A-Z folded,
blanks aside), or the given cluster column. Packing is by shards of about `SHARD` items dealt by a hash, so a hot source
or cluster is spread over all shards and no task grows with the input; a shard's bins are its own.

Edge cases: a null or empty text is one token; null sources are one source; repeated rows are packed one by one, told
apart by `copy`; ties of size go by doc_id, words and copy; a null doc_id is packed like any other; an empty table gives
no piece. Columns besides doc_id, text, source and the cluster column are
not looked at.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import Workspace, annotate, word_hashes, word_spans

CAPACITY = 4096
MAX_PER_SOURCE = 4
SHARD = 4096
COPIES = 4096  # of a row are made at once
PIECES = "doc_id long, copy int, piece int, start long, tokens long, source string, cluster binary, shard long, bin long, place int"


def sizes_and_clusters(buf: np.ndarray, off: np.ndarray) -> list:
    words = word_spans(buf, off)
    hashes = word_hashes(buf, words)
    keys = [hashlib.blake2b(hashes[a:b], digest_size=16).digest() for a, b in zip(words.off, words.off[1:], strict=False)]
    return [np.diff(words.off) + 1, pa.array(keys, pa.binary())]


def best_fit(sizes: list[int], sources: list[int], clusters: list[int], capacity: int, max_per_source: int) -> list[int]:
    """A bin for each item, in the order given; a cluster of -1 conflicts with nothing."""
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    source_bits: list[int] = []
    cluster_bits: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        full = 1 << (source * max_per_source + max_per_source - 1)
        held = 1 << cluster if cluster >= 0 else 0
        at = bisect.bisect_left(room, (size, -1))
        while at < len(room) and (source_bits[room[at][1]] & full or cluster_bits[room[at][1]] & held):
            at += 1
        if at < len(room):
            left, own = room.pop(at)
        else:
            left, own = capacity, len(source_bits)
            source_bits.append(0)
            cluster_bits.append(0)
        shift = source * max_per_source
        places = (source_bits[own] >> shift) & ((1 << max_per_source) - 1)
        source_bits[own] |= (places + 1) << shift  # the lowest place that is free
        cluster_bits[own] |= held
        if left > size:
            bisect.insort(room, (left - size, own))
        out.append(own)
    return out


def _pack(capacity: int, max_per_source: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["tokens", "doc_id", "cluster", "copy"], ascending=[False, True, True, True], kind="stable", na_position="last").reset_index(drop=True)
        tokens = pdf["tokens"].to_numpy()
        n = (tokens + capacity - 1) // capacity
        doc = np.repeat(np.arange(len(pdf)), n)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        size = np.where(piece < n[doc] - 1, capacity, tokens[doc] - (n[doc] - 1) * capacity)
        order = np.argsort(-size, kind="stable")
        doc, piece, size = doc[order], piece[order], size[order]
        sources = pd.factorize(pdf["source"], use_na_sentinel=False)[0]
        codes, _ = pd.factorize(pdf["cluster"], use_na_sentinel=False)
        # Only clusters with several items in the shard need a bit; the pieces of one document are no copies of each other.
        several = np.bincount(codes, minlength=1) > 1
        bit = np.where(several, np.cumsum(several) - 1, -1)[codes]
        bins = np.array(best_fit(size.tolist(), sources[doc].tolist(), bit[doc].tolist(), capacity, max_per_source), np.int64)
        place = pd.Series(bins).groupby(bins).cumcount().to_numpy()
        out = pdf.iloc[doc][["doc_id", "copy", "source", "cluster", "shard"]].reset_index(drop=True)
        out = out.assign(piece=piece.astype(np.int32), start=piece * capacity, tokens=size, bin=bins, place=place.astype(np.int32))
        return out[["doc_id", "copy", "piece", "start", "tokens", "source", "cluster", "shard", "bin", "place"]]

    return run


def pack(docs: DataFrame, capacity: int = CAPACITY, max_per_source: int = MAX_PER_SOURCE, cluster: str | None = None) -> DataFrame:
    """One row for each piece of each row of docs (doc_id, text, source): where it goes (shard, bin, place) and what it holds."""
    ws = Workspace(docs.sparkSession, "packing")
    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source")]
    given = [F.col(f"`{cluster}`").cast("string").cast("binary").alias("given")] if cluster else []
    sized = annotate(docs.select(*cols, *given), "text", sizes_and_clusters, [("tokens", "long"), ("words_key", "binary")], ["doc_id", "source", *(["given"] if cluster else [])])
    sized = sized.select("doc_id", "source", "tokens", (F.coalesce("given", "words_key") if cluster else F.col("words_key")).alias("cluster"))
    # Equal rows are counted first, so that even they are dealt over the shards.
    counted = ws.table(sized.groupBy("doc_id", "source", "tokens", "cluster").agg(F.count("*").cast("int").alias("n")), "sized")
    total = counted.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD))
    # Copies are made in two steps: no row holds a list as long as a row's number of copies.
    runs = counted.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / COPIES).cast("int"))).alias("run"))
    copies = F.sequence(F.col("run") * COPIES, F.least(F.col("n"), (F.col("run") + 1) * COPIES) - 1)
    items = runs.repartition("doc_id", "cluster", "run").select("doc_id", "source", "tokens", "cluster", F.explode(copies).alias("copy"))
    items = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "copy"), F.lit(shards)))
    return items.groupBy("shard").applyInPandas(_pack(capacity, max_per_source), PIECES)
