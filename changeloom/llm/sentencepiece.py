"""Operator 9: SentencePiece unigram encoding and decoding.

The pieces of a model file, with their log scores, become a double-array trie over UTF-8 bytes. A text is put behind a
whitespace marker, its blanks become markers, and the segmentation of the highest total score is found by Viterbi's
method; a character that no piece covers falls back to byte pieces (or to the unknown piece where the model has none).
Decoding joins the pieces' bytes, turns markers into blanks and drops the first.

Where no piece holds a marker after another character, a text falls apart at markers, and a task segments each distinct
part once as long as it remembers it (`SEEN` parts), all new parts of a run of text in step: the trie is walked from every byte at once, and the best path is extended over all
parts position by position. Scores add up in double precision; ties go to the longer last piece.

Edge cases: repeated rows are encoded one by one; an empty table gives an empty result; a text is segmented whole however
long, a long one alone; a null text has null ids and decodes to null; an empty text has no ids and decodes to itself; a marker
character that stands in a text is read as a blank and so comes back as one; other columns named in `keep` pass through.
The trie's size is bounded by the vocabulary, so it is sent to the workers.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeloom.llm.common import annotate, fresh_name, span_hashes, text_chunks

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
SEEN = 250_000  # distinct parts that a task remembers, and an eighth of the pieces in them
CHUNK = 512 << 10  # bytes of text segmented at once; bounds a worker's memory
# Fixed values of the model format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


# ------------------------------------------------------------------ model files


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = raw[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < len(raw):
        number, kind = divmod(varint(), 8)
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, raw[at : at + size]
            at += size


@dataclass(frozen=True)
class Piece:
    text: str
    score: float
    kind: int


def read_model(path: str) -> tuple[list[Piece], bool]:
    """(pieces, whether a marker is put before a text) of a model file."""
    with open(path, "rb") as f:
        raw = f.read()
    pieces, dummy = [], True
    for number, value in _fields(raw):
        if number == 1:
            own = dict(_fields(value))
            pieces.append(Piece(own[1].decode(), struct.unpack("<f", own[2])[0] if 2 in own else 0.0, own.get(3, NORMAL)))
        elif number == 3:
            own = dict(_fields(value))
            dummy = bool(own.get(3, 1))
            if own.get(2):
                raise ValueError("a model with a character map for normalisation isn't supported")
            if own.get(4, 1):
                raise ValueError("a model that removes extra blanks isn't supported")
    return pieces, dummy


# ------------------------------------------------------------------ double-array trie


class DoubleArray:
    """From a state s, byte b leads to base[s] + b + 1 if check there is s; value is a piece's id or -1. State 0 is the root."""

    def __init__(self, words: list[tuple[bytes, int]]):
        words = sorted(words)
        size = 1 << 12
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.value = np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        self.check[0] = 0
        free, top = 257, 257  # so that a base is never negative
        todo = [(0, 0, len(words), 0)]  # state, words [lo, hi) with its prefix, depth
        while todo:
            state, lo, hi, depth = todo.pop()
            if lo < hi and len(words[lo][0]) == depth:
                self.value[state] = words[lo][1]
                lo += 1
            if lo == hi:
                continue
            children, i = [], lo
            while i < hi:
                byte, j = words[i][0][depth], i
                while j < hi and words[j][0][depth] == byte:
                    j += 1
                children.append((byte, i, j))
                i = j
            # An only child takes the first free cell; several are placed near the end, where they soon fit.
            while free < len(used) and used[free]:
                free += 1
            base = max(0, (free if len(children) == 1 else max(free, top - 256)) - 1 - children[0][0])
            while True:
                if base + 257 >= len(used):
                    more = len(used)
                    used.extend(bytes(more))
                    self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
                    self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])
                    self.value = np.concatenate([self.value, np.full(more, -1, np.int32)])
                if not any(used[base + b + 1] for b, _, _ in children):
                    break
                base += 1
            self.base[state] = base
            for byte, i, j in children:
                at = base + byte + 1
                used[at] = 1
                top = max(top, at)
                self.check[at] = state
                todo.append((at, i, j, depth + 1))

    def step(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, whether there is one)."""
        to = self.base[states] + data + 1
        ok = self.check[to] == states
        return to, ok & (to != 0)


# ------------------------------------------------------------------ encoding


class Seen:
    """Segmentations of the parts that a task has met, by their hashes; forgotten when there are more than `SEEN`, or long ones."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.kinds, self.at, self.count, self.score = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def find(self, kinds: np.ndarray) -> np.ndarray:
        """Which of these ascending hashes are known; if there would be too many, none, and those from before are gone."""
        place = np.minimum(np.searchsorted(self.kinds, kinds), max(0, len(self.kinds) - 1))
        known = self.kinds[place] == kinds if len(self.kinds) else np.zeros(len(kinds), bool)
        if len(self.kinds) and (len(self.kinds) + int((~known).sum()) > SEEN or self.used > 8 * SEEN):
            self.clear()
            known = np.zeros(len(kinds), bool)
        return known

    def add(self, kinds: np.ndarray, known: np.ndarray, ids: np.ndarray, off: np.ndarray, scores: np.ndarray) -> None:
        """The segmentations of the hashes that were not known, in their order."""
        new = kinds[~known]
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], ids, np.zeros(self.used + len(ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        place = np.searchsorted(self.kinds, new)
        self.at, self.count, self.score = np.insert(self.at, place, self.used + off[:-1]), np.insert(self.count, place, np.diff(off)), np.insert(self.score, place, scores)
        self.kinds = np.insert(self.kinds, place, new)
        self.used += len(ids)

    def of(self, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all that is known, where those of each hash begin, how many they are, their scores)."""
        place = np.searchsorted(self.kinds, kinds)
        return self.ids, self.at[place], self.count[place], self.score[place]


class Encoder:
    def __init__(self, pieces: list[Piece], dummy: bool = True):
        self.dummy = dummy
        self.seen = Seen()
        self.bytes_of = [b"" if p.kind in (CONTROL, UNUSED) else bytes([int(p.text[3:5], 16)]) if p.kind == BYTE else " ⁇ ".encode() if p.kind == UNKNOWN else p.text.replace(MARKER, " ").encode() for p in pieces]
        usable = [(i, p) for i, p in enumerate(pieces) if p.kind in (NORMAL, USER_DEFINED) and p.text]
        normal = [p.score for p in pieces if p.kind == NORMAL]
        self.unknown_score = min(normal, default=0.0) - UNKNOWN_PENALTY
        top = max(normal, default=0.0)
        self.scores = np.array([len(p.text) * top - 0.1 if p.kind == USER_DEFINED else p.score for p in pieces] or [0.0], np.float64)
        self.trie = DoubleArray([(self.bytes_of[i], i) for i, _ in usable])
        self.by_byte = np.full(256, next((i for i, p in enumerate(pieces) if p.kind == UNKNOWN), 0), np.int32)
        for i, p in enumerate(pieces):
            if p.kind == BYTE:
                self.by_byte[self.bytes_of[i][0]] = i
        self.byte_fallback = any(p.kind == BYTE for p in pieces)
        self.parts_apart = all(MARKER not in p.text.lstrip(MARKER) for _, p in usable)
        sizes = np.array([len(b) for b in self.bytes_of], np.int64)
        self.piece_off = np.concatenate([[0], np.cumsum(sizes)])
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def normalised(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes with blanks for markers, and one before each text that isn't empty."""
        if MARKER.encode() in buf.tobytes():
            texts = [buf[a:b].tobytes().replace(MARKER.encode(), b" ") for a, b in zip(off, off[1:], strict=False)]
            buf, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        if not self.dummy:
            return buf, off
        size = np.diff(off)
        lead = np.cumsum(size > 0)
        out = np.full(len(buf) + int(lead[-1] if len(lead) else 0), 32, np.uint8)
        out[np.arange(len(buf)) + np.repeat(lead, size)] = buf
        return out, off + np.concatenate([[0], lead])

    def parts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where parts start that no piece joins to the one before."""
        first = np.zeros(len(buf) + 1, bool)
        if self.parts_apart and len(buf):
            blank = buf == 32
            first[1:-1] = blank[1:] & ~blank[:-1]
        first[off] = True
        return np.flatnonzero(first[:-1])

    def segment(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, scores) of the best segmentation of each part; parts aren't empty."""
        n = len(buf)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64), np.zeros(len(off) - 1)
        lead = (buf & 0xC0) != 0x80
        char_start = np.flatnonzero(lead)
        part_end = np.repeat(off[1:], np.diff(off))
        starts, ends, ids = [], [], []
        at, state, depth = char_start, np.zeros(len(char_start), np.int32), 0
        covered = np.zeros(n, bool)
        char_end = np.append(char_start[1:], n)
        char_len = np.zeros(n, np.int64)
        char_len[char_start] = char_end - char_start
        while len(at):
            inside = at + depth < part_end[at]
            at, state = at[inside], state[inside]
            state, ok = self.trie.step(state, buf[at + depth].astype(np.int32))
            at, state, depth = at[ok], state[ok], depth + 1
            value = self.trie.value[state]
            hit = np.flatnonzero(value >= 0)
            starts.append(at[hit])
            ends.append(at[hit] + depth)
            ids.append(value[hit])
            covered[at[hit][char_len[at[hit]] == depth]] = True
        alone = char_start[~covered[char_start]]
        starts.append(alone)
        ends.append(alone + char_len[alone])
        ids.append(np.full(len(alone), -1, np.int32))
        start, end, piece = np.concatenate(starts), np.concatenate(ends), np.concatenate(ids)
        score = np.where(piece >= 0, self.scores[piece], self.unknown_score)

        part_start = np.repeat(off[:-1], np.diff(off))
        reach = end - part_start[start]  # how far into its part an edge leads: extended in this order, all parts in step
        length = end - start
        order = np.argsort((reach << np.int64(42)) + ((end * (int(length.max()) + 1)) - length), kind="stable")
        start, end, piece, score, reach = start[order], end[order], piece[order], score[order], reach[order]
        # Node x + part number: each part has a node before its first byte and one after each byte.
        part_no = np.repeat(np.arange(len(off) - 1), np.diff(off))
        node_from, node_to = start + part_no[start], end + part_no[start]
        best = np.full(n + len(off) - 1, -np.inf)
        best[off[:-1] + np.arange(len(off) - 1)] = 0
        edge_of = np.full(len(best), -1, np.int64)
        cuts = np.flatnonzero(np.r_[True, reach[1:] != reach[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            total = best[node_from[a:b]] + score[a:b]
            to = node_to[a:b]
            first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
            top = np.maximum.reduceat(total, first)
            same = np.flatnonzero(total == np.repeat(top, np.diff(np.append(first, b - a))))
            group = np.searchsorted(first, same, "right") - 1
            own = same[np.r_[True, group[1:] != group[:-1]]]
            best[to[first]] = top
            edge_of[to[own]] = a + own
        last = off[1:] + np.arange(len(off) - 1)
        scores = best[last]
        node, part = last, np.arange(len(off) - 1)
        floor = off[:-1] + np.arange(len(off) - 1)
        edges = []
        while len(node):
            more = node > floor[part]
            node, part = node[more], part[more]
            edge = edge_of[node]
            edges.append(edge)
            node = node_from[edge]
        edge = np.concatenate(edges)
        edge = edge[np.argsort(start[edge], kind="stable")]
        start, end, piece = start[edge], end[edge], piece[edge]
        if self.byte_fallback:
            times = np.where(piece < 0, end - start, 1)
        else:
            times = np.ones(len(piece), np.int64)
        where = np.repeat(start, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        known = np.repeat(piece, times)
        out = np.where(known < 0, self.by_byte[buf[where]], known).astype(np.int32)
        return out, np.searchsorted(where, off), scores

    def encode(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets, scores) of texts."""
        buf, off = self.normalised(buf, off)
        starts = self.parts(buf, off)
        ends = np.append(starts[1:], len(buf))
        if len(starts) and len(buf):
            hashes = span_hashes(buf, starts, ends, lower=False)
            kinds, first, number = np.unique(hashes, return_index=True, return_inverse=True)
        else:
            kinds, first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            number = first
        known = self.seen.find(kinds)
        new = first[~known]
        size = ends[new] - starts[new] if len(new) else np.zeros(0, np.int64)
        own_off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        where = np.repeat(starts[new] if len(new) else size, size) + np.arange(own_off[-1]) - np.repeat(own_off[:-1], size)
        self.seen.add(kinds, known, *self.segment(buf[where], own_off))
        ids, id_at, id_count, scores = self.seen.of(kinds)
        count = id_count[number]
        total = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
        take = np.repeat(id_at[number], count) + np.arange(total[-1]) - np.repeat(total[:-1], count)
        part_off = np.searchsorted(starts, off)
        running = np.concatenate([[0.0], np.cumsum(scores[number])])
        return ids[take], total[part_off], running[part_off[1:]] - running[part_off[:-1]]

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, offsets) of texts; an id beyond the vocabulary raises."""
        size = np.diff(self.piece_off)[ids]
        total = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        where = np.repeat(self.piece_off[:-1][ids], size) + np.arange(total[-1]) - np.repeat(total[:-1], size)
        buf, text_off = self.piece_bytes[where], total[off]
        if not self.dummy:
            return buf, text_off
        lead = (np.diff(text_off) > 0) & (buf[np.minimum(text_off[:-1], max(0, len(buf) - 1))] == 32 if len(buf) else False)
        keep = np.ones(len(buf), bool)
        keep[text_off[:-1][lead]] = False
        return buf[keep], text_off - np.concatenate([[0], np.cumsum(lead)])


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(*read_model(path))


# ------------------------------------------------------------------ Spark


def _string_array(buf: np.ndarray, off: np.ndarray, valid: np.ndarray | None) -> pa.Array:
    texts = [buf[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(off, off[1:], strict=False)]
    return pa.array(texts, pa.string(), mask=None if valid is None else ~valid)


def _list_array(ids: np.ndarray, off: np.ndarray, valid: np.ndarray | None) -> pa.Array:
    nulls = None if valid is None else pa.array(valid).buffers()[1]
    return pa.Array.from_buffers(pa.list_(pa.int32()), len(off) - 1, [nulls, pa.py_buffer(off.astype(np.int32))], children=[pa.array(ids, pa.int32())])


def encode(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if none are named) with `ids` array<int> and `ids_score`, under names that are free."""
    keep = docs.columns if keep is None else keep
    ids, score, inner = fresh_name(keep, "ids"), fresh_name(keep, "ids_score"), fresh_name(keep, "text")
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias(inner))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(score, T.DoubleType())])
    own = _encoder(model)  # read on the driver, sent with the task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(len(keep))
            for c in text_chunks(column, CHUNK):
                found, off, scores = own.encode(c.buf, c.off)
                part = column.slice(c.lo, c.hi - c.lo)
                valid = part.is_valid().to_numpy(zero_copy_only=False) if part.null_count else None
                old = [batch.column(i).slice(c.lo, c.hi - c.lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*old, _list_array(found, off, valid), pa.array(scores)], names=schema.names)

    return source.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` (all, if none are named) with `decoded`, under a name that is free."""
    keep = encoded.columns if keep is None else keep
    name, inner = fresh_name(keep, "decoded"), fresh_name(keep, "ids")
    source = encoded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids}`").cast("array<int>").alias(inner))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField(name, T.StringType())])
    own = _encoder(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                column = part.column(len(keep))
                valid = column.is_valid().to_numpy(zero_copy_only=False)
                size = np.where(valid, column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
                off = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
                buf, text_off = own.decode(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), off)
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(keep))), _string_array(buf, text_off, None if valid.all() else valid)], names=schema.names)

    return source.mapInArrow(run, schema)


def digests(docs: DataFrame, model: str) -> DataFrame:
    """For each row of docs (doc_id, text): how many pieces, their total score, a digest of the ids, and whether decoding gives the text back.

    Encodes and decodes in one pass, so that neither ids nor decoded texts leave the worker.
    """
    own = _encoder(model)

    def run(buf: np.ndarray, off: np.ndarray) -> list:
        ids, id_off, scores = own.encode(buf, off)
        back, back_off = own.decode(ids, id_off)
        keys = [hashlib.blake2b(ids[a:b].astype("<i4").tobytes(), digest_size=16).hexdigest() for a, b in zip(id_off, id_off[1:], strict=False)]
        same = [bool(np.array_equal(back[a:b], buf[c:d])) for a, b, c, d in zip(back_off, back_off[1:], off, off[1:], strict=False)]
        return [np.diff(id_off), pa.array(keys), np.round(scores, 3), pa.array(same)]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return annotate(rows, "text", run, [("n_pieces", "long"), ("ids_digest", "string"), ("score", "double"), ("round_trip", "boolean")], ["doc_id"], CHUNK)
