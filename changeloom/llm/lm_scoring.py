"""Operator 7: n-gram language-model scores by a weighted backoff automaton.

Tokens are words (A-Z folded) and one end token for each text. The model is of order three:

    P1(w)      = (c(w) + 0.5) / (N + 0.5 (V + 1))           N training tokens of V kinds
    P2(w | h)  = (c(hw) + PRIOR2 P1(w)) / (c(h) + PRIOR2)
    P3(w | gh) = (c(ghw) + PRIOR3 P2(w | h)) / (c(gh) + PRIOR3)

Each sums to one over the seen kinds and the unknown one. The automaton has a root, a state for each seen word and one
for each seen pair of words (a text's start counts as a word). Arcs leave a state for each n-gram seen from it, with the
logarithm of its probability, and lead to the state of the longest seen suffix. Where a state has no arc for a token, its
failure arc is taken, which costs `log10(PRIOR / (c + PRIOR))` and leads to the state without the oldest word; the root
has an arc for every token. A text's score is what one traversal from left to right adds up. `Automaton.traverse` walks
many stretches of texts in step; a stretch inside a text starts in the state its two words before lead to from the root.

No task holds the whole model. Texts are read once, into blocks of about `BLOCK_BYTES` of text, which are written as
token numbers. A block sends what it counted in its training texts, and the n-grams it wants to know, to slots dealt by
ranges of the n-gram's hash, as sorted arrays rather than rows. A slot adds the counts up and answers each block where
the total differs from the block's own count; above `FAN` blocks that goes by a tree, so a task gets about `FAN`
messages for a slot however common a word is. From its counts and the answers each block builds the part of the automaton that its
texts can reach. Counts cover all training texts; nothing is pruned. Words are known by 64-bit hashes; pairs and
triples by as many bits as keep the chance of a false match below 2^-17 for each look-up.

Edge cases: a null or empty text is one end token; in an empty table nothing is scored; with no training text N and V
are 0 and every token has probability 1 by the base; a null doc_id is hashed as empty text and so is in training;
repeated rows and rows that share a doc_id count and are scored one by one; a text longer than a block is a block of its
own and is held whole by one task; equal texts get equal scores. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import CHUNK_BYTES, U64, Workspace, estimated_bytes, mix, tasks_for, text_chunks, word_hashes, word_spans

MODULUS, REMAINDER = 5, 1
PRIOR2, PRIOR3 = 1000.0, 5.0  # by held-out perplexity: see the README
BLOCK_BYTES = 5 << 20
FAN = 4096
PART_TOKENS = 200_000  # of a block are scored at once
STRETCH = 256  # tokens of a text that are walked in one go
END, START = U64(0x0123456789ABCDEF), U64(0xFEDCBA9876543210)
_MIX2 = (U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F))
_MIX3 = (U64(0xE7037ED1A0B428DB), U64(0x8EBC6AF09C88C6E3), U64(0x589965CC75374CC3))
_NONE = np.zeros(0, np.int64)


# ------------------------------------------------------------------ arrays as bytes


def _planes(x: np.ndarray) -> bytes:
    """Unsigned numbers by byte planes of the least width, compressed."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    raw = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    body = zstandard.ZstdCompressor(level=1).compress(raw)
    return np.array([len(x), width, len(body)], "<u8").tobytes() + body


def _from_planes(raw: bytes, at: int = 0) -> tuple[np.ndarray, int]:
    n, width, size = (int(v) for v in np.frombuffer(raw, "<u8", 3, at))
    body = zstandard.ZstdDecompressor().decompress(raw[at + 24 : at + 24 + size], max_output_size=max(1, n * width))
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(body, np.uint8).reshape(width, n).T
    return out.view("<u8").reshape(-1), at + 24 + size


def pack_sorted(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending keys (as differences) and their counts."""
    return _planes(np.diff(keys, prepend=U64(0))) + _planes(counts)


def unpack_sorted(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    steps, at = _from_planes(raw)
    return np.cumsum(steps, dtype=U64), _from_planes(raw, at)[0].astype(np.int64)


# ------------------------------------------------------------------ tokens of a block


def block_tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes, document offsets); each document ends with the end token."""
    words = word_spans(buf, off)
    hashes = word_hashes(buf, words)
    n = len(off) - 1
    out = np.full(len(hashes) + n, END)
    size = np.diff(words.off)
    out[np.arange(len(hashes)) + np.repeat(np.arange(n), size)] = hashes
    return out, words.off + np.arange(n + 1)


def held_out(doc_ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % MODULUS == REMAINDER for i in doc_ids], bool)


class Block:
    """Texts as numbers of distinct tokens, whose hashes ascend in `words`."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, training: np.ndarray):
        self.words, self.tokens, self.sizes = words, tokens.astype(np.int64), sizes.astype(np.int64)
        self.off = np.concatenate([[0], np.cumsum(self.sizes)])
        self.flag = np.repeat(training, self.sizes)
        self.hash = np.append(words, START)  # of a token's number; the last number stands for the start of a text
        starts = self.off[:-1]  # every text has at least its end token
        self.h = np.empty_like(self.tokens)
        self.h[1:] = self.tokens[:-1]
        self.h[starts] = len(words)
        self.inner = np.ones(len(self.tokens), bool)  # tokens with two words before them, the start counted
        self.inner[starts] = False

    def parts(self, tokens: int = PART_TOKENS) -> Iterator["Block"]:
        """Runs of texts of about so many tokens, by the same numbers; a longer text comes alone."""
        lo = 0
        while lo < len(self.sizes):
            hi = max(lo + 1, int(np.searchsorted(self.off, self.off[lo] + tokens, "right")) - 1)
            at = slice(self.off[lo], self.off[hi])
            yield Block(self.words, self.tokens[at], self.sizes[lo:hi], self.flag[self.off[lo:hi]])
            lo = hi

    def key2(self, h: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
        return mix(self.hash[h] * _MIX2[0] + self.hash[w] * _MIX2[1]) >> U64(64 - bits)

    def key3(self, g: np.ndarray, h: np.ndarray, w: np.ndarray, bits: int) -> np.ndarray:
        return mix(self.hash[g] * _MIX3[0] + self.hash[h] * _MIX3[1] + self.hash[w] * _MIX3[2]) >> U64(64 - bits)

    def counts(self, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For words, pairs and triples: (distinct keys, ascending; how often training texts of the block hold each)."""
        inner = np.flatnonzero(self.inner)
        return [
            (self.words, np.bincount(self.tokens[self.flag], minlength=len(self.words))),
            _counted(self.key2(self.h, self.tokens, bits), self.flag),
            _counted(self.key3(self.h[inner - 1], self.h[inner], self.tokens[inner], bits), self.flag[inner]),
        ]


def _counted(keys: np.ndarray, training: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys have 62 bits at most: the lowest bit of the sorted numbers tells training texts from others. Sorts in place."""
    keys <<= U64(1)
    keys |= ~training
    keys.sort()
    if not len(keys):
        return keys, _NONE
    edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    times = np.diff(np.append(edge, len(keys)))
    value = keys[edge]
    times[(value & U64(1)).astype(bool)] = 0
    value >>= U64(1)
    first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
    return value[first], np.add.reduceat(times, first)


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, whether found)."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def _look(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
    """The counts of keys that the table has, looked up in order."""
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = table[1][np.searchsorted(table[0], keys[order])]
    return out


# ------------------------------------------------------------------ the automaton


class Automaton:
    """The part of the model that a block's texts can reach.

    States: 0 the root; 1 + w the word w; from `first_pair` on the seen pairs. Arcs are kept by state * width + token.
    """

    def __init__(self, block: Block, counts: list[tuple[np.ndarray, np.ndarray]], bits: int, tokens: int, kinds: int, texts: int, priors: tuple[float, float] = (PRIOR2, PRIOR3)):
        p2, p3 = priors
        self.width = width = len(block.words) + 1
        self.first_pair = 1 + width
        self.count = np.append(counts[0][1], texts)
        self.p1 = (self.count[:-1] + 0.5) / (tokens + 0.5 * (kinds + 1))

        # Pairs and triples of the block, and which of them stands at each token; the pair before a token is its history.
        pairs, pair_at = np.unique(block.h * width + block.tokens, return_inverse=True)
        times = _look(counts[1], block.key2(pairs // width, pairs % width, bits))
        seen, rank = times > 0, np.cumsum(times > 0) - 1  # of a seen pair among the seen ones
        self.pairs, self.pair_count = pairs[seen], times[seen]
        h, w = self.pairs // width, self.pairs % width
        prob2 = (self.pair_count + p2 * self.p1[w]) / (self.count[h] + p2)
        arcs2 = (1 + h) * width + w

        inner = np.flatnonzero(block.inner)
        triples, at = np.unique(pair_at[inner - 1] * width + block.tokens[inner], return_inverse=True)
        history, w3, below = triples // width, triples % width, np.empty(len(triples), np.int64)
        below[at] = pair_at[inner]  # the pair that is left without the oldest word
        del at, inner, pair_at
        g3, h3 = pairs[history] // width, pairs[history] % width
        times = _look(counts[2], block.key3(g3, h3, w3, bits))
        own = (times > 0) & seen[history]
        times, history, h3, w3, below = times[own], rank[history[own]], h3[own], w3[own], below[own]
        known = seen[below]  # always, but for a false match of hashes
        less = np.where(known, prob2[rank[below]], p2 * self.p1[w3] / (self.count[h3] + p2)) if len(prob2) else np.zeros(0)
        prob3 = (times + p3 * less) / (self.pair_count[history] + p3)
        triples = (self.first_pair + history) * width + w3

        self.arc = np.concatenate([arcs2, triples])  # ascending: states of pairs come after those of words
        self.weight = np.log10(np.concatenate([prob2, prob3]))
        to2, to3 = self.first_pair + np.arange(len(self.pairs)), np.where(known, self.first_pair + rank[below], self.word_state(w3))
        self.to = np.concatenate([to2, to3])
        self.root_weight, self.root_to = np.log10(self.p1), self.word_state(np.arange(width - 1))
        self.fail_to = np.concatenate([[0], np.zeros(width, np.int64), self.word_state(w)])
        self.fail_weight = np.log10(np.concatenate([[1.0], p2 / (self.count + p2), p3 / (self.pair_count + p3)]))

    def word_state(self, w: np.ndarray) -> np.ndarray:
        return np.where(self.count[w] > 0, 1 + w, 0)

    def step(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(next states, weights): the state's own arc, or failure arcs until a state has one; the root always has."""
        state, total, out = state.copy(), np.zeros(len(state)), np.empty_like(state)
        todo = np.arange(len(state))
        while len(todo):
            s, w = state[todo], token[todo]
            at, found = _find(self.arc, s * self.width + w)
            root = s == 0
            found &= ~root
            hit = todo[found]
            out[hit] = self.to[at[found]]
            total[hit] += self.weight[at[found]]
            hit = todo[root]
            out[hit] = self.root_to[w[root]]
            total[hit] += self.root_weight[w[root]]
            todo = todo[~(found | root)]
            total[todo] += self.fail_weight[state[todo]]
            state[todo] = self.fail_to[state[todo]]
        return out, total

    def traverse(self, block: Block) -> np.ndarray:
        """The score of each text."""
        parts = -(-block.sizes // STRETCH)
        doc = np.repeat(np.arange(len(parts)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        lo = block.off[:-1][doc] + nth * STRETCH
        size = np.minimum(block.off[1:][doc] - lo, STRETCH)
        order = np.argsort(-size, kind="stable")
        lo, size = lo[order], size[order]
        later = np.flatnonzero(nth[order] > 0)
        state = np.full(len(lo), self.word_state(np.array([self.width - 1]))[0])
        before = np.zeros(len(later), np.int64)
        for back in (2, 1):
            before, _ = self.step(before, block.tokens[lo[later] - back])
        state[later] = before
        total = np.zeros(len(lo))
        longer = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), "left")  # how many stretches go beyond a place
        for t, n in enumerate(longer):
            state[:n], weight = self.step(state[:n], block.tokens[lo[:n] + t])
            total[:n] += weight
        return np.bincount(doc, weights=total[np.argsort(order)], minlength=len(parts))


# ------------------------------------------------------------------ Spark


_BLOCK = "block long, ids array<long>, sizes binary, words binary, tokens binary, n_tokens long, train_tokens long, train_texts long"


def _blocks(block_bytes: int):
    """One row for each block. Blocks are numbered by partition, and read only once they are written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, parts, held = TaskContext.get().partitionId() << 32, [], 0

        def row() -> pa.RecordBatch:
            ids = [i for p in parts for i in p[0]]
            words, tokens = np.unique(np.concatenate([p[1] for p in parts]), return_inverse=True)
            sizes = np.concatenate([p[2] for p in parts])
            training = ~held_out(ids)
            values = [number, ids, _planes(sizes), _planes(np.diff(words, prepend=U64(0))), _planes(tokens), len(tokens), int(sizes[training].sum()), int(training.sum())]
            types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[f.split()[0] for f in _BLOCK.split(", ")])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for c in text_chunks(batch.column("text"), min(CHUNK_BYTES, block_bytes)):
                if parts and held + len(c.buf) > block_bytes:
                    yield row()
                    number, parts, held = number + 1, [], 0
                tokens, off = block_tokens(c.buf, c.off)
                parts.append((ids[c.lo : c.hi], tokens, np.diff(off)))
                held += len(c.buf)
        if parts:
            yield row()

    return run


def _read_block(row: dict) -> Block:
    words = np.cumsum(_from_planes(row["words"])[0], dtype=U64)
    return Block(words, _from_planes(row["tokens"])[0], _from_planes(row["sizes"])[0], ~held_out(row["ids"]))


_MESSAGE = "kind int, slot long, sender long, data binary"
_MESSAGES = pa.schema([("kind", pa.int32()), ("slot", pa.int64()), ("sender", pa.int64()), ("data", pa.binary())])


def _slots(keys: np.ndarray, slots: int, bits: int) -> np.ndarray:
    """Ranges of keys; slots are under 2^32."""
    return ((keys >> U64(bits - 32)) * U64(slots)) >> U64(32)


def _send(slots: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for kind, (keys, counts) in enumerate(_read_block(row).counts(bits)):
                    slot = _slots(keys, slots, bits if kind else 64)
                    edge = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1], True]) if len(slot) else [0]
                    spans = list(zip(edge[:-1], edge[1:], strict=True))
                    rows = [[kind] * len(spans), [int(slot[a]) for a, _ in spans], [row["block"]] * len(spans), [pack_sorted(keys[a:b], counts[a:b]) for a, b in spans]]
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, _MESSAGES.types, strict=True)], schema=_MESSAGES)

    return run


class _Sum:
    """Messages of one group: `keys` ascending over all senders, with the total of each."""

    def __init__(self, table: pa.Table):
        self.senders = table.column("sender").to_pylist()
        parts = [unpack_sorted(x.as_py()) for x in table.column("data")]
        keys = np.concatenate([k for k, _ in parts])
        self.size = [len(k) for k, _ in parts]
        self.sent = np.concatenate([c for _, c in parts])
        del parts
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        edge = np.r_[True, keys[1:] != keys[:-1]]
        first = np.flatnonzero(edge)
        self.keys, self.total = keys[first], np.add.reduceat(self.sent[order], first)
        self.which = np.empty(len(keys), np.int64)  # of the distinct keys, for each one sent
        self.which[order] = np.cumsum(edge) - 1

    def answers(self, kind: int, slot: int) -> list[tuple]:
        """What each sender does not know yet: places in its message whose total isn't the count it sent, and the totals."""
        out, lo = [], 0
        for sender, n in zip(self.senders, self.size, strict=True):
            total = self.total[self.which[lo : lo + n]]
            changed = np.flatnonzero(total != self.sent[lo : lo + n])
            if len(changed):
                out.append((kind, slot, sender, pack_sorted(changed.astype(U64), total[changed])))
            lo += n
        return out


def _table(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [()] * 4, _MESSAGES.types, strict=True)], schema=_MESSAGES)


def _add_up(key: tuple, table: pa.Table) -> pa.Table:
    """Answers, and for words a row without data whose sender is minus the number of kinds in training texts."""
    kind, slot, found = key[0].as_py(), key[1].as_py(), _Sum(table)
    return _table(found.answers(kind, slot) + [(kind, slot, -int((found.total > 0).sum()), None)] * (kind == 0))


def _merge(key: tuple, table: pa.Table) -> pa.Table:
    found = _Sum(table)
    return _table([(key[0].as_py(), key[1].as_py(), key[2].as_py(), pack_sorted(found.keys, found.total))])


def _pass_on(key: tuple, sent: pa.Table, told: pa.Table) -> pa.Table:
    """Answers to the senders of one group, from its own sums and what it was told of them."""
    if not sent.num_rows:
        return _table([])
    found = _Sum(sent)
    for x in told.column("data"):
        place, total = unpack_sorted(x.as_py())
        found.total[place] = total
    return _table(found.answers(key[0].as_py(), key[1].as_py()))


def resolve(ws: Workspace, messages: DataFrame, senders: int, fan: int = FAN) -> DataFrame:
    """The answers to messages of so many senders, by a tree in which a group gets about `fan` messages."""
    if senders <= fan:
        return messages.groupBy("kind", "slot").applyInArrow(_add_up, _MESSAGE)
    messages = ws.table(messages, "messages", packed=True)
    parts = -(-senders // fan)
    grouped = messages.withColumn("part", F.pmod(F.xxhash64("sender"), F.lit(parts)).cast("long"))
    merged = grouped.groupBy("kind", "slot", "part").applyInArrow(_merge, _MESSAGE)
    told = ws.table(resolve(ws, merged, parts, fan), "told", packed=True)
    back = told.where("data IS NOT NULL").withColumn("part", F.col("sender"))
    passed = grouped.groupBy("kind", "slot", "part").cogroup(back.groupBy("kind", "slot", "part")).applyInArrow(_pass_on, _MESSAGE)
    return passed.unionByName(told.where("data IS NULL"))


_OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(slots: int, bits: int, tokens: int, kinds: int, texts: int, priors: tuple[float, float]):
    def run(table: pa.Table) -> pa.Table:
        kind, slot = table.column("kind").to_numpy(), table.column("slot").to_numpy()
        row = table.filter(pa.array(kind < 0)).select(["ids", "sizes", "words", "tokens"]).to_pylist()[0]
        block = _read_block(row)
        counts = block.counts(bits)
        at = [_slots(keys, slots, bits if of else 64) for of, (keys, _) in enumerate(counts)]
        for of, own, data in zip(kind, slot, table.column("data"), strict=True):
            if of >= 0:
                place, total = unpack_sorted(data.as_py())
                counts[of][1][int(np.searchsorted(at[of], U64(own))) + place.astype(np.int64)] = total
        del table
        known, base, score = [], [], []
        for part in block.parts():
            model = Automaton(part, counts, bits, tokens, kinds, texts, priors)
            starts = part.off[:-1]
            known.append(np.add.reduceat((model.count[part.tokens] > 0).astype(np.int64), starts))
            base.append(np.add.reduceat(model.root_weight[part.tokens], starts))
            score.append(model.traverse(part))
        known, base, score = (np.concatenate(x) for x in (known, base, score))
        return pa.table({"doc_id": pa.array(row["ids"], pa.int64()), "held_out": held_out(row["ids"]), "n_tokens": block.sizes, "n_known": known, "train_tokens": np.full(len(base), tokens, np.int64), "base_score": base, "score": score})

    return run


def lm_scores(docs: DataFrame, block_bytes: int = BLOCK_BYTES, fan: int = FAN, priors: tuple[float, float] = (PRIOR2, PRIOR3)) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text)."""
    spark, ws = docs.sparkSession, Workspace(docs.sparkSession, "lm", checksums=False)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.coalesce(tasks_for(docs, estimated_bytes(docs)))  # before blocks are numbered by partition
    blocks = ws.table(texts.mapInArrow(_blocks(block_bytes), _BLOCK), "blocks", packed=True)
    sums = blocks.agg(F.count("*").alias("blocks"), F.sum("n_tokens").alias("all"), F.sum("train_tokens").alias("tokens"), F.sum("train_texts").alias("texts")).first()
    tokens, train_texts = int(sums.tokens or 0), int(sums.texts or 0)
    bits = min(62, max(40, int(sums["all"] or 0).bit_length() + 17))
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sums.blocks)
    sent = blocks.mapInArrow(_send(slots, bits), _MESSAGE)
    answers = ws.table(resolve(ws, sent, int(sums.blocks), fan), "answers", packed=True)
    kinds = answers.where("sender < 0").agg(F.sum("sender").alias("n")).first().n or 0
    del sent
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # so that the shuffles behind the answers can go before the next ones come

    own = blocks.select("block", F.lit(-1).alias("kind"), F.lit(0).cast("long").alias("slot"), "ids", "sizes", "words", "tokens", F.lit(None).cast("binary").alias("data"))
    none = [F.lit(None).cast("array<long>").alias("ids"), *[F.lit(None).cast("binary").alias(c) for c in ("sizes", "words", "tokens")]]
    told = answers.where("data IS NOT NULL").select(F.col("sender").alias("block"), "kind", "slot", *none, "data")
    return ws.result(own.unionByName(told).groupBy("block").applyInArrow(_score(slots, bits, tokens, -int(kinds), train_texts, priors), _OUT))
