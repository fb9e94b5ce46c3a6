"""Operator 4: near-duplicate documents by SetSketch registers.

A document's set is its distinct runs of five words (all its words as one where it has fewer). A register keeps
`floor(1 - log_b(h))` of the smallest of exponentially distributed hashes `h` of the set, truncated to `0..q+1`; such
registers merge by maximum and agree between similar sets. Bands of registers are bucket keys. In a bucket every member
is tried against the smallest; then, in buckets that still hold several components, members of different components are
tried against each other, in tiles that hold ids and registers and hand out only the members with a likely partner, so no
group's pairs become rows. A tried pair's similarity is estimated by maximum likelihood from how many registers are
greater, equal and less; pairs not far below the threshold are verified on the full sets, read from the whole texts, which
only documents in such pairs send: in parts of at most `PART` partners, with a document's set made once for each part.

Equal sets are one class from the start, so exact copies cost one row each whatever their number. No bucket is capped.
At a similarity of exactly 0.75 a pair shares no band with probability about 3e-5 (36 bands of 5).

Edge cases: a null or empty text, or one without words, has `n_shingles` 0 and links with nothing; a row with a null
doc_id links with nothing and has a null component_id and kept false; rows that repeat a doc_id are one document if
their texts have equal sets, and else link through that id, and repeats of a row are reduced before texts are compared;
a pair at exactly the threshold links; a text is read whole however long, one task holding the texts of a part at a time;
an empty table gives an empty result. Columns besides doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import U64, Workspace, binary_array, connected_components, mix, shingles, sorted_sets, text_chunks, with_group, word_hashes, word_spans

WORDS = 5
BANDS, ROWS = 36, 5
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.02, 20.0, 2046  # b, a, q of the sketch
TILE = 512  # members of a bucket that meet as ids and registers
MOST_TILES = 32  # of one component or of the others, beyond which tiles without texts grow
PART = 512  # partners of a document, and members of a tile with texts, that one task holds together
MARGIN = 5.0  # standard errors below the threshold at which an estimate still gets verified

_RNG = np.random.default_rng(20210101)
_XOR = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_MUL = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def document_sets(buf: np.ndarray, off: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    spans = word_spans(buf, off)
    return sorted_sets(*shingles(word_hashes(buf, spans), spans.off, words))


def registers(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """uint16 registers of each document's set; zeros for an empty set."""
    size = np.diff(off)
    full = np.flatnonzero(size)
    out = np.zeros((len(size), REGISTERS), np.uint16)
    if len(full):
        least = np.empty((REGISTERS, len(full)), U64)
        starts, work = off[:-1][full], np.empty_like(values)
        for i in range(REGISTERS):
            np.bitwise_xor(values, _XOR[i], out=work)
            np.multiply(work, _MUL[i], out=work)
            least[i] = np.minimum.reduceat(work, starts)
        h = -np.log1p(-(least.T.astype(np.float64) + 0.5) / 2.0**64) / RATE
        out[full] = np.clip(np.floor(1 - np.log(np.maximum(h, 1e-300)) / np.log(BASE)), 0, TOP + 1)
    return out


def likely_similarity(greater: np.ndarray, less: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of greatest likelihood, on a grid of hundredths, given the sizes of both sets."""
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 101)[None, :] * np.minimum(n_a / n_b, n_b / n_a)[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return np.clip(-np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE), 1e-9, 1)

    up, down = p(u - v * grid), p(v - u * grid)
    equal = REGISTERS - greater - less
    score = greater[:, None] * np.log(up) + less[:, None] * np.log(down) + equal[:, None] * np.log(np.maximum(1 - up - down, 1e-9))
    return grid[np.arange(len(grid)), score.argmax(1)]


def least_estimate(threshold: float) -> float:
    return threshold - MARGIN * (threshold * (1 - threshold) / REGISTERS) ** 0.5


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, set_key, regs): set_key is a 128-bit digest of the whole set, null for an empty one."""
    for batch in batches:
        for c in text_chunks(batch.column("text")):
            values, off = document_sets(c.buf, c.off)
            regs = registers(values, off)
            keys = [hashlib.blake2b(values[a:b], digest_size=16).digest() if b > a else None for a, b in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(c.lo, c.hi - c.lo), pa.array(np.diff(off)), pa.array(keys, pa.binary()), binary_array(regs)],
                names=["doc_id", "n_shingles", "set_key", "regs"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS).astype(np.int16)


def _estimates(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                a, b = _matrix(part.column("regs_a")), _matrix(part.column("regs_b"))
                est = likely_similarity((a > b).sum(1), (a < b).sum(1), part.column("n_a").to_numpy().astype(float), part.column("n_b").to_numpy().astype(float))
                keep.append(est >= least)
            if keep:
                yield batch.select(["a", "b"]).filter(pa.array(np.concatenate(keep)))

    return run


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of rows, sorted by these columns, in which all are equal."""
    if not len(columns[0]):
        return []
    edge = np.flatnonzero(np.r_[True, np.logical_or.reduce([c[1:] != c[:-1] for c in columns]), True])
    return list(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True))


_TILE_KEY = ["bucket", "t1", "t2"]


def _tiles(table: pa.Table) -> Iterator[pa.Table]:
    table = table.sort_by([(c, "ascending") for c in _TILE_KEY]).combine_chunks()
    for lo, hi in _runs(*(table.column(c).to_numpy() for c in _TILE_KEY)):
        yield table.slice(lo, hi - lo)


class _Pairs:
    """Pairs of members of a pair of tiles that may be linked, though their components differ.

    A pair that shares several buckets is looked at in that of the lowest band only; pairs with a bucket's smallest
    member have been tried before.
    """

    def __init__(self, table: pa.Table, least: float, percent: int):
        self.node, self.root, lead, self.band, self.side = (table.column(c).to_numpy() for c in ("rep", "root", "lead", "band", "side"))
        self.size = table.column("n_shingles").to_numpy().astype(float)
        self.regs = _matrix(table.column("regs").combine_chunks())
        self.least, self.percent = least, percent
        own = self.node != lead
        self.left, self.right = np.flatnonzero((self.side <= 0) & own), np.flatnonzero((self.side >= 0) & own)

    def of(self, i: int) -> np.ndarray:
        right, size, regs = self.right, self.size, self.regs
        ratio = 100 * np.minimum(size[right], size[i]) >= self.percent * np.maximum(size[right], size[i])
        j = right[(self.root[right] != self.root[i]) & ratio & ((self.side[right] != self.side[i]) | (self.node[right] > self.node[i]))]
        if len(j):
            j = j[(regs[j] == regs[i]).reshape(len(j), BANDS, ROWS).all(2).argmax(1) == self.band[i]]
        if len(j):
            est = likely_similarity((regs[i] > regs[j]).sum(1), (regs[i] < regs[j]).sum(1), np.full(len(j), size[i]), size[j])
            j = j[est >= self.least]
        return j


def _likely(least: float, percent: int):
    """The rows of a group of tile pairs that are in any pair that may be linked."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for tile in _tiles(table):
            pairs, hit = _Pairs(tile, least, percent), np.zeros(tile.num_rows, bool)
            for i in pairs.left:
                j = pairs.of(i)
                hit[j] = True
                hit[i] |= len(j) > 0
            if hit.any():
                out.append(tile.filter(pa.array(hit)))
        return (pa.concat_tables(out) if out else table.slice(0, 0)).select([f.split()[0] for f in _MEMBER.split(", ")])

    return run


def _tile_links(least: float, percent: int):
    """Verified links between different components; a document's set is made once for a pair of tiles, when first needed."""

    def run(table: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        for tile in _tiles(table):
            pairs, text, sets, up = _Pairs(tile, least, percent), tile.column("text").combine_chunks(), {}, {}

            def root(x: int, up: dict = up) -> int:
                while up.setdefault(x, x) != x:
                    x = up[x]
                return x

            def own(k: int, text: pa.Array = text, sets: dict = sets) -> np.ndarray:
                if k not in sets:
                    sets[k] = _one_set(text[k])
                return sets[k]

            for i in pairs.left:
                for k in pairs.of(i):
                    a, b = root(pairs.root[i]), root(pairs.root[k])
                    if a != b and _similar(own(i), own(k), percent):
                        up[max(a, b)] = min(a, b)
                        found.append((min(pairs.node[i], pairs.node[k]), max(pairs.node[i], pairs.node[k])))
        out = np.array(found, np.int64).reshape(-1, 2)
        return pa.table({"a": out[:, 0], "b": out[:, 1]})

    return run


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = np.concatenate([left, right])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return common > 0 and 100 * common >= percent * (len(left) + len(right) - common)


def _verified(percent: int):
    """Links of a group of parts: each holds a document `a` and its partners, an id with as many rows as it has texts."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("a", "ascending"), ("part", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        a, part, ids, text = *(table.column(c).to_numpy() for c in ("a", "part", "doc_id")), table.column("text")
        left, right = [], []
        for lo, hi in _runs(a, part):
            own = [_one_set(text[k]) for k in range(lo, hi) if ids[k] == a[lo]]
            for x, y in _runs(ids[lo:hi]):
                if ids[lo + x] != a[lo] and any(_similar(o, other, percent) for other in (_one_set(text[k]) for k in range(lo + x, lo + y)) for o in own):
                    left.append(a[lo])
                    right.append(ids[lo + x])
        return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})

    return run


def _verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar; texts has one row for each text of an id."""
    shuffles, n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs.count()
    cut = with_group(pairs, "a", "b", n, F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    cut = cut.select("a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"), "b")
    ids = cut.select("a", "part", F.col("b").alias("doc_id")).unionAll(cut.select("a", "part").distinct().select("a", "part", F.col("a").alias("doc_id")))
    group = F.pmod(F.xxhash64("a", "part"), F.lit(max(shuffles, -(-n // PART))))
    return ids.join(texts, "doc_id").withColumn("group", group).groupBy("group").applyInArrow(_verified(percent), "a long, b long")


def _one_set(text: pa.Scalar) -> np.ndarray:
    buf = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
    return document_sets(buf, np.array([0, len(buf)]))[0]


_MEMBER = "bucket long, rep long, root long, lead long, band int, n_shingles long, regs binary"


def _tile_count(members: Column, size: int, most: int | None) -> Column:
    """Tiles of about `size` members; beyond `most` of them tiles grow, too, both with the square root of the members."""
    tiles = members / size
    return F.ceil(tiles if most is None else F.least(tiles, F.sqrt(tiles * most))).cast("int")


def _dealt(members: DataFrame, sets: list[DataFrame], size: int, rows: int, most: int | None = None) -> DataFrame:
    """Members of buckets that hold several components in tiles of about `size`, each row once for each pair of tiles that it is in.

    A bucket with more than `size` members has tiles of its own for its largest component, the first ones, which don't meet
    each other: linked members aren't compared, so their rows only follow the number of tiles of all others. `sets` are
    joined by `rep` before rows are repeated. The tiles of small buckets share groups; members has at most `rows` rows.
    """
    groups = max(int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // size))
    sizes = members.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("_rows"))
    split = F.col("_rows") > size
    first = F.when(split, _tile_count(F.col("main.n"), size, most)).otherwise(0)
    rest = F.when(split, F.greatest(_tile_count(F.col("_rows") - F.col("main.n"), size, most), F.lit(1))).otherwise(1)
    sizes = sizes.select("bucket", "_rows", F.col("main.root").alias("main"), first.alias("first"), rest.alias("rest"), (F.col("main.n") < F.col("_rows")).alias("apart"))
    tiled = with_group(members, "bucket", "rep", rows, group=sizes).where("apart")
    for own in sets:
        tiled = tiled.join(own, "rep")
    linked = (F.col("first") > 0) & (F.col("root") == F.col("main"))
    place = F.xxhash64("rep", F.lit(size))
    tiled = tiled.withColumn("tile", F.when(linked, F.pmod(place, F.greatest("first", F.lit(1)))).otherwise(F.col("first") + F.pmod(place, F.col("rest"))).cast("int"))
    tiled = tiled.select("*", F.explode(F.sequence(F.when(linked, F.col("first")).otherwise(0), F.col("first") + F.col("rest") - 1)).alias("other"))
    side = F.when(F.col("tile") < F.col("other"), -1).when(F.col("tile") > F.col("other"), 1).otherwise(0)
    tiled = tiled.withColumns({"t1": F.least("tile", "other"), "t2": F.greatest("tile", "other"), "side": side}).drop("main", "first", "rest", "apart", "tile", "other")
    group = F.when(F.col("t2") == 0, F.pmod(F.xxhash64("bucket"), F.lit(groups))).otherwise(F.xxhash64(*_TILE_KEY))
    return tiled.withColumn("group", group)


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs` (doc_id, text)."""
    spark, ws, threshold = docs.sparkSession, Workspace(docs.sparkSession, "minhash"), percent / 100
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = ws.table(texts.mapInArrow(sketches, "doc_id long, n_shingles long, set_key binary, regs binary"), "sketch")

    whole = sketch.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = ws.table(whole.groupBy("set_key").agg(F.min_by(F.struct("n_shingles", "regs"), "doc_id").alias("x"), F.min("doc_id").alias("rep")).select("set_key", "rep", "x.n_shingles", "x.regs"), "classes")
    # An id that stands on rows with different sets joins those classes.
    repeats = ws.table(whole.groupBy("doc_id").agg(F.min("set_key").alias("k1"), F.max("set_key").alias("k2"), F.count("*").alias("n")).where("n > 1"), "repeats")
    apart = whole.join(repeats.where("k1 <> k2").select("doc_id"), "doc_id").select("doc_id", "set_key").distinct()
    same_id = apart.join(classes.select("set_key", "rep"), "set_key").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    width = 2 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("regs", i * width + 1, width)) for i in range(BANDS)])
    members = classes.select("rep", F.posexplode(keys).alias("band", "bucket"))
    led = with_group(members, "bucket", "rep", BANDS * classes.count(), F.min("rep").alias("lead"), F.max("rep").alias("last"))
    shared = ws.table(led.where("lead <> last").select("bucket", "rep", "band", "lead"), "shared")
    sets = classes.select("rep", "n_shingles", "regs")

    def texts_of(ids: DataFrame) -> DataFrame:
        """One row for each text of these ids; equal rows are reduced before they are dealt out."""
        found = texts.where("doc_id IS NOT NULL").join(ids.hint("shuffle_hash"), "doc_id")
        if not repeated:
            return found
        return found.groupBy("doc_id", F.xxhash64("text").alias("of")).agg(F.max("text").alias("text")).select("doc_id", "text")

    repeated = not repeats.isEmpty()
    least = least_estimate(threshold)
    first = shared.where("rep <> lead").select(F.col("lead").alias("a"), F.col("rep").alias("b")).distinct()
    first = first.join(sets.select(F.col("rep").alias("a"), F.col("n_shingles").alias("n_a"), F.col("regs").alias("regs_a")), "a")
    first = first.join(sets.select(F.col("rep").alias("b"), F.col("n_shingles").alias("n_b"), F.col("regs").alias("regs_b")), "b")
    first = ws.table(first.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).mapInArrow(_estimates(least), "a long, b long"), "first")
    wanted = first.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    links = ws.table(_verify(first, texts_of(wanted), percent), "links")
    labels = connected_components(ws, links)

    placed = shared.join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    placed = ws.table(placed, "placed")
    met = _dealt(placed, [sets], TILE, placed.count(), MOST_TILES).groupBy("group").applyInArrow(_likely(least, percent), _MEMBER)
    likely = ws.table(met.dropDuplicates(["bucket", "rep"]), "likely")
    # Texts meet in smaller tiles, and only those with a likely partner.
    more = texts_of(likely.select(F.col("rep").alias("doc_id")).distinct()).withColumnRenamed("doc_id", "rep")
    both = _dealt(likely, [more], PART, likely.count())
    links2 = ws.table(both.groupBy("group").applyInArrow(_tile_links(least, percent), "a long, b long").distinct(), "links")

    roots = connected_components(ws, links.unionByName(links2).unionByName(same_id)).withColumnRenamed("node", "rep")
    final = classes.select("set_key", "rep").join(roots, "rep", "left").select("set_key", F.coalesce("root", "rep").alias("component_id"))
    out = sketch.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return ws.result(out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")))
