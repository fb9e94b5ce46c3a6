"""Operator 3: near-duplicate vectors by sorted projection passes.

In each pass a vector's key is the concatenation of random hashes: the signs of its projections on random directions,
taken about the sample mean. Vectors are sorted by that key; each is compared with the next `WINDOW` in that order by
cosine in double precision, and pairs at or above the threshold are united across passes. The number of passes follows
the number of vectors and their distance from that mean; a table no larger than a window needs one.

Whether the windows were wide enough is measured, not assumed. A partner at the threshold is seen from the mean under an
angle that the vector's own distance from it bounds, so the key bits that both share in enough passes are known for each
vector. Where more vectors than a window share those bits, the pass does not count for that vector; a vector with too
few passes that count is crowded. A pair with one vector that is not crowded is met with probability `RECALL`; the crowded ones
go through passes of their own, about their own mean, as long as that leaves less than half of them, and the rest are
compared all with all, in tiles, of which only those too far apart to hold a link are left out. That comparison costs
the square of the number of crowded vectors in dot products; each vector is sent once for each tile that its own meets,
and there are at most about `MAX_TILES` of those.

The window bounds the comparisons of a pass, not the links counted: links are then counted exactly among all vectors of
a component, in tiles, so a group of near copies wider than the window still gets all its links. That follow-up costs the
square of a component's size in dot products, and sends a vector once for each tile: `FEW_TILES`, or one for each `TILE`
vectors of its component where those are more;
equal vectors count as one vector with a weight. Vectors travel in the precision of their table.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do vectors of
different lengths; a row with a null vec_id takes no part and has a null component_id and kept false; each repeated row
counts as a vector of its own; a pair at exactly the threshold links; an empty table gives an empty result. Columns
besides vec_id and embedding are not looked at, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import Workspace, connected_components, with_group

WINDOW = 2048
BLOCK, BLOCK_BYTES = 16384, 16 << 20  # neighbours in the order that meet in one task, at most
TILE, LEAST_TILE, FEW_TILES = 4096, 256, 8  # a component is cut into so few tiles, or more of TILE, as long as they aren't too small
ROWS_AT_ONCE = 512  # rows of a matrix of cosines
RECALL = 0.995
BITS = 62
MOST = 32  # passes are given up where they would compare every pair so many times
COUNTED = 0.8  # of the passes, that part must count for a vector
CROWD_TILE, MAX_TILES = 8192, 2048
MAX_PIVOTS = 1024  # crowded vectors are dealt to the nearest of so many at most, so that tiles are compact
_SIGN = -(1 << 63)
MEAN_SAMPLE = 4096  # vectors whose mean centres the hashes; only the balance of the signs depends on it
SMALL_GROUPS = 64  # components of one tile share this many groups for each shuffle partition


def _reach(threshold: float) -> float:
    """The largest distance of unit vectors that link, with room for rounding."""
    return math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9


def _agree(radius: np.ndarray, threshold: float) -> np.ndarray:
    """The least probability that a sign is that of a partner, for vectors at distance `radius` from the centre.

    A partner within reach is seen from the centre under an angle of at most asin(reach / radius); 0 if it may be anywhere.
    """
    reach = _reach(threshold)
    return np.where(radius > reach, 1 - np.arcsin(np.minimum(1, reach / np.maximum(radius, reach))) / np.pi, 0)


def passes_for(n: int, threshold: float, window: int = WINDOW, recall: float = RECALL, radius: float = 1.0) -> float:
    """Passes that must count so that a pair at the threshold has been within a window with probability `recall`.

    n vectors sorted by signs are within a window once log2(n/window) agree, with one more to spare, if signs split evenly.
    """
    if n <= window + 1:  # all lie within a window
        return 1
    agree = float(_agree(np.array(radius), threshold))
    met = agree ** (max(0.0, math.log2(n / window)) + 1)
    return max(1, math.ceil(math.log(1 - recall) / math.log(max(1e-12, 1 - met)))) if met > 1e-9 else math.inf


def _clean(kind: str):
    """(vec_id, vec, digest): vec holds the components as `kind`; both are null where the vector can't link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs, digests = [], []
            for value in batch.column("embedding"):
                x = value.values if value.is_valid else None
                x = None if x is None or not len(x) or x.null_count else np.asarray(x.to_numpy(zero_copy_only=False), kind) + np.zeros(1, kind)
                if x is None or not np.isfinite(x).all() or not np.isfinite(norm := np.linalg.norm(x.astype(np.float64))) or norm == 0:
                    vecs.append(None)
                    digests.append(None)
                else:
                    vecs.append(x.tobytes())
                    digests.append(hashlib.blake2b(vecs[-1], digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(vecs, pa.binary()), pa.array(digests, pa.binary())], names=["vec_id", "vec", "digest"])

    return run


def _units(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    raw = column.to_pylist()
    x = np.frombuffer(b"".join(raw), kind).astype(np.float64).reshape(len(raw), -1) if raw else np.zeros((0, 1))
    if len(x):  # a power of two changes no digit
        x = x / np.exp2(np.frexp(np.abs(x).max(axis=1, keepdims=True))[1] - 1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(kind: str, passes: int, counted: int, centres: dict[int, bytes], threshold: float, recall: float, seed: list[int]):
    """One row for each pass: (pass, dim, key, bits, node); bits: how many a partner shares in one of `counted` passes."""
    met = 1 - (1 - recall) ** (1 / counted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)
        for batch in batches:
            sizes = np.array([len(v) // np.dtype(kind).itemsize for v in batch.column("vec").to_pylist()], int)
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                unit = _units(part.column("vec"), kind)
                centre = np.frombuffer(centres[dim]) if dim in centres else np.zeros(dim)
                agree = np.clip(_agree(np.linalg.norm(unit - centre, axis=1), threshold), 1e-9, 1 - 1e-9)
                bits = np.clip(np.floor(math.log(met) / np.log(agree)), 0, BITS).astype(np.int32)
                for p in range(passes):
                    if (dim, p) not in planes:
                        a = np.random.default_rng([*seed, p, int(dim)]).standard_normal((int(dim), BITS))
                        planes[dim, p] = a, centre @ a
                    a, cut = planes[dim, p]
                    key = ((unit @ a) > cut) @ weights
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, p, np.int32)), pa.array(np.full(n, dim, np.int32)), pa.array(key), pa.array(bits), part.column("node")], names=["pass", "dim", "key", "bits", "node"])

    return run


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyspark import TaskContext

    part, seen = TaskContext.get().partitionId(), 0
    for pdf in batches:
        yield pdf.assign(part=part, place=np.arange(seen, seen + len(pdf)))
        seen += len(pdf)


def _window_links(kind: str, threshold: float, window: int):
    """A forest over the pairs of a block whose cosine is high enough; halo rows are the first, from the block before.

    A row without b says that the pass does not count for a: the run of its key's first bits goes on beyond the window.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        rank, dim, key, bits = (table.column(c).to_numpy() for c in ("rank", "dim", "key", "bits"))
        parent = np.arange(len(rank))

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        found, beyond = [], []
        for d in np.unique(dim):
            at = np.flatnonzero(dim == d)
            # Both ends of each stretch of a window; a stretch lies in one block with its halo.
            first, last = at[:-window], at[window:]
            differ = key[first] ^ key[last]
            beyond += [first[differ >> (BITS - bits[first]) == 0], last[differ >> (BITS - bits[last]) == 0]]
            unit = _units(table.column("vec").take(pa.array(at)), kind)
            for lo in range(0, len(at), 256):
                rows = at[lo : lo + 256]
                cols = at[lo : lo + 256 + window]
                near = (unit[lo : lo + 256] @ unit[lo : lo + 256 + window].T) >= threshold
                gap = rank[cols][None, :] - rank[rows][:, None]
                i, j = np.nonzero(near & (gap > 0) & (gap <= window))
                for x, y in zip(rows[i], cols[j], strict=True):
                    rx, ry = root(x), root(y)
                    if rx != ry:
                        parent[ry] = rx
                        found.append((x, y))
        found, beyond = np.array(found, np.int64).reshape(-1, 2), np.unique(np.concatenate(beyond))
        node, of = table.column("node").combine_chunks(), table.column("pass").combine_chunks()
        one = pa.table({"pass": of.take(pa.array(found[:, 0])), "a": node.take(pa.array(found[:, 0])), "b": node.take(pa.array(found[:, 1]))})
        two = pa.table({"pass": of.take(pa.array(beyond)), "a": node.take(pa.array(beyond)), "b": pa.nulls(len(beyond), pa.binary())})
        return pa.concat_tables([one, two])

    return run


def _count_links(kind: str, threshold: float):
    """Links within the components of a group: (node, n), partial sums where a component has several tiles."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("root", "ascending"), ("side", "ascending")])
        side, weight = (table.column(c).to_numpy() for c in ("side", "weight"))
        vecs, root = table.column("vec").combine_chunks(), np.array(table.column("root").to_pylist(), object)
        counts = np.zeros(len(side), np.int64)
        edge = np.flatnonzero(np.r_[True, root[1:] != root[:-1], True])
        for lo, hi in zip(edge, edge[1:], strict=False):
            unit = _units(vecs.slice(lo, hi - lo), kind)
            mid = int(np.searchsorted(side[lo:hi], 0))  # two tiles: those with side -1 against those with side 1
            first = mid or len(unit)
            for at in range(0, first, ROWS_AT_ONCE):
                rows = np.arange(at, min(at + ROWS_AT_ONCE, first))
                near = (unit[rows] @ unit[mid:].T) >= threshold
                if mid:
                    counts[lo + mid : hi] += weight[lo + rows] @ near
                else:
                    near[np.arange(len(rows)), rows] = False
                counts[lo + rows] += near @ weight[lo + mid : hi]
        return pa.table({"node": table.column("node"), "n": counts})

    return run


def _sample(vectors: DataFrame, kind: str) -> tuple[dict[int, bytes], float]:
    """(mean of the unit vectors of a sample, by dimension; their median distance from it)."""
    sums: dict[int, list] = {}
    for row in vectors.orderBy("node").limit(MEAN_SAMPLE).select("vec").collect():
        sums.setdefault(len(row.vec) // np.dtype(kind).itemsize, []).append(_units(pa.array([row.vec], pa.binary()), kind)[0])
    means = {d: np.mean(x, axis=0) for d, x in sums.items()}
    radii = [np.linalg.norm(np.array(x) - means[d], axis=1) for d, x in sums.items()]
    return {d: m.tobytes() for d, m in means.items()}, float(np.median(np.concatenate(radii))) if radii else 1.0


def _pass_links(ws: Workspace, vectors: DataFrame, kind: str, block: int, passes: int, centres: dict[int, bytes], threshold: float, window: int, recall: float, seed: list[int]) -> tuple[DataFrame, DataFrame]:
    """(links (a, b) of the windows, the nodes that are crowded)."""
    spark, counted = vectors.sparkSession, max(1, math.floor(COUNTED * passes))
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = "pass int, dim int, key long, bits int, node binary"
    keyed = vectors.select("node", "vec").mapInArrow(_keys(kind, passes, counted, centres, threshold, recall, seed), schema)
    ordered = keyed.repartitionByRange(shuffles, "pass", "dim", "key", "node").sortWithinPartitions("pass", "dim", "key", "node")
    placed = ws.table(ordered.mapInPandas(_numbered, schema + ", part int, place long"), "placed")
    # Ranks: at most one row for each partition and pass comes to the driver.
    starts, total = [], 0
    for part, size in sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()):
        starts.append((part, total))
        total += size
    offsets = F.broadcast(spark.createDataFrame(starts or [(0, 0)], "part int, start long"))
    ranked = placed.join(offsets, "part").withColumn("rank", F.col("start") + F.col("place")).withColumn("block", F.floor(F.col("rank") / block))
    tail = F.col("rank") % block >= block - window
    blocks = ranked.select("node", "rank", "pass", "dim", "key", "bits", F.explode(F.when(tail, F.array("block", F.col("block") + 1)).otherwise(F.array("block"))).alias("block"))
    # A block may hold the end of one pass and the start of the next: they are told apart by (pass, block).
    compared = blocks.join(vectors.select("node", "vec"), "node").groupBy("pass", "block").applyInArrow(_window_links(kind, threshold, window), "pass int, a binary, b binary")
    found = ws.table(compared, "compared")
    crowded = found.where("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.count_distinct("pass").alias("n")).where(F.col("n") > passes - counted).select("node")
    return found.where("b IS NOT NULL").select("a", "b").distinct(), crowded


def _cells(kind: str, pivots: dict[int, np.ndarray]):
    """(node, vec, dim, cell): cell is the nearest pivot of the vector's dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) // np.dtype(kind).itemsize for v in batch.column("vec").to_pylist()], int)
            for dim in np.unique(sizes):
                part = batch.filter(pa.array(sizes == dim))
                near = (_units(part.column("vec"), kind) @ pivots[dim].T).argmax(1) if dim in pivots else np.zeros(part.num_rows, int)
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("vec"), pa.array(np.full(part.num_rows, dim, np.int32)), pa.array(near.astype(np.int32))], names=["node", "vec", "dim", "cell"])

    return run


def _ball(kind: str):
    """The centre of a tile and the distance of its farthest vector."""

    def run(table: pa.Table) -> pa.Table:
        unit = _units(table.column("vec"), kind)
        centre = unit.mean(0)
        return pa.table({"dim": table.column("dim")[:1], "cell": table.column("cell")[:1], "tile": table.column("tile")[:1], "centre": pa.array([centre.tobytes()], pa.binary()), "radius": [float(np.linalg.norm(unit - centre, axis=1).max())]})

    return run


def _tile_links(kind: str, threshold: float):
    """A forest over the links between two tiles (side 0 and 1), or within one."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        unit = _units(table.column("vec"), kind)
        rows = np.flatnonzero(side == 0)
        cols = rows if len(rows) == len(side) else np.flatnonzero(side == 1)
        near = np.concatenate([(unit[rows[lo : lo + ROWS_AT_ONCE]] @ unit[cols].T) >= threshold for lo in range(0, len(rows), ROWS_AT_ONCE)])
        if cols is rows:
            np.fill_diagonal(near, False)
        left, free = near.any(1), np.ones(len(cols), bool)
        found = []
        for i in np.flatnonzero(left):
            if not left[i]:
                continue
            left[i] = False
            front = np.array([i])
            while len(front):  # a search in breadth, a side at a time
                met = np.flatnonzero(near[front].any(0) & free)
                free[met] = False
                found += [(rows[i], cols[j]) for j in met if cols[j] != rows[i]]
                front = np.flatnonzero(near[:, met].any(1) & left)
                left[front] = False
                found += [(rows[i], rows[j]) for j in front]
        found, node = np.array(found, np.int64).reshape(-1, 2), table.column("node").combine_chunks()
        return pa.table({"a": node.take(pa.array(found[:, 0])), "b": node.take(pa.array(found[:, 1]))})

    return run


def _all_links(ws: Workspace, vectors: DataFrame, kind: str, threshold: float, size: int = CROWD_TILE) -> DataFrame:
    """Links (a, b) that join the same vectors as those of all pairs do."""
    spark, n = vectors.sparkSession, vectors.count()
    size = max(size, -(-n // MAX_TILES))  # the tiles' balls, and which of them meet, are listed on the driver
    pivots: dict[int, list] = {}
    for row in vectors.orderBy(F.xxhash64("node")).limit(min(MAX_PIVOTS, -(-n // size))).select("vec").collect():
        pivots.setdefault(len(row.vec) // np.dtype(kind).itemsize, []).append(_units(pa.array([row.vec], pa.binary()), kind)[0])
    dealt = ws.table(vectors.select("node", "vec").mapInArrow(_cells(kind, {d: np.array(x) for d, x in pivots.items()}), "node binary, vec binary, dim int, cell int"), "cells")
    tiles = dealt.groupBy("dim", "cell").agg(F.ceil(F.count("*") / size).cast("int").alias("tiles"))
    dealt = dealt.join(F.broadcast(tiles), ["dim", "cell"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).drop("tiles")
    balls = dealt.groupBy("dim", "cell", "tile").applyInArrow(_ball(kind), "dim int, cell int, tile int, centre binary, radius double").orderBy("dim", "cell", "tile").collect()
    pairs = []
    for i, x in enumerate(balls):
        own = np.frombuffer(x.centre)
        for j in range(i, len(balls)):
            y = balls[j]
            if x.dim == y.dim and (i == j or np.linalg.norm(own - np.frombuffer(y.centre)) <= x.radius + y.radius + _reach(threshold)):
                pairs += [(x.dim, x.cell, x.tile, i, j, 0)] + [(y.dim, y.cell, y.tile, i, j, 1)] * (i != j)
    wanted = spark.createDataFrame(pairs, "dim int, cell int, tile int, t1 int, t2 int, side int")
    return dealt.join(wanted, ["dim", "cell", "tile"]).select("node", "vec", "t1", "t2", "side").groupBy("t1", "t2").applyInArrow(_tile_links(kind, threshold), "a binary, b binary")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, window: int = WINDOW, recall: float = RECALL, seed: int = 3) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of `vectors` (vec_id, embedding)."""
    spark, ws = vectors.sparkSession, Workspace(vectors.sparkSession, "embedding")
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"  # single precision is kept as it is
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if kind == "<f4" else "array<double>").alias("embedding"))
    clean = ws.table(rows.mapInArrow(_clean(kind), "vec_id long, vec binary, digest binary"), "clean")
    usable = clean.where("vec_id IS NOT NULL AND digest IS NOT NULL")
    # A class is known by its smallest id, in bytes that sort as ids do, and its vectors' digest: an id on rows with different
    # vectors does no harm, and the least node of a component holds its smallest id.
    known = usable.groupBy("digest").agg(F.min_by("vec", "vec_id").alias("vec"), F.min("vec_id").alias("rep"), F.count("*").alias("weight"))
    flipped = F.lpad(F.hex(F.col("rep").bitwiseXOR(F.lit(_SIGN))), 16, "0")
    classes = ws.table(known.select(F.concat(F.unhex(flipped), F.col("digest")).alias("node"), "digest", "vec", "rep", "weight"), "classes")
    n, widest = classes.agg(F.count("*"), F.max(F.octet_length("vec"))).first()
    block = max(window, min(BLOCK, BLOCK_BYTES // (widest or 1)))

    rest, parts = classes.select("node", "vec"), []
    for level in itertools.count():
        if not n:
            break
        centres, radius = _sample(rest, kind)
        passes = passes_for(n, threshold, window, recall, radius)
        if n > window + 1:
            passes /= COUNTED
            if 2 * window * passes >= MOST * n:
                break
        links, crowded = _pass_links(ws, rest, kind, block, math.ceil(passes), centres, threshold, window, recall, [seed, level])
        parts.append(links)
        rest = ws.table(rest.join(crowded, "node", "left_semi"), "crowded")
        before, n = n, rest.count()
        if 2 * n > before:
            break
    if n:
        parts.append(_all_links(ws, rest, kind, threshold))
    links = ws.table(functools.reduce(DataFrame.unionAll, parts), "links") if parts else spark.createDataFrame([], "a binary, b binary")

    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    roots = ws.table(connected_components(ws, links), "roots")
    tile = F.greatest(F.lit(LEAST_TILE), F.least(F.lit(TILE), F.ceil(F.count("*") / FEW_TILES)))
    sized = with_group(roots, "root", "node", roots.count(), F.ceil(F.count("*") / tile).cast("int").alias("tiles"))
    groups = max(1, shuffles) * SMALL_GROUPS
    tiled = (
        sized.join(classes.select("node", "vec", "weight"), "node")
        .withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
        .select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other"))
        .select(
            "root", "node", "vec", "weight",
            F.when(F.col("tiles") == 1, F.pmod(F.xxhash64("root"), F.lit(groups))).alias("small"),
            F.when(F.col("tiles") > 1, F.col("root")).alias("large"),
            F.least("tile", "other").alias("t1"), F.greatest("tile", "other").alias("t2"),
            F.when(F.col("tile") < F.col("other"), -1).when(F.col("tile") > F.col("other"), 1).otherwise(0).alias("side"),
        )
    )
    counted = tiled.groupBy("small", "large", "t1", "t2").applyInArrow(_count_links(kind, threshold), "node binary, n long").groupBy("node").agg(F.sum("n").alias("n"))

    smallest = F.conv(F.hex(F.substring("root", 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))
    grouped = roots.select("node", smallest.alias("component_id")).join(counted, "node")
    final = classes.select("node", "digest", "rep", "weight").join(grouped, "node", "left")
    final = final.select("digest", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = clean.withColumn("digest", F.when(F.col("vec_id").isNotNull(), F.col("digest"))).select("vec_id", "digest").join(final, "digest", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return ws.result(out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept")))
