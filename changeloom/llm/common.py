"""What the operators of this subpackage share: a shared work folder, Arrow text
access, vectorised word hashing, and connected components.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D; `A-Z` is folded to
`a-z`. Texts are handled whole, in sub-batches of about a megabyte (one text alone
where it is longer), so a worker's memory follows the longest single text.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

U64 = np.uint64
CHUNK_BYTES = 1 << 20
ROWS_A_TASK, LEAST_TASKS = 50_000, 4  # of small rows, where a table's number of rows is known before it is written
TASK_BYTES, LEAST_ROUNDS = 64 << 20, 2  # of input; a core gets at least so many tasks
GROUP_BYTES = 4 << 20  # of a row group of packed rows: writing holds one, and reading makes a batch of each
#: No checksum files beside those of a local file system: an executor's JVM starts a process to set the mode of each file.
PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}
PACKED = {"compression": "uncompressed", "parquet.block.size": GROUP_BYTES, "parquet.page.size.row.check.min": 1, "parquet.enable.dictionary": "false"}


# ------------------------------------------------------------------ shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`; a temporary one only for a local master without it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jvm_dir.isDefined():
        return jvm_dir.get().rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    own = "file://" + tempfile.mkdtemp(prefix="changeloom-")
    spark.sparkContext.setCheckpointDir(own)
    return own


class Workspace:
    """Intermediate tables in the shared folder: they cut lineage and survive lost executors.

    Each table is written by Spark's own committer under a folder with a fresh name. An operator that returns `result` leaves
    only that; what is left goes when the driver ends. `checksums` is about a local file system only.
    """

    def __init__(self, spark: SparkSession, name: str, checksums: bool = True):
        self.spark, self.checksums = spark, checksums
        self.path = f"{shared_dir(spark)}/changeloom-{name}-{uuid.uuid4().hex}"
        self.count = 0
        self.tables: list[str] = []
        atexit.register(self.clear)

    def fresh(self, name: str) -> str:
        self.count += 1
        return f"{self.path}/{self.count:03d}-{name}"

    def table(self, df: DataFrame, name: str = "t", rows: int | None = None, packed: bool = False) -> DataFrame:
        """The rows of df, written and read again; `rows`, where a bound on their number is known, keeps files from being tiny.

        `packed` is for rows of large compressed binaries: in a row group of Parquet's usual size a task would hold all of them.
        """
        path = self.fresh(name)
        if rows is not None:
            df = df.coalesce(max(LEAST_TASKS, -(-rows // ROWS_A_TASK)))
        df.write.options(**(PACKED if packed else {"compression": "zstd"}), **({} if self.checksums else PLAIN_FILES)).parquet(path)
        self.tables.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._work_path = path
        return out

    def result(self, df: DataFrame) -> DataFrame:
        """The rows of df, written; all other tables of this workspace go."""
        before = list(self.tables)
        out = self.table(df, "result")
        for path in before:
            self.remove(path)
        return out

    def drop(self, df: DataFrame) -> None:
        self.remove(df._work_path)

    def remove(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def clear(self) -> None:
        context = self.spark.sparkContext
        if context._jsc is not None and not context._jsc.sc().isStopped():
            self.remove(self.path)


def tasks_for(df: DataFrame, size: int) -> int:
    """A bound on the tasks that read so many bytes."""
    return min(1 << 20, max(LEAST_ROUNDS * df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES)))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate, without running anything; very large where it has none."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


# ------------------------------------------------------------------ Arrow access


class Chunk(NamedTuple):
    lo: int  # rows [lo, hi) of the batch
    hi: int
    buf: np.ndarray  # their text, as bytes
    off: np.ndarray  # int64, hi - lo + 1 offsets into buf


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Runs of rows of about `limit` bytes; a longer text comes alone."""
    buf, off = text_buffers(column)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield Chunk(lo, hi, buf[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        lo = hi


def binary_array(values: np.ndarray) -> pa.Array:
    """A fixed-width matrix of n rows as n binary values."""
    n = len(values)
    raw = np.ascontiguousarray(values)
    width = raw.nbytes // n if n else 0
    offsets = (np.arange(n + 1, dtype=np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(raw.tobytes())])


# ------------------------------------------------------------------ words and hashes

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(0x5EED).integers(1, 1 << 63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BYTE_LOWER = _BYTE[_LOWER]
_MULT = 0x9E3779B97F4A7C15 | 5  # odd, 5 modulo 8: successive powers differ in all but the lowest bits
_MULT = (_MULT & ~7) | 5
_MULT_INV = pow(_MULT, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}
_SEEDS = np.random.default_rng(0xC0FFEE).integers(1, 1 << 63, 64, dtype=np.int64).astype(U64) * U64(2) + U64(1)


def _powers(kind: str, n: int) -> np.ndarray:
    have = _POWERS.get(kind)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << int(n - 1).bit_length())
        steps = np.full(size, _MULT if kind == "up" else _MULT_INV, U64)
        steps[0] = 1
        have = _POWERS[kind] = np.multiply.accumulate(steps)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; returns a new array."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class Words(NamedTuple):
    start: np.ndarray  # byte positions
    end: np.ndarray
    off: np.ndarray  # word offsets of the documents


def word_spans(buf: np.ndarray, off: np.ndarray, blank: np.ndarray = _BLANK) -> Words:
    """Maximal runs of bytes outside `blank`, within each document."""
    n = len(buf)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(off), np.int64))
    solid = ~blank[buf]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = off[(off > 0) & (off < n)]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, off))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans: differences of one running polynomial, then a finaliser."""
    running = np.zeros(len(buf) + 1, U64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * _powers("up", max(1, len(buf)))[: len(buf)], out=running[1:])
    h = running[end] - running[start]
    h *= _powers("down", max(1, len(buf)))[start]
    return mix(h + (end - start).astype(U64) * _SEEDS[63])


def word_hashes(buf: np.ndarray, words: Words) -> np.ndarray:
    return span_hashes(buf, words.start, words.end)


def shingles(hashes: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, document offsets) of runs of k words; a shorter document's words are one shingle, no word gives none."""
    size = np.diff(off)
    long = size >= k
    count = np.where(long, size - k + 1, size > 0)
    out_off = np.zeros(len(off), np.int64)
    np.cumsum(count, out=out_off[1:])
    out = np.empty(out_off[-1], U64)
    n = len(hashes)
    in_long = np.repeat(long, count)
    if n >= k:
        run = hashes[: n - k + 1] * _SEEDS[0]
        for j in range(1, k):
            run += hashes[j : n - k + 1 + j] * _SEEDS[j]
        fits = np.arange(k, n + 1) <= np.repeat(off[1:], size)[: n - k + 1]
        out[in_long] = mix(run[fits])
    short = np.flatnonzero((size > 0) & ~long)
    if len(short):
        acc = size[short].astype(U64) * _SEEDS[62]
        for j in range(k - 1):
            has = size[short] > j
            acc[has] += hashes[off[short[has]] + j] * _SEEDS[32 + j]
        out[~in_long] = mix(acc)
    return out, out_off


def sorted_sets(values: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each document's values sorted and without repeats."""
    values = values.copy()
    for i in np.flatnonzero(np.diff(off) > 1):
        values[off[i] : off[i + 1]].sort()
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    starts = off[:-1][np.diff(off) > 0]
    new[starts] = True
    kept = np.zeros(len(values) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return values[new], kept[off]


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


# ------------------------------------------------------------------ hot keys

HUB_ROWS, MAX_HUBS, SALTS = 512, 1024, 64


def with_group(rows: DataFrame, key: str, by: str, n: int, *aggregates: Column, group: DataFrame | None = None) -> DataFrame:
    """Rows with aggregates over all rows of their key, of which no task gets very many.

    rows has at most n rows. `group` stands for the aggregates where they take more than one step: a row for each key, with
    its number of rows as `_rows`. Keys with more than `HUB_ROWS` and an n-th of `MAX_HUBS` are fewer than those, so their list may
    be broadcast; their rows are dealt over `SALTS` tasks by the column `by`. A join with an aggregate isn't split by the
    optimizer. Aggregates come from partial ones, so they meet in no task either.
    """
    most = max(HUB_ROWS, -(-n // MAX_HUBS))
    if group is None:
        group = rows.groupBy(key).agg(*aggregates, F.count("*").alias("_rows"))
    hubs = group.where(F.col("_rows") > most).select(F.col(key).alias("_hub"))
    salt = F.when(F.col("_hub").isNotNull(), F.pmod(F.xxhash64(by), F.lit(SALTS))).otherwise(0).cast("int")
    dealt = rows.join(F.broadcast(hubs), F.col(key) == F.col("_hub"), "left").withColumn("_salt", salt).drop("_hub")
    salts = F.when(F.col("_rows") > most, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(group.withColumn("_salt", F.explode(salts)).drop("_rows"), [key, "_salt"]).drop("_salt")


# ------------------------------------------------------------------ connected components


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of `edges` (a, b); root is the smallest node reachable.

    Alternates large-star and small-star steps on the edge table until it is a forest of stars. A hub's neighbours are
    reduced with map-side minima and met again in many tasks (`with_group`); rounds are logarithmic.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = ws.table(e, "edges")
    while True:
        n = e.count()
        forest = (
            e.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("x"))
            .groupBy("x.n").agg(F.sum("x.up").alias("up"), F.max("x.down").alias("down"))
            .where("up > 1 OR (up > 0 AND down > 0)")
        )
        if forest.isEmpty():
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = e.select(F.col("u").alias("s"), F.col("v").alias("d")).unionAll(e.select(F.col("v").alias("s"), F.col("u").alias("d")))
        met = with_group(both, "s", "d", 2 * n, F.min("d").alias("m"))
        large = met.where("d > s").select(F.col("d").alias("u"), F.least("s", "m").alias("v")).distinct()
        large = ws.table(large, "large", 2 * n)
        met = with_group(large, "u", "v", 2 * n, F.min("v").alias("m"))
        small = met.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.u", "x.v").where("u <> v").distinct()
        new = ws.table(small, "edges", 2 * n)
        ws.drop(large)
        ws.drop(e)
        e = new


# ------------------------------------------------------------------ annotating texts


def fresh_name(taken: list[str], name: str) -> str:
    """`name`, with underscores before it until no column has it (whatever its case)."""
    have = {x.lower() for x in taken}
    while name.lower() in have:
        name = "_" + name
    return name


def annotate(df: DataFrame, text: str, fn: Callable[[np.ndarray, np.ndarray], list], fields: list[tuple[str, str]], keep: list[str], limit: int = CHUNK_BYTES) -> DataFrame:
    """The columns `keep` with those that `fn(bytes, offsets)` computes from the whole texts, in one pass without a shuffle."""
    inner = "text" if text in keep else fresh_name(keep, "text")
    cols = [F.col(f"`{c}`") for c in keep] + ([] if text in keep else [F.col(f"`{text}`").cast("string").alias(inner)])
    source = df.select(*cols)
    at = keep.index(text) if text in keep else len(keep)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in source.schema.fields[: len(keep)]] + [T.StructField(n, T._parse_datatype_string(t), True) for n, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for c in text_chunks(batch.column(at), limit):
                new = [x if isinstance(x, pa.Array) else pa.array(x) for x in fn(c.buf, c.off)]
                old = [batch.column(i).slice(c.lo, c.hi - c.lo) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(old + new, names=schema.names)

    return source.mapInArrow(run, schema)
