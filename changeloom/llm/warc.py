"""Operator 8: WARC archives compressed with a dictionary.

An archive is a run of zstd frames. The first is a skippable frame (magic 0x184D2A5D) that holds the archive's own
dictionary, itself compressed; it is built from a bounded sample of the records the archive holds. Each record follows as
a frame of its own, so it can be read alone once the dictionary is known. A `warcinfo` record leads. Where the records
are too few or too small to build a dictionary from, the archive has none.

Of pages with equal payloads of at least `LEAST_REVISIT` bytes, the one with the smallest page_id is a `response`, the
others are `revisit` records without payload that refer to it. Archives are written by executors to a folder that all
share, under a name of their own and by a rename; the manifest, written by Spark's committer, names the archives that
count, so what a lost or repeated task leaves behind is never read.

Edge cases: a null html is an empty payload; a null url becomes `urn:page:<id>`; blanks and control characters of a url are
percent-encoded; a page without page_id is a response that nothing refers to; rows that repeat a page_id with the same
payload have the same type; a payload is held whole however long, and an archive ends behind a
long one. An empty table gives no archive. Columns besides page_id, url and html are not looked at.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import Workspace

LEAST_REVISIT = 100
ARCHIVE_BYTES = 32 << 20  # of records, before compression
DICTIONARY_BYTES = 112_640
SAMPLE_BYTES, SAMPLE_RECORD = 2 << 20, 32 << 10
LEVEL = 3
# Fixed values of the file formats.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # the tables have no time of capture

MANIFEST = "path string, records long, bytes long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


# ------------------------------------------------------------------ records


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _fields(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", _record_id(page_id, digest)), ("WARC-Date", DATE), ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if page_id is not None:
        fields.append(("X-Page-Id", str(page_id)))
    if url is None:
        fields.append(("X-No-Url", "1"))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    return _fields(fields, block)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"not a {VERSION} record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    length = int(fields["Content-Length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length is wrong")
    return fields, rest[:length]


# ------------------------------------------------------------------ archives


def build_dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """From records spread over the archive, up to SAMPLE_BYTES in all; None where they don't suffice."""
    step = max(1, sum(min(len(r), SAMPLE_RECORD) for r in records) // SAMPLE_BYTES)
    sample = [r[:SAMPLE_RECORD] for r in records[::step]]
    size = min(DICTIONARY_BYTES, sum(map(len, sample)) // 10)
    if len(sample) < 8 or size < 1024:
        return None
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8, f=18, accel=4, level=LEVEL)
    except zstandard.ZstdError:  # the library finds nothing common in them
        return None


def archive_bytes(records: list[bytes]) -> bytes:
    info = _fields([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, hashlib.sha256(b''.join(r[:512] for r in records)).hexdigest())}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
    dictionary, out = build_dictionary(records), []
    if dictionary is not None:
        packed = zstandard.ZstdCompressor(level=19).compress(dictionary.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        dictionary.precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    out += [compressor.compress(r) for r in [info, *records]]
    return b"".join(out)


def read_archive(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records of an archive, one after another, from a binary file; holds one record at a time."""
    buffer, ended = b"", False

    def more() -> None:
        nonlocal buffer, ended
        got = source.read(1 << 20)
        ended = not got
        buffer += got

    def need(n: int) -> bool:
        while len(buffer) < n and not ended:
            more()
        return len(buffer) >= n

    dictionary = None
    if need(8) and struct.unpack("<I", buffer[:4])[0] == DICTIONARY_MAGIC:
        size = struct.unpack("<I", buffer[4:8])[0]
        need(8 + size)
        dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(buffer[8 : 8 + size]))
        buffer = buffer[8 + size :]
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary)
    while need(1):
        stream = decompressor.decompressobj()
        parts = []
        while not stream.eof:
            if not need(1):
                raise ValueError("an archive ends within a record")
            parts.append(stream.decompress(buffer))
            buffer = stream.unused_data if stream.eof else b""
        yield parse_record(b"".join(parts))


# ------------------------------------------------------------------ Spark


def _write(folder: str, archive_size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        records, held = [], 0

        def flush() -> pa.RecordBatch:
            nonlocal records, held
            data = archive_bytes(records)
            name = uuid.uuid4().hex
            with fs.open_output_stream(f"{base}/{name}.part", compression=None) as sink:
                sink.write(data)
            fs.move(f"{base}/{name}.part", f"{base}/{name}.warc.zst")
            out = pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}.warc.zst"]), pa.array([len(records)]), pa.array([len(data)])], names=["path", "records", "bytes"])
            records, held = [], 0
            return out

        fs.create_dir(base, recursive=True)
        for batch in batches:
            ids, urls, digests, refers, html = (batch.column(c) for c in ("page_id", "url", "digest", "refers_to", "html"))
            for i in range(batch.num_rows):
                payload = html[i].as_buffer().to_pybytes() if html[i].is_valid else b""
                records.append(page_record(ids[i].as_py(), urls[i].as_py(), payload, digests[i].as_py(), refers[i].as_py()))
                held += len(records[-1])
                if held >= archive_size:
                    yield flush()
        if records:
            yield flush()

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for path, count in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
            fs, at = pafs.FileSystem.from_uri(path)
            rows = []
            with fs.open_input_stream(at, compression=None) as source:
                for fields, block in read_archive(source):
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = int(head.rpartition(b"Content-Length: ")[2])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"a payload of {path} is damaged")
                    page, refers = fields.get("X-Page-Id"), fields.get("X-Refers-To-Page")
                    url = None if "X-No-Url" in fields else fields["WARC-Target-URI"]
                    rows.append((None if page is None else int(page), url, size, digest, fields["WARC-Type"], None if refers is None else int(refers)))
            if len(rows) != count:
                raise ValueError(f"{path} holds {len(rows)} records, not {count}")
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def write_archives(pages: DataFrame, folder: str, archive_size: int = ARCHIVE_BYTES, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes a record for every row of pages (page_id, url, html) below `folder`; returns the manifest, read from there."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    large = rows.where((F.octet_length("html") >= least) & F.col("page_id").isNotNull()).select("page_id", "digest")
    shared = large.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to < last").select("digest", "refers_to")
    revisits = large.join(shared, "digest").where("page_id > refers_to").distinct()
    # Dealt by page, so a payload that many pages share meets in no task; the join and the archives use the same deal.
    typed = rows.join(revisits, ["page_id", "digest"], "left")
    manifest = typed.select("page_id", "url", "digest", "refers_to", "html").mapInArrow(_write(f"{folder}/archives", archive_size), MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """RECORD rows of the archives that a manifest names; payloads are checked against their digests."""
    dealt = manifest.select("path", "records").repartition(max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return dealt.mapInArrow(_read, RECORD)


def archived(pages: DataFrame) -> DataFrame:
    """Writes all pages to archives in the shared folder and reads them back."""
    ws = Workspace(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, ws.path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
