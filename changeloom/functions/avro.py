"""Wire codec: Avro bodies behind a frame of a zero byte and a four-byte schema id.

The plain DataFrame form of a message is the one to keep; the wire form is made at the boundary, by Arrow batches in
Python, as the connector that would do it in the JVM may not be there. A batch is done by columns (`encode_batch`,
`decode_batch`); `RecordCodec` does a record at a time and is what batches are held against. Decimals are minimal two's
complement.
"""

from __future__ import annotations

import datetime as dt
import json
import struct
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.sql.pandas.types import to_arrow_type

from changeloom.functions import columnar as C
from changeloom.functions import expr as X
from changeloom.model import DECIMAL_TYPES, OPERATION_NAMES, FieldSpec, TableSpec, UnsupportedSqlType

EPOCH = dt.date(1970, 1, 1)
CHECK_EVERY = 50_000  # records of a task between two that are read back
UNKNOWN_COLUMN = "UNKNOWN_COL"  # fixed value: the first symbol of the updated-columns enum

# ------------------------------------------------------------------ primitives


def write_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 127:
        out.append((n & 127) | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_long(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = raw[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return (n >> 1) ^ -(n & 1), at
        shift += 7


def write_bytes(b: bytes) -> bytes:
    return write_long(len(b)) + b


def read_bytes(raw: bytes, at: int) -> tuple[bytes, int]:
    n, at = read_long(raw, at)
    return raw[at : at + n], at + n


def write_decimal(value: Decimal, scale: int) -> bytes:
    sign, digits, exponent = value.as_tuple()
    if not isinstance(exponent, int):
        raise ValueError(f"{value} is not a number")
    n, rest = int("".join(map(str, digits)) or "0"), 0
    if exponent + scale >= 0:
        n *= 10 ** (exponent + scale)
    else:
        n, rest = divmod(n, 10 ** -(exponent + scale))
    if rest:
        raise ValueError(f"{value} has more than {scale} digits after the point")
    n = -n if sign else n
    size = max(1, (n.bit_length() if n >= 0 else (n + 1).bit_length()) // 8 + 1)
    return write_bytes(n.to_bytes(size, "big", signed=True))


def read_decimal(raw: bytes, at: int, scale: int) -> tuple[Decimal, int]:
    b, at = read_bytes(raw, at)
    n = int.from_bytes(b, "big", signed=True)
    return Decimal((int(n < 0), tuple(map(int, str(abs(n)))), -scale)), at


# ------------------------------------------------------------------ schemas

Writer = Callable[[Any], bytes]
Reader = Callable[[bytes, int], tuple[Any, int]]


def wire_type(field: FieldSpec, always_long: bool = False) -> Any:
    kind = field.sql_type.lower()
    if kind in DECIMAL_TYPES:
        if field.precision is None or field.scale is None:
            raise UnsupportedSqlType(f"{field.name} needs a precision and a scale")
        return {"type": "bytes", "logicalType": "decimal", "precision": field.precision, "scale": field.scale}
    named = {
        "bigint": "long", "bit": "boolean", "float": "double", "real": "float", "date": {"type": "int", "logicalType": "date"}, "time": {"type": "int", "logicalType": "time-millis"}, "uniqueidentifier": {"type": "string", "logicalType": "uuid"},
        **{k: "long" if always_long else "int" for k in ("int", "smallint", "tinyint")}, **{k: "bytes" for k in ("binary", "varbinary", "image", "rowversion")},
        **{k: "string" for k in ("datetime", "datetime2", "smalldatetime", "datetimeoffset", "char", "nchar", "varchar", "nvarchar", "text", "ntext", "xml")},
    }
    if kind not in named:
        raise UnsupportedSqlType(field.sql_type)
    return named[kind]


def key_schema(table: TableSpec, always_long: bool = False) -> str:
    by_name = {f.name: f for f in table.fields}
    return json.dumps({"type": "record", "name": f"{table.qualified_name}__key", "fields": [{"name": n, "type": wire_type(by_name[n], always_long)} for n in table.key_names]})


def value_schema(table: TableSpec, always_long: bool = False, overrides: dict[str, Any] | None = None) -> str:
    """overrides: `schema.table.column` (any case) to a wire type; only the schema changes, not the bytes."""
    own = {k.lower(): v for k, v in (overrides or {}).items()}
    optional = lambda t: ["null", t]
    fields = [
        {"name": "__operation", "type": {"type": "enum", "name": "__operation", "symbols": list(OPERATION_NAMES.values())}}, {"name": "__event_time", "type": "string"}, {"name": "__log_lsn", "type": optional("string")},
        {"name": "__command_id", "type": optional("int")}, {"name": "__log_seqval", "type": optional("string")},
        {"name": "__updated_fields", "type": {"type": "array", "items": {"type": "enum", "name": "__updated_fields", "symbols": [UNKNOWN_COLUMN, *table.value_names]}}},
        *({"name": f.name, "type": optional(own.get(f"{table.qualified_name}.{f.name}".lower(), wire_type(f, always_long))), "default": None} for f in table.value_fields),
    ]
    return json.dumps({"type": "record", "name": f"{table.qualified_name}__value", "fields": fields})


# ------------------------------------------------------------------ records


def _field_codec(field: FieldSpec) -> tuple[Writer, Reader]:
    kind = field.sql_type.lower()
    if kind in DECIMAL_TYPES:
        scale = field.scale or 0
        return lambda v: write_decimal(Decimal(v), scale), lambda r, a: read_decimal(r, a, scale)
    wire = wire_type(field)
    if kind == "date":
        return lambda v: write_long((v - EPOCH).days), lambda r, a: (lambda n, at: (EPOCH + dt.timedelta(days=n), at))(*read_long(r, a))
    if kind in ("datetime", "datetime2", "smalldatetime"):
        return lambda v: write_bytes(v.isoformat().encode()), lambda r, a: (lambda b, at: (dt.datetime.fromisoformat(b.decode()), at))(*read_bytes(r, a))
    if wire == "boolean":
        return lambda v: b"\x01" if v else b"\x00", lambda r, a: (r[a] == 1, a + 1)
    if wire == "double":
        return lambda v: struct.pack("<d", v), lambda r, a: (struct.unpack_from("<d", r, a)[0], a + 8)
    if wire == "float":
        return lambda v: struct.pack("<f", v), lambda r, a: (struct.unpack_from("<f", r, a)[0], a + 4)
    if wire == "bytes":
        return lambda v: write_bytes(bytes(v)), read_bytes
    if wire in ("int", "long") or kind == "time":
        return write_long, read_long
    return lambda v: write_bytes(str(v).encode()), lambda r, a: (lambda b, at: (b.decode(), at))(*read_bytes(r, a))


class RecordCodec:
    """Keys and values of one table's messages."""

    def __init__(self, table: TableSpec, key_id: int = 1, value_id: int = 2):
        self.table = table
        by_name = {f.name: f for f in table.fields}
        self.keys = [(n, *_field_codec(by_name[n])) for n in table.key_names]
        self.values = [(f.name, *_field_codec(f)) for f in table.value_fields]
        self.operations = list(OPERATION_NAMES.values())
        self.symbols = {UNKNOWN_COLUMN: 0} | {n: i + 1 for i, n in enumerate(table.value_names)}
        self.frames = b"\x00" + struct.pack(">I", key_id), b"\x00" + struct.pack(">I", value_id)

    def key(self, row: dict) -> bytes:
        return self.frames[0] + b"".join(w(row[n]) for n, w, _ in self.keys)

    def value(self, row: dict) -> bytes:
        out = [self.frames[1], write_long(self.operations.index(row["__operation"])), write_bytes(row["__event_time"].encode())]
        for name, kind in (("__log_lsn", str), ("__command_id", int), ("__log_seqval", str)):
            v = row[name]
            out.append(write_long(0) if v is None else write_long(1) + (write_long(v) if kind is int else write_bytes(v.encode())))
        names = row["__updated_fields"]
        out += ([write_long(len(names))] + [write_long(self.symbols.get(n, 0)) for n in names] if names else []) + [write_long(0)]
        for name, write, _ in self.values:
            v = row[name]
            out.append(write_long(0) if v is None else write_long(1) + write(v))
        return b"".join(out)

    def check(self, row: dict, raw: bytes) -> None:
        """Raises where the bytes don't read back as the row."""
        again = self.read_value(raw)
        symbols = [n if n in self.symbols else UNKNOWN_COLUMN for n in row["__updated_fields"] or []]
        for n in ("__operation", "__event_time", "__log_lsn", "__command_id", "__log_seqval", "__updated_fields"):
            wanted = symbols if n == "__updated_fields" else row[n]
            if again[n] != wanted:
                raise ValueError(f"{self.table.qualified_name}: {n} was written as {again[n]!r}, not {wanted!r}")
        for n, write, _ in self.values:
            a, b = again[n], row[n]
            if (a is None) != (b is None) or (a is not None and write(a) != write(b)):
                raise ValueError(f"{self.table.qualified_name}: {n} was written as {a!r}, not {b!r}")

    def read_key(self, raw: bytes) -> dict:
        at, out = 5, {}
        for name, _, read in self.keys:
            out[name], at = read(raw, at)
        return out

    def read_value(self, raw: bytes) -> dict:
        n, at = read_long(raw, 5)
        out: dict[str, Any] = {"__operation": self.operations[n]}
        b, at = read_bytes(raw, at)
        out["__event_time"] = b.decode()
        for name in ("__log_lsn", "__command_id", "__log_seqval"):
            branch, at = read_long(raw, at)
            if not branch:
                out[name] = None
            elif name == "__command_id":
                out[name], at = read_long(raw, at)
            else:
                b, at = read_bytes(raw, at)
                out[name] = b.decode()
        names, symbols = [], [UNKNOWN_COLUMN, *self.table.value_names]
        while True:
            count, at = read_long(raw, at)
            if not count:
                break
            if count < 0:
                count, (_, at) = -count, read_long(raw, at)
            for _ in range(count):
                i, at = read_long(raw, at)
                names.append(symbols[i])
        out["__updated_fields"] = names
        for name, _, read in self.values:
            branch, at = read_long(raw, at)
            out[name], at = read(raw, at) if branch else (None, at)
        return out


# ------------------------------------------------------------------ whole batches

_NUMBERS = ("bigint", "int", "smallint", "tinyint", "time")


def _piece(field: FieldSpec, column: pa.Array) -> C.Piece:
    """A column's values as bytes; what a null gives isn't used."""
    kind = field.sql_type.lower()
    if kind in _NUMBERS:
        return C.varints(pc.fill_null(column.cast(pa.int64()), 0).to_numpy(zero_copy_only=False))
    if kind == "date":
        return C.varints(pc.fill_null(column.cast(pa.int32()), 0).to_numpy(zero_copy_only=False))
    if kind == "bit":
        return C.fixed(pc.fill_null(column, False).to_numpy(zero_copy_only=False).astype(np.uint8))
    if kind in ("float", "real"):
        return C.fixed(pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False).astype("<f8" if kind == "float" else "<f4"))
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        return C.texts(column)
    write = _field_codec(field)[0]  # decimals and times, a value at a time
    return C.given([b"" if v is None else write(v) for v in column.to_pylist()])


def _read_piece(field: FieldSpec, walk: C.Walk, on: np.ndarray) -> pa.Array:
    kind, arrow = field.sql_type.lower(), to_arrow_type(field.spark.dataType)
    nulls = ~on
    if kind in _NUMBERS:
        return pa.array(walk.numbers(on), pa.int64(), mask=nulls).cast(arrow)
    if kind == "date":
        return pa.array(walk.numbers(on).astype(np.int32), pa.int32(), mask=nulls).cast(arrow)
    if kind == "bit":
        return pa.array(walk.fixed(on, "u1") == 1, pa.bool_(), mask=nulls)
    if kind in ("float", "real"):
        return pa.array(walk.fixed(on, "<f8" if kind == "float" else "<f4"), arrow, mask=nulls)
    if pa.types.is_string(arrow) or pa.types.is_binary(arrow):
        return walk.texts(on, arrow)
    raw = walk.texts(on, pa.binary()).to_pylist()
    read = _field_codec(field)[1]
    return pa.array([None if r is None else read(write_bytes(r), 0)[0] for r in raw], arrow)


def encode_batch(codec: RecordCodec, batch: pa.RecordBatch) -> tuple[pa.Array, pa.Array]:
    """(keys, values) of a batch with _key, _gone, the fields of the record's head and those of the table."""
    n, table = batch.num_rows, codec.table
    by_name = {f.name: f for f in table.fields}
    keys = batch.column("_key")
    parts = {keys.type.field(i).name: x for i, x in enumerate(keys.flatten())}
    key = C.joined([C.constant(codec.frames[0], n), *(_piece(by_name[k], parts[k]) for k in table.key_names)])

    gone = batch.column("_gone").to_numpy(zero_copy_only=False)
    text = lambda name: C.optional(C.texts(batch.column(name)), batch.column(name).is_valid().to_numpy(zero_copy_only=False))
    command, names = batch.column("__command_id"), batch.column("__updated_fields")
    operation = pc.fill_null(pc.index_in(batch.column("__operation"), pa.array(codec.operations)), 0).to_numpy(zero_copy_only=False)
    count = pc.fill_null(pc.list_value_length(names), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    symbols = pc.fill_null(pc.index_in(names.flatten(), pa.array(list(codec.symbols))), 0).to_numpy(zero_copy_only=False)
    pieces = [
        C.constant(codec.frames[1], n), C.varints(operation), C.texts(batch.column("__event_time")), text("__log_lsn"),
        C.optional(C.varints(pc.fill_null(command, 0).to_numpy(zero_copy_only=False)), command.is_valid().to_numpy(zero_copy_only=False)), text("__log_seqval"),
        C.only(C.varints(count), count > 0), C.grouped(C.varints(symbols), count), C.constant(b"\x00", n),
    ]
    for f in table.value_fields:
        column = batch.column(f.name)
        pieces.append(C.optional(_piece(f, column), column.is_valid().to_numpy(zero_copy_only=False)))
    return C.binary(key), C.binary(C.joined(pieces), ~gone)


def decode_batch(codec: RecordCodec, keys: pa.Array, values: pa.Array) -> list[pa.Array]:
    """The columns of the value records; a row without a value has its key's columns."""
    table, on = codec.table, values.is_valid().to_numpy(zero_copy_only=False)
    by_name = {f.name: f for f in table.fields}
    walk = C.Walk(pc.fill_null(values, b""), 5)
    operation = pa.array(codec.operations).take(pa.array(walk.numbers(on), mask=~on))
    out = [operation, walk.texts(on, pa.string()), walk.texts(walk.branch(on), pa.string())]
    told = walk.branch(on)
    out.append(pa.array(walk.numbers(told).astype(np.int32), pa.int32(), mask=~told))
    out.append(walk.texts(walk.branch(on), pa.string()))
    names = walk.lists(on, list(codec.symbols))
    out.append(pa.ListArray.from_arrays(names.offsets, names.values, mask=pa.array(~on)) if len(names) else names)
    key_walk, key_on = C.Walk(pc.fill_null(keys, b""), 5), keys.is_valid().to_numpy(zero_copy_only=False) & ~on
    from_key = {k: _read_piece(by_name[k], key_walk, key_on) for k in table.key_names}
    for f in table.value_fields:
        found = _read_piece(f, walk, walk.branch(on))
        out.append(pc.coalesce(found, from_key[f.name]) if f.name in from_key else found)
    return out


# ------------------------------------------------------------------ Spark


def encode(envelope: DataFrame, table: TableSpec, key_id: int = 1, value_id: int = 2, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` of envelope rows (topic, lsn and command_id, if none are named) with key and value; a tombstone's value is null."""
    codec = RecordCodec(table, key_id, value_id)
    kept = ["topic", "lsn", "command_id"] if keep is None else keep
    source = envelope.withColumns({"lsn": F.col("idx.lsn"), "command_id": F.col("idx.command_id")}) if keep is None else envelope
    schema = T.StructType([*source.select(*kept).schema.fields, T.StructField("key", T.BinaryType()), T.StructField("value", T.BinaryType())])
    flat = source.select(
        F.struct(*kept).alias("_kept"), X.operation_name(F.col("operation")).alias("__operation"), X.iso_time(F.col("event_time")).alias("__event_time"),
        *[F.when(F.col("operation") != 0, F.col(f"idx.{c}")).alias(n) for n, c in (("__log_lsn", "lsn"), ("__command_id", "command_id"), ("__log_seqval", "seqval"))],
        F.col("updated_fields").alias("__updated_fields"), F.col("value").isNull().alias("_gone"), F.struct("key.*").alias("_key"), *[F.col(f"value.{n}").alias(n) for n in table.value_names],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            keys, values = encode_batch(codec, batch)
            for i in range(-seen % CHECK_EVERY, batch.num_rows, CHECK_EVERY):  # the first record of a task, and every so many after it
                row = batch.slice(i, 1).drop_columns(["_kept"]).to_pylist()[0]
                if not row["_gone"]:
                    codec.check(row, values[i].as_py())
            seen += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.column("_kept").flatten(), keys, values], names=schema.names)

    return flat.mapInArrow(run, schema)


def decode(messages: DataFrame, table: TableSpec, keep: list[str] | None = None) -> DataFrame:
    """The columns `keep` and those of the value record; rows with a null value have their key columns only."""
    codec = RecordCodec(table)
    meta = [T.StructField("__operation", T.StringType()), T.StructField("__event_time", T.StringType()), T.StructField("__log_lsn", T.StringType()), T.StructField("__command_id", T.IntegerType()), T.StructField("__log_seqval", T.StringType()), T.StructField("__updated_fields", T.ArrayType(T.StringType()))]
    record = T.StructType([*meta, *(T.StructField(f.name, f.spark.dataType) for f in table.value_fields)])
    kept = messages.select(*(keep or [])).schema.fields
    schema = T.StructType([*kept, *record.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = decode_batch(codec, batch.column("key"), batch.column("value"))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *found], names=schema.names)

    return messages.select(*(keep or []), "key", "value").mapInArrow(run, schema)
