from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st

from changeloom.functions import avro
from changeloom.model import FieldSpec, TableSpec, UnsupportedSqlType, spark_type

TABLE = TableSpec(
    "app", "all_types", "app_all_types_v1",
    (
        FieldSpec("id", "bigint", 1, 1), FieldSpec("d", "decimal", 2, precision=10, scale=2), FieldSpec("b", "bit", 3), FieldSpec("f", "float", 4), FieldSpec("r", "real", 5), FieldSpec("day", "date", 6), FieldSpec("t", "time", 7),
        FieldSpec("at", "datetime2", 8), FieldSpec("s", "nvarchar", 9), FieldSpec("raw", "varbinary", 10),
    ),
)
META = {"__operation": "Insert", "__event_time": "2024-01-01T00:00:07", "__log_lsn": "0x01", "__command_id": 3, "__log_seqval": "0x02", "__updated_fields": ["id", "s"]}


@pytest.mark.parametrize(("n", "want"), [(0, "00"), (-1, "01"), (1, "02"), (64, "8001"), (-64, "7f"), (2**63 - 1, "feffffffffffffffff01"), (-(2**63), "ffffffffffffffffff01")])
def test_zig_zag(n, want):
    assert avro.write_long(n).hex() == want
    assert avro.read_long(bytes.fromhex(want), 0) == (n, len(want) // 2)


@pytest.mark.parametrize(("value", "want"), [("0", "0200"), ("1.27", "027f"), ("1.28", "040080"), ("-1.28", "0280"), ("-1.29", "04ff7f")])
def test_decimal_bytes(value, want):
    assert avro.write_decimal(Decimal(value), 2).hex() == want
    assert avro.read_decimal(bytes.fromhex(want), 0, 2)[0] == Decimal(value)


@given(st.integers(-(10**38) + 1, 10**38 - 1), st.integers(0, 38))
def test_decimals_of_38_digits(n, scale):
    value = Decimal((int(n < 0), tuple(map(int, str(abs(n)))), -scale))
    raw = avro.write_decimal(value, scale)
    size, at = avro.read_long(raw, 0)
    assert int.from_bytes(raw[at : at + size], "big", signed=True) == n
    assert avro.read_decimal(raw, 0, scale)[0] == value


def test_a_decimal_with_fewer_digits_is_widened():
    assert avro.read_decimal(avro.write_decimal(Decimal("5E+3"), 2), 0, 2)[0] == Decimal("5000.00")
    with pytest.raises(ValueError):
        avro.write_decimal(Decimal("NaN"), 2)


def test_records_are_read_back():
    codec = avro.RecordCodec(TABLE)
    row = META | {"id": 1, "d": Decimal("12.50"), "b": True, "f": 1.5, "r": 0.1, "day": None, "t": None, "at": None, "s": "x", "raw": b"y"}
    codec.check(row, codec.value(row))
    with pytest.raises(ValueError, match="s was written"):
        codec.check(row, codec.value(row | {"s": "z"}))


def plain_number(data):
    n = shift = 0
    while True:
        byte = data.pop(0)
        n, shift = n | (byte & 127) << shift, shift + 7
        if byte < 128:
            return (n >> 1) ^ -(n & 1)


def plain_value(kind, data):
    """A reader that goes by the published schema alone."""
    import struct

    if isinstance(kind, list):
        return plain_value(kind[plain_number(data)], data)
    if isinstance(kind, dict):
        if kind["type"] == "record":
            return {f["name"]: plain_value(f["type"], data) for f in kind["fields"]}
        if kind["type"] == "enum":
            return kind["symbols"][plain_number(data)]
        if kind["type"] == "array":
            out = []
            while n := plain_number(data):
                out += [plain_value(kind["items"], data) for _ in range(n)]
            return out
        if kind.get("logicalType") == "decimal":
            raw = plain_value("bytes", data)
            return Decimal(int.from_bytes(raw, "big", signed=True)) / 10 ** kind["scale"]
        if kind.get("logicalType") == "date":
            return dt.date(1970, 1, 1) + dt.timedelta(days=plain_number(data))
        return plain_value(kind["type"], data)
    if kind == "null":
        return None
    if kind == "boolean":
        return bool(data.pop(0))
    if kind in ("int", "long"):
        return plain_number(data)
    n = {"double": 8, "float": 4}.get(kind) or plain_number(data)
    raw = bytes(data[:n])
    del data[:n]
    return struct.unpack("<d" if n == 8 else "<f", raw)[0] if kind in ("double", "float") else raw.decode() if kind == "string" else raw


@given(st.integers(-(2**63), 2**63 - 1), st.one_of(st.none(), st.text()), st.one_of(st.none(), st.binary()), st.one_of(st.none(), st.floats(allow_nan=False)), st.one_of(st.none(), st.dates()))
def test_bytes_follow_the_schema(i, s, raw, f, day):
    row = META | {"id": i, "d": Decimal("12.50"), "b": True, "f": f, "r": 0.5, "day": day, "t": 1000, "at": dt.datetime(2024, 1, 1, 0, 0, 7, 179500), "s": s, "raw": raw}
    data = list(avro.RecordCodec(TABLE).value(row))[5:]
    got = plain_value(json.loads(avro.value_schema(TABLE)), data)
    assert not data and got == row | {"at": row["at"].isoformat()}


def test_decimal_with_too_many_digits_raises():
    with pytest.raises(ValueError):
        avro.write_decimal(Decimal("1.234"), 2)


@given(st.integers(-(2**63), 2**63 - 1), st.one_of(st.none(), st.text()), st.one_of(st.none(), st.binary()), st.one_of(st.none(), st.floats(allow_nan=False)), st.one_of(st.none(), st.dates()))
def test_round_trip(i, s, raw, f, day):
    row = META | {"id": i, "d": Decimal("12.50"), "b": True, "f": f, "r": 0.5, "day": day, "t": 1000, "at": dt.datetime(2024, 1, 1, 0, 0, 7, 179500), "s": s, "raw": raw}
    codec = avro.RecordCodec(TABLE)
    assert codec.read_value(codec.value(row)) == row
    assert codec.read_key(codec.key(row)) == {"id": i}


def test_batches_are_what_single_records_are():
    import random

    import pyarrow as pa

    rng = random.Random(2)
    some = lambda f: None if rng.random() < 0.25 else f()
    long = lambda: rng.choice([0, -1, 63, 64, -65, 8191, 8192, 2**63 - 1, -(2**63), rng.randrange(10**6)])
    rows = []
    for _ in range(500):
        head = {"__operation": rng.choice(list(avro.OPERATION_NAMES.values())), "__event_time": "2024-01-01T00:00:07" + rng.choice(["", ".000123"]), "__log_lsn": some(lambda: "0x01"), "__command_id": some(lambda: rng.randrange(-5, 10**6)), "__log_seqval": some(lambda: "0x02")}
        fields = {"__updated_fields": some(lambda: rng.sample([f.name for f in TABLE.fields] + ["gone"], rng.randrange(8)))}
        body = {"id": long(), "d": some(lambda: Decimal(rng.randrange(-(10**8), 10**8)).scaleb(-2)), "b": some(lambda: rng.random() < 0.5), "f": some(rng.random), "r": some(lambda: 0.5), "day": some(lambda: dt.date(1970, 1, 1) + dt.timedelta(days=rng.randrange(-9999, 9999))), "t": some(lambda: rng.randrange(86_400_000)), "at": some(lambda: dt.datetime(2024, 1, 1, 0, 0, 7, rng.choice([0, 179500]))), "s": some(lambda: "\u00e4" * rng.randrange(200)), "raw": some(lambda: rng.randbytes(rng.randrange(5)))}
        rows.append(head | fields | body | {"_key": {"id": body["id"]}, "_gone": rng.random() < 0.1})
    types = {"d": pa.decimal128(10, 2), "r": pa.float32(), "t": pa.int32(), "at": pa.timestamp("us"), "raw": pa.binary(), "__command_id": pa.int32(), "s": pa.string(), "day": pa.date32(), "b": pa.bool_(), "f": pa.float64()}
    codec = avro.RecordCodec(TABLE)
    for part in (rows, rows[:1], rows[7:9], []):
        names = list(rows[0])
        arrays = [pa.array([r[n] for r in part], types.get(n) or pa.array([r[n] for r in rows]).type) for n in names]
        batch = pa.RecordBatch.from_arrays(arrays, names=names)
        keys, values = avro.encode_batch(codec, batch)
        assert keys.to_pylist() == [codec.key(r["_key"]) for r in part]
        assert values.to_pylist() == [None if r["_gone"] else codec.value(r) for r in part]
        again = [x.to_pylist() for x in avro.decode_batch(codec, keys, values)]
        want = [codec.read_value(codec.value(r)) if not r["_gone"] else {"id": r["id"]} for r in part]
        order = [*META, *(f.name for f in TABLE.fields)]
        assert again == [[w.get(n) for w in want] for n in order]


def test_frame_and_unknown_column():
    codec = avro.RecordCodec(TABLE, value_id=258)
    raw = codec.value(META | {"__updated_fields": ["gone"]} | {f.name: None for f in TABLE.fields})
    assert raw[:5].hex() == "0000000102"
    assert codec.read_value(raw)["__updated_fields"] == [avro.UNKNOWN_COLUMN]


def test_schemas():
    value = json.loads(avro.value_schema(TABLE, overrides={"APP.all_types.D": "string"}))
    assert [f["name"] for f in value["fields"]][:6] == ["__operation", "__event_time", "__log_lsn", "__command_id", "__log_seqval", "__updated_fields"]
    assert value["fields"][7]["type"] == ["null", "string"]
    assert json.loads(avro.key_schema(TABLE))["fields"] == [{"name": "id", "type": "long"}]


def test_types():
    assert spark_type("TinyInt").simpleString() == "smallint"
    assert spark_type("money", 19, 4).simpleString() == "decimal(19,4)"
    for bad in (("geography",), ("decimal",)):
        with pytest.raises(UnsupportedSqlType):
            spark_type(*bad)
    with pytest.raises(ValueError):
        FieldSpec("n", "int", 1, truncate_after=3)
