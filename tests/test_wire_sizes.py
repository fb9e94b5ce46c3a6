"""The bytes of `wire_encode` for keys and texts whose numbers take more than two bytes, against the record writer."""

from __future__ import annotations

import datetime as dt

from changeloom.functions import avro
from changeloom.plans.registry import QUERIES

USERS = [0, 63, 64, 8191, 8192, 90_000, 1 << 20, 1 << 40]
TEXTS = [0, 63, 64, 8191, 8192, 9000, 1 << 20, None]


def test_long_numbers_and_texts(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1, 0, 0, i), user, "view", 1.5, None if size is None else "x" * size) for i, (user, size) in enumerate(zip(USERS, TEXTS, strict=True))]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["wire_encode"](spark, str(tmp_path)).orderBy("lsn", "command_id").collect()
    text = lambda s: avro.write_long(1) + avro.write_bytes(s.encode())
    for (_, at, user, kind, _, props), r in zip(rows, got, strict=True):
        assert r.key_hex.lower() == (b"\x00\x00\x00\x00\x01" + avro.write_long(user)).hex()
        assert r.head_hex.lower().endswith((avro.write_long(1) + avro.write_long(user) + text(kind) + avro.write_long(1)).hex()), at
        assert r.tail_hex.lower() == ("00" if props is None else text(props).hex())
