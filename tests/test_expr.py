from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import HIGHEST, LOWEST, ChangeIndex


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("mask", "want"), [("0205", [1, 3, 10]), ("00", []), ("01", [1]), ("8000", [16]), ("ff", [1, 2, 3, 4, 5, 6, 7, 8])])
def test_update_mask(spark, mask, want):
    names = [str(i) for i in range(1, 17)]
    assert one(spark, X.updated_fields(F.unhex(F.lit(mask)), names)) == [str(i) for i in want]


def test_mask_shorter_than_the_columns(spark):
    assert one(spark, X.updated_fields(F.unhex(F.lit("03")), [str(i) for i in range(1, 31)])) == ["1", "2"]


def test_index_order():
    low, high = ChangeIndex.of("0x" + "00" * 9 + "01", 1, "0x" + "00" * 9 + "01", 1), ChangeIndex.of("0x80" + "00" * 9, 1, "0x" + "00" * 10, 1)
    assert LOWEST < low < high < HIGHEST
    assert HIGHEST.probably_heartbeat and not low.probably_heartbeat
    assert ChangeIndex(HIGHEST.lsn, 7, HIGHEST.seqval, HIGHEST.operation).probably_heartbeat


def test_binary_positions_compare_unsigned(spark):
    rows = spark.createDataFrame([(bytes.fromhex("7f" + "ff" * 9),), (bytes.fromhex("80" + "00" * 9),)], "lsn binary")
    assert rows.agg(F.max("lsn").alias("m")).first().m.hex().startswith("80")


def test_after_and_upto(spark):
    rows = spark.createDataFrame([("0x" + "00" * 9 + "05", c, "0x" + "00" * 10, o) for c in (1, 2) for o in (1, 2, 4)], "lsn string, command_id int, seqval string, operation int")
    at = ChangeIndex.of("0x" + "00" * 9 + "05", 1, "0x" + "00" * 10, 2)
    assert rows.where(X.after_index(at)).count() == 4
    assert rows.where(X.after_index(at, with_operation=False)).count() == 3  # skips the rest of a split page
    assert rows.where(X.upto_index(at)).count() == 2


@pytest.mark.parametrize(("text", "limit", "want", "header"), [("€€", 4, "€", "6,3"), ("😀", 3, "", "4,0"), ("😀", 4, "😀", None), ("abc", 3, "abc", None), ("aé", 2, "a", "3,1"), ("", 1, "", None), ("abc", 0, "", "3,0")])
def test_truncate(spark, text, limit, want, header):
    assert one(spark, X.truncate_utf8(F.lit(text), limit)) == want
    assert one(spark, X.truncation_header(F.lit(text), limit)) == header


def test_truncate_random(spark):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aé€😀 ") for _ in range(rng.randrange(12))) for _ in range(300)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for limit in (1, 2, 3, 5, 7):
        for t, cut in rows.select("t", X.truncate_utf8(F.col("t"), limit).alias("c")).collect():
            assert cut == t.encode()[:limit].decode("utf-8", "ignore")


@pytest.mark.parametrize(("at", "want"), [("2024-01-01 00:00:07", "2024-01-01T00:00:07"), ("2024-01-01 00:00:07.1795", "2024-01-01T00:00:07.179500")])
def test_iso(spark, at, want):
    assert one(spark, X.iso_time(F.lit(at).cast("timestamp_ntz"))) == want


@pytest.mark.parametrize(("lsn", "want"), [("0x" + "00" * 9 + "ff", "0x" + "00" * 8 + "0100"), ("0x" + "00" * 5 + "ff" * 5, "0x" + "00" * 4 + "01" + "00" * 5), ("0x" + "ff" * 10, "0x" + "ff" * 10)])
def test_increment(spark, lsn, want):
    assert one(spark, X.increment_lsn(F.lit(lsn))) == want


def test_uuid_order(spark):
    rng = random.Random(2)
    ids = [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(200)] + ["00000000-0000-0000-0000-000000000001", "01000000-0000-0000-0000-000000000000"]

    def database_order(text):
        b = uuid.UUID(text).bytes
        return b[10:16] + b[8:10] + b[0:8][::-1]

    rows = spark.createDataFrame([(i,) for i in ids], "id string").orderBy(X.uuid_sort_key(F.col("id"))).collect()
    assert [r.id for r in rows] == sorted(ids, key=database_order)


def test_row_hash_is_a_version_5_identifier(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "n int, s string").select(X.row_hash_uuid(["n", "s"], "t").alias("x")).collect()
    assert rows[0].x == rows[1].x != rows[2].x
    assert all(uuid.UUID(r.x).version == 5 for r in rows)


def test_composite_keys(spark):
    rows = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a int, b int")
    for sign, test in (("<", lambda k: k < (2, 1)), ("<=", lambda k: k <= (2, 1)), (">", lambda k: k > (2, 1)), (">=", lambda k: k >= (2, 1))):
        got = {(r.a, r.b) for r in rows.where(X.key_compare(["a", "b"], sign, [2, 1])).collect()}
        assert got == {(a, b) for a in range(4) for b in range(4) if test((a, b))}


@pytest.mark.parametrize(
    ("ddl", "want"),
    [
        ("ALTER TABLE a.b ADD c int", ["c"]), ("alter table [a].[b] add [Old_Col] int NULL", ["old_col"]), ("ALTER TABLE a.b DROP COLUMN c", []), ("create table x (y int)", []), ("ALTER TABLE t ADD a int, b int", ["a", "b"]),
        ("ALTER TABLE t ADD CONSTRAINT pk PRIMARY KEY (a, b)", []), ("ALTER TABLE [my db].dbo.[t x]\n ADD [a b] decimal(10, 2) DEFAULT (round(1, 2)), \"Q\" char(1) DEFAULT ',x', CHECK (a > 0)", ["a b", "q"]), ("ALTER TABLE t ADD [x]]y] int", ["x]y"]),
        ("ALTER TABLE t WITH CHECK ADD FOREIGN KEY (a) REFERENCES u (b)", []), ("ALTER TABLE t ADD COLUMN c text", ["c"]),
    ],
)
def test_added_columns(spark, ddl, want):
    assert one(spark, X.added_columns(F.lit(ddl))) == want


@pytest.mark.parametrize("text", ["stra\u00dfe STRASSE", "\u039f\u0394\u039f\u03a3 \u03bf\u03b4\u03bf\u03c2", "\ufb01t", "\u0130stanbul", "Key-1"])
def test_case_folding(spark, text):
    assert one(spark, X.casefolded(F.lit(text))) == text.casefold()


@pytest.mark.parametrize("charset", ["cp1252", "utf-16le"])
def test_target_encodings(spark, charset):
    text = "na\u00efve \u20ac 5 \u2013 \u201cquoted\u201d \u017d\u0178"
    assert bytes(one(spark, X.encoded(F.lit(text), charset))) == text.encode(charset)


def test_cut_utf16(spark):
    raw = "ab\U0001f600".encode("utf-16-le")
    assert [one(spark, X.decode_utf16(F.lit(raw[:n]).cast("binary"))) for n in (8, 7, 6, 5, 4, 3, 0)] == ["ab\U0001f600", "ab", "ab", "ab", "ab", "a", ""]


@pytest.mark.parametrize(("parts", "want"), [((2024, 2, 29, 23, 5, 9, 123456700, -7, -30), "2024-02-29T23:05:09.1234567-07:30"), ((1, 1, 1, 0, 0, 0, 0, 0, 0), "0001-01-01T00:00:00+00:00"), ((2024, 12, 31, 1, 2, 3, 100, 5, 45), "2024-12-31T01:02:03.0000001+05:45")])
def test_time_with_an_offset(spark, parts, want):
    import struct

    assert one(spark, X.datetimeoffset_text(F.lit(struct.pack("<6hI2h", *parts)).cast("binary"))) == want


def test_zone_to_utc(spark):
    import datetime as dt

    at = F.lit("2024-07-01 12:00:00").cast("timestamp_ntz")
    assert one(spark, X.local_to_utc(at, "America/Los_Angeles", 30)) == dt.datetime(2024, 7, 1, 18, 59, 30)
