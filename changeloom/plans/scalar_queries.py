"""Queries that apply the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.plans.book import Book, Inputs

BOOK = Book()


@BOOK.query("lsn_hex", "SELECT lsn, command_id, lsn AS again, CAST(10 AS INT) AS n_bytes FROM ct_order")
def lsn_hex(t: Inputs):
    raw = X.lsn_bytes(F.col("lsn"))
    return t.ct_order.select("lsn", "command_id", X.lsn_text(raw).alias("again"), F.octet_length(raw).alias("n_bytes"))


@BOOK.query(
    "change_index_display",
    "SELECT '0x' || substr(lsn, 3, 8) || ' ' || substr(lsn, 11, 8) || ' ' || substr(lsn, 19) || ':' || command_id || ':0x' || substr(seqval, 3, 8) || ' ' || substr(seqval, 11, 8) || ' ' || substr(seqval, 19) || ':' || operation AS shown FROM ct_order",
)
def change_index_display(t: Inputs):
    return t.ct_order.select(X.index_display().alias("shown"))


@BOOK.query("increment_lsn", "SELECT lsn, '0x' || lower(lpad(hex(CAST('0x' || substr(lsn, 7) AS BIGINT) + 1), 20, '0')) AS following FROM (SELECT DISTINCT lsn FROM ct_order) x")
def increment_lsn(t: Inputs):
    return t.ct_order.select("lsn").distinct().select("lsn", X.increment_lsn(F.col("lsn")).alias("following"))


@BOOK.query("operation_names", "SELECT operation, count(*) AS n, CASE operation WHEN 1 THEN 'Delete' WHEN 2 THEN 'Insert' WHEN 3 THEN 'PreUpdate' WHEN 4 THEN 'PostUpdate' END AS name, operation AS back FROM ct_user GROUP BY operation")
def operation_names(t: Inputs):
    name = X.operation_name(F.col("operation"))
    return t.ct_user.groupBy("operation").agg(F.count("*").alias("n")).select("operation", "n", name.alias("name"), X.operation_id(name).alias("back"))


@BOOK.query(
    "updated_fields",
    "SELECT lsn, command_id, operation, update_mask, concat_ws(',', CASE WHEN update_mask & 1 <> 0 THEN 'user_id' END, CASE WHEN update_mask & 2 <> 0 THEN 'event_type' END, CASE WHEN update_mask & 4 <> 0 THEN 'value' END, CASE WHEN update_mask & 8 <> 0 THEN 'props' END) AS fields FROM ct_user",
)
def updated_fields(t: Inputs):
    fields = X.updated_fields(X.int_mask(F.col("update_mask")), ["user_id", "event_type", "value", "props"])
    return t.ct_user.select("lsn", "command_id", "operation", "update_mask", F.array_join(fields, ",").alias("fields"))


@BOOK.query(
    "truncate_utf8",
    """WITH s AS (SELECT doc_id, substr(text, 5, 60) AS t FROM documents)
SELECT doc_id, (SELECT max(left(t, CAST(i AS INT))) FROM range(0, 61) r(i) WHERE strlen(left(t, CAST(i AS INT))) <= 17) AS cut17, CASE WHEN strlen(t) > 17 THEN strlen(t) || ',' || (SELECT max(strlen(left(t, CAST(i AS INT)))) FROM range(0, 61) r(i) WHERE strlen(left(t, CAST(i AS INT))) <= 17) END AS header17 FROM s""",
)
def truncate_utf8(t: Inputs):
    rows = t.table("documents").select("doc_id", F.substring("text", 5, 60).alias("t"))
    return rows.select("doc_id", X.truncate_utf8(F.col("t"), 17).alias("cut17"), X.truncation_header(F.col("t"), 17).alias("header17"))


@BOOK.query(
    "row_hash_key",
    """WITH d AS (SELECT event_id, sha1(unhex(md5(concat_ws(chr(31), 'event_id', CAST(event_id AS VARCHAR), 'event_type', event_type))) || encode('app.events')) AS h FROM events)
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (('0x' || substr(h, 17, 1))::INT & 3) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS row_id FROM d""",
)
def row_hash_key(t: Inputs):
    return t.table("events").select("event_id", X.row_hash_uuid(["event_id", "event_type"], "app.events").alias("row_id"))


@BOOK.query("iso_event_time", "SELECT event_id, CASE WHEN date_trunc('second', ts) = ts THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso, ts AS back FROM events")
def iso_event_time(t: Inputs):
    iso = X.iso_time(F.col("ts"))
    return t.table("events").select("event_id", iso.alias("iso"), X.from_iso_time(iso).alias("back"))


@BOOK.query("db_time_to_utc", "SELECT event_id, ts + INTERVAL 25201500000 MICROSECONDS AS utc FROM events")
def db_time_to_utc(t: Inputs):
    return t.table("events").select("event_id", X.db_time_to_utc(F.col("ts"), 25_201_500_000).alias("utc"))


@BOOK.query("change_table_names", "SELECT capture_instance, 'cdc.' || capture_instance || '_CT' AS change_table, capture_instance AS back, '[cdc].[' || capture_instance || '_CT]' AS quoted FROM change_tables")
def change_table_names(t: Inputs):
    name = X.change_table_name(F.col("capture_instance"))
    return t.change_tables.select("capture_instance", name.alias("change_table"), X.capture_instance_of(X.quoted_name(name)).alias("back"), X.quoted_name(name).alias("quoted"))


@BOOK.query("casefold_keys", "SELECT lower(event_type) AS folded, count(*) AS n FROM (SELECT CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END AS event_type FROM events) x GROUP BY 1")
def casefold_keys(t: Inputs):
    mixed = t.table("events").select(F.when(F.col("event_id") % 2 == 0, F.upper("event_type")).otherwise(F.col("event_type")).alias("event_type"))
    return mixed.groupBy(X.casefolded(F.col("event_type")).alias("folded")).agg(F.count("*").alias("n"))


_UUID = "substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12)"


@BOOK.query("sqlserver_uuid_order", f"SELECT {_UUID} AS id, upper(substr(h,21,12)||substr(h,17,4)||substr(h,15,2)||substr(h,13,2)||substr(h,11,2)||substr(h,9,2)||substr(h,7,2)||substr(h,5,2)||substr(h,3,2)||substr(h,1,2)) AS sort_key FROM (SELECT md5(CAST(event_id AS VARCHAR)) AS h FROM events) x")
def sqlserver_uuid_order(t: Inputs):
    h = F.md5(F.col("event_id").cast("string"))
    text = F.concat_ws("-", *[F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    return t.table("events").select(text.alias("id")).select("id", X.uuid_sort_key(F.col("id")).alias("sort_key"))


@BOOK.query("ddl_added_columns", "SELECT object_id, age_seconds, column_name FROM ddl_history LEFT JOIN (VALUES (120, 'props'), (90000, 'old_col'), (100000, 'a'), (100000, 'b c'), (100000, 'd')) AS t(age, column_name) ON age = age_seconds")
def ddl_added_columns(t: Inputs):
    return t.ddl_history.select("object_id", "age_seconds", F.explode_outer(X.added_columns(F.col("ddl_command"))).alias("column_name"))


@BOOK.query("message_coordinates", "SELECT topic || ':' || partition_id || '@' || msg_offset AS at FROM topic_user")
def message_coordinates(t: Inputs):
    return t.topic_user.select(X.coordinates().alias("at"))


@BOOK.query(
    "target_encodings",
    "SELECT event_id, hex(event_type) AS plain_hex, array_to_string([hex(c) || '00' for c in string_split(event_type, '') if c <> ''], '') AS national_hex FROM events",
)
def target_encodings(t: Inputs):
    return t.table("events").select("event_id", F.hex(X.encoded(F.col("event_type"), "cp1252")).alias("plain_hex"), F.hex(X.encoded(F.col("event_type"), "utf-16le")).alias("national_hex"))


@BOOK.query("cut_utf16", "SELECT event_id, left(event_type, CAST(event_id % 11 AS INT) // 2) AS told FROM events")
def cut_utf16(t: Inputs):
    """Text of which a driver has handed over only so many bytes."""
    raw = F.substr(F.encode("event_type", "UTF-16LE"), F.lit(1), (F.col("event_id") % 11).cast("int"))
    return t.table("events").select("event_id", X.decode_utf16(raw).alias("told"))


_OFFSETS = "SELECT event_id, ts, CAST(event_id % 24 - 11 AS INT) AS hours FROM events"


@BOOK.query(
    "datetimeoffset_text",
    f"SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN ts = date_trunc('second', ts) THEN '' ELSE strftime(ts, '.%f') || '0' END || CASE WHEN hours < 0 THEN '-' ELSE '+' END || lpad(CAST(abs(hours) AS VARCHAR), 2, '0') || ':00' AS told FROM ({_OFFSETS}) x",
)
def datetimeoffset_text(t: Inputs):
    def little(value, size: int):
        flat = F.lpad(F.hex(F.pmod(value.cast("long"), F.lit(1 << (8 * size)))), 2 * size, "0")
        return F.concat(*[F.unhex(F.substr(flat, F.lit(2 * i + 1), F.lit(2))) for i in reversed(range(size))])

    at, hours = F.col("ts"), (F.col("event_id") % 24 - 11).cast("int")
    nanos = (F.unix_micros(at.cast("timestamp")) % 1_000_000) * 1000
    fields = [(F.year(at), 2), (F.month(at), 2), (F.dayofmonth(at), 2), (F.hour(at), 2), (F.minute(at), 2), (F.second(at), 2), (nanos, 4), (hours, 2), (F.lit(0), 2)]
    return t.table("events").select("event_id", X.datetimeoffset_text(F.concat(*[little(v, n) for v, n in fields])).alias("told"))


@BOOK.query("zone_to_utc", "SELECT event_id, (ts AT TIME ZONE 'America/Los_Angeles') AT TIME ZONE 'UTC' - INTERVAL 30 SECOND AS utc FROM events WHERE hour(ts) NOT IN (1, 2)")
def zone_to_utc(t: Inputs):
    """Times of a Pacific clock, less a buffer; the hours that a change of clocks drops or doubles are left out."""
    return t.table("events").where(~F.hour("ts").isin(1, 2)).select("event_id", X.local_to_utc(F.col("ts").cast("timestamp_ntz"), "America/Los_Angeles", 30).alias("utc"))
