"""Queries that run the codec and the stream, each held against the batch form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from changeloom.config import CdcConfig
from changeloom.functions import avro
from changeloom.functions import expr as X
from changeloom.model import INDEX_COLUMNS, FieldSpec, TableSpec
from changeloom.operators import changes, envelope
from changeloom.plans.book import Book, Inputs
from changeloom.sources.work import cut, shared_dir
from changeloom.streaming import pipeline, replay, sink

BOOK = Book()
USER = TableSpec("app", "user_state", "app_user_state_v2", (FieldSpec("user_id", "bigint", 1, 1), FieldSpec("event_type", "varchar", 2), FieldSpec("value", "float", 3), FieldSpec("props", "nvarchar", 4)), topic="app_user_state_cdc")
_MESSAGES = "SELECT 'table-change' AS message_type, user_id, lsn, command_id, seqval, 0 AS sub, operation, event_type FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4) UNION ALL SELECT 'deletion-tombstone', user_id, lsn, command_id, seqval, 1, NULL, NULL FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation = 1"
_LIVE = "SELECT user_id, event_type, value, props FROM live_user"


def _encoded(t: Inputs):
    rows = changes.with_event_time(changes.published(t.ct_user), t.ltm)
    return avro.encode(envelope.envelope(rows, USER, X.int_mask(F.col("update_mask"))), USER)


def _varint(n: str) -> str:
    """SQL for the bytes, in hex, of a number from 0 to 8191 as the codec writes it."""
    return f"(CASE WHEN {n} < 64 THEN lpad(hex(2 * ({n})), 2, '0') ELSE lpad(hex((2 * ({n})) % 128 + 128), 2, '0') || lpad(hex((2 * ({n})) // 128), 2, '0') END)"


def _text(x: str) -> str:
    return f"({_varint(f'strlen({x})')} || hex({x}))"


_ISO = "CASE WHEN date_trunc('second', tran_end_time) = tran_end_time THEN strftime(tran_end_time, '%Y-%m-%dT%H:%M:%S') ELSE strftime(tran_end_time, '%Y-%m-%dT%H:%M:%S.%f') END"
_FIELDS = "CASE WHEN operation = 4 THEN CASE WHEN update_mask = 0 THEN '' ELSE hex(2 * bit_count(update_mask::INT)) END" " || CASE WHEN update_mask & 1 <> 0 THEN '02' ELSE '' END || CASE WHEN update_mask & 2 <> 0 THEN '04' ELSE '' END || CASE WHEN update_mask & 4 <> 0 THEN '06' ELSE '' END || CASE WHEN update_mask & 8 <> 0 THEN '08' ELSE '' END ELSE '0802040608' END"
#: Every byte but the eight of a double: frame, operation, time, position, changed columns, key and text fields; then what follows the double.
_WIRE = f"""SELECT 'app_user_state_cdc' AS topic, lsn, command_id, upper('0000000001' || {_varint('user_id')}) AS key_hex,
upper('0000000002' || lpad(hex(2 * operation), 2, '0') || {_text('iso')} || '02' || {_text('lsn')} || '02' || {_varint('command_id')} || '02' || {_text('seqval')} || CASE WHEN length(fields) = 1 THEN '0' || fields WHEN length(fields) % 2 = 1 THEN '0' || fields ELSE fields END || '00'
 || '02' || {_varint('user_id')} || CASE WHEN event_type IS NULL THEN '00' ELSE '02' || {_text('event_type')} END || CASE WHEN value IS NULL THEN '00' ELSE '02' END) AS head_hex,
upper(CASE WHEN props IS NULL THEN '00' ELSE '02' || {_text('props')} END) AS tail_hex
FROM (SELECT c.*, {_ISO} AS iso, {_FIELDS} AS fields FROM (SELECT * FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)) c) x"""


@BOOK.query("wire_encode", _WIRE)
def wire_encode(t: Inputs):
    rows = changes.with_event_time(changes.published(t.ct_user), t.ltm)
    messages = envelope.envelope(rows, USER, X.int_mask(F.col("update_mask"))).withColumns({"lsn": F.col("idx.lsn"), "command_id": F.col("idx.command_id")})
    size = F.octet_length("value.props")
    width = 1 + sum((size >= n).cast("int") for n in (1 << 6, 1 << 13, 1 << 20, 1 << 27))  # bytes of the length before the text
    tail = F.when(size.isNull(), 1).otherwise(1 + width + size)
    messages = messages.withColumns({"tail": tail, "double": F.when(F.col("value.value").isNull(), 0).otherwise(8)})
    found = avro.encode(messages, USER, keep=["topic", "lsn", "command_id", "tail", "double"])
    cut_at = F.octet_length("value") - F.col("tail")
    return found.select("topic", "lsn", "command_id", F.hex("key").alias("key_hex"), F.hex(F.substr("value", F.lit(1), cut_at - F.col("double"))).alias("head_hex"), F.hex(F.substr("value", cut_at + 1)).alias("tail_hex"))


@BOOK.query("wire_decode", "SELECT lsn, command_id, seqval, CASE operation WHEN 1 THEN 'Delete' WHEN 2 THEN 'Insert' ELSE 'PostUpdate' END AS operation, user_id, event_type, value, props FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)")
def wire_decode(t: Inputs):
    return avro.decode(_encoded(t), USER).select(F.col("__log_lsn").alias("lsn"), F.col("__command_id").alias("command_id"), F.col("__log_seqval").alias("seqval"), F.col("__operation").alias("operation"), "user_id", "event_type", "value", "props")


ORDER = TableSpec("app", "customer_order", "app_customer_order_v1", (FieldSpec("o_custkey", "bigint", 1, 1), FieldSpec("o_orderkey", "bigint", 2), FieldSpec("o_orderstatus", "char", 3)))
IDLE = TableSpec("app", "idle", "app_idle_v1", USER.fields)


_DONE: dict[tuple, tuple] = {}


def _published(t: Inputs, snapshots: bool = False, parts: int = 3):
    """Two tables and an idle one published by the stream in several batches: (the folder of its sink, the pipeline).

    Queries of one application that read the same published topics share them.
    """
    known = (t.spark.sparkContext.applicationId, t.sf_dir, snapshots, parts)
    if known not in _DONE:
        _DONE[known] = _publish(t, snapshots, parts)
    return _DONE[known]


def _publish(t: Inputs, snapshots: bool, parts: int):
    home = f"{shared_dir(t.spark)}/changeloom-stream-{uuid.uuid4().hex}"
    t.ct_user.write.parquet(f"{home}/ct_user")
    t.ct_order.write.parquet(f"{home}/ct_order")
    t.ct_user.limit(0).write.parquet(f"{home}/ct_idle")
    t.ltm.write.parquet(f"{home}/ltm")
    t.live_user.write.parquet(f"{home}/user")
    config = CdcConfig(
        new_follow_start_point="earliest", unified_topics={"app_all_changes": r"app\.(user_state|customer_order)$"}, partition_count=3, max_lsns=-(-t.ltm.count() // parts), table_exclude=r"app\.nothing",
        snapshot_include=r"app\.user" if snapshots else None, snapshot_rows=max(1, -(-t.live_user.count() // 4)),
    )
    captures = [pipeline.Capture(USER, f"{home}/ct_user", f"{home}/user"), pipeline.Capture(ORDER, f"{home}/ct_order"), pipeline.Capture(IDLE, f"{home}/ct_idle")]
    run = pipeline.Pipeline(t.spark, config, captures, f"{home}/ltm", f"{home}/out", f"{home}/checkpoint")
    run.run()
    return f"{home}/out", run


def _rows_of(messages, topic: str):
    """Messages of a table's topic by their key and one field of their value."""
    own = messages.where(F.col("topic") == topic)
    return own.select("message_type", F.get_json_object(F.col("key").cast("string"), "$.user_id").cast("long").alias("user_id"), "lsn", "command_id", "seqval", "sub", "operation", F.get_json_object(F.col("value").cast("string"), "$.event_type").alias("event_type"))


@BOOK.query("stream_equals_batch", _MESSAGES)
def stream_equals_batch(t: Inputs):
    return _rows_of(sink.read(t.spark, _published(t)[0], "messages"), USER.topic)


@BOOK.query("stream_snapshot_and_changes", f"{_MESSAGES} UNION ALL SELECT 'table-snapshot', user_id, NULL, NULL, NULL, 0, 0, event_type FROM live_user")
def stream_snapshot_and_changes(t: Inputs):
    return _rows_of(sink.read(t.spark, _published(t, snapshots=True)[0], "messages"), USER.topic)


@BOOK.query(
    "stream_unified",
    """WITH m AS (SELECT 'app_user_state_cdc' AS original_topic, lsn, command_id, seqval, operation FROM ct_user UNION ALL SELECT 'app_customer_order_cdc', lsn, command_id, seqval, operation FROM ct_order)
SELECT original_topic, 'unified-change' AS message_type, lsn, command_id, seqval, operation, 0 AS partition_id, row_number() OVER (ORDER BY lsn, command_id, seqval, operation) - 1 AS msg_offset FROM m JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)""",
)
def stream_unified(t: Inputs):
    rows = sink.read(t.spark, _published(t)[0], "messages").where("topic = 'app_all_changes'")
    return rows.select(F.col("headers")["original_topic"].alias("original_topic"), F.col("headers")["message_type"].alias("message_type"), "lsn", "command_id", "seqval", "operation", "partition_id", "msg_offset")


@BOOK.query("stream_progress", "SELECT topic, lsn, command_id, seqval, operation FROM (SELECT 'app_user_state_cdc' AS topic, lsn, command_id, seqval, operation FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4) ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1) x")
def stream_progress(t: Inputs):
    rows = sink.read(t.spark, _published(t)[0], "progress").where(F.col("topic") == USER.topic)
    return rows.groupBy("topic").agg(F.max(X.index()).alias("i")).select("topic", "i.lsn", "i.command_id", "i.seqval", "i.operation")


@BOOK.query(
    "stream_heartbeat",
    """WITH p AS (SELECT start_lsn, (row_number() OVER (ORDER BY start_lsn) - 1) // (SELECT CAST(ceil(count(*) / 3.0) AS BIGINT) FROM ltm) AS b FROM ltm), c AS (SELECT b, max(start_lsn) AS ceiling FROM p GROUP BY b),
t AS (SELECT * FROM (VALUES ('app_user_state_cdc'), ('app_customer_order_cdc'), ('app_idle_cdc')) AS t(topic)),
m AS (SELECT 'app_user_state_cdc' AS topic, lsn, command_id, seqval, operation FROM ct_user UNION ALL SELECT 'app_customer_order_cdc', lsn, command_id, seqval, operation FROM ct_order),
g AS (SELECT topic, b, max(lsn || lpad(CAST(command_id AS VARCHAR), 10, '0') || seqval || operation) AS top FROM m JOIN p ON start_lsn = lsn WHERE operation IN (1,2,4) GROUP BY 1, 2)
SELECT t.topic, coalesce(substr(top, 1, 22), ceiling) AS lsn, coalesce(CAST(substr(top, 23, 10) AS INT), 2147483647) AS command_id, coalesce(substr(top, 33, 22), '0xffffffffffffffffffff') AS seqval, top IS NULL AS heartbeat
FROM t CROSS JOIN c LEFT JOIN g ON g.topic = t.topic AND g.b = c.b""",
)
def stream_heartbeat(t: Inputs):
    """What each batch recorded for each topic: its last change, or a heartbeat at the common ceiling."""
    rows = sink.read(t.spark, _published(t)[0], "progress")
    return rows.select("topic", "lsn", "command_id", "seqval", X.is_heartbeat().alias("heartbeat"))


@BOOK.query(
    "stream_resumed",
    "SELECT topic, lsn, command_id, seqval, operation, 'no gap' AS gap, 'none' AS snapshot FROM (SELECT topic, lsn, command_id, seqval, operation, row_number() OVER (PARTITION BY topic ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC) AS r FROM (SELECT 'app_user_state_cdc' AS topic, lsn, command_id, seqval, operation FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)) m) x WHERE r = 1 "
    "UNION ALL SELECT 'app_new_cdc', (SELECT max(start_lsn) FROM ltm), 1, '0x00000000000000000000', 0, 'no gap', 'none'",
)
def stream_resumed(t: Inputs):
    """Where a run with an empty checkpoint would start: after recorded progress, a table without any at the log's end."""
    out, run = _published(t, parts=1)
    new = pipeline.Capture(TableSpec("app", "new", "app_new_v1", USER.fields), run.captures[0].changes)
    again = pipeline.Pipeline(t.spark, CdcConfig(report_only=True), [run.captures[0], new], run.lsn_map, out, f"{run.checkpoint}-{uuid.uuid4().hex}")
    return again.report().select("topic", *INDEX_COLUMNS, "gap", "snapshot")


@BOOK.query("replay_stream", _LIVE)
def replay_stream(t: Inputs):
    home = f"{shared_dir(t.spark)}/changeloom-replay-{uuid.uuid4().hex}"
    messages = cut(pipeline.published_batch(t.ct_user, t.ltm, F.lit("app_user_state_cdc")), "messages")
    cuts = ["0x00000000000000000000", "0x00000000000000000100", "0x00000000000000000400", "0xffffffffffffffffffff"]
    for low, high in zip(cuts, cuts[1:], strict=False):  # three files come one after another, in log order
        messages.where((F.col("lsn") > low) & (F.col("lsn") <= high)).coalesce(1).write.mode("append").parquet(f"{home}/in")
    stream = t.spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(f"{home}/in")
    replay.replay_stream(stream, f"{home}/out", f"{home}/checkpoint", ["user_id"], ["user_id", "event_type", "value", "props"], pipeline.index_order(), buckets=8).awaitTermination()
    return replay.current_table(t.spark, f"{home}/out")


@BOOK.query("replay_of_published", "SELECT user_id, event_type, value, props FROM live_user")
def replay_of_published(t: Inputs):
    """The whole way: published, read back from the messages' bytes, and folded into a table."""
    out, run = _published(t)
    rows = pipeline.decoded(sink.read(t.spark, out, "messages"), run.captures[0], run.codec)
    home = f"{out}-replay-{uuid.uuid4().hex}"
    rows.write.parquet(f"{home}/in")
    stream = t.spark.readStream.schema(rows.schema).parquet(f"{home}/in")
    replay.replay_stream(stream, f"{home}/out", f"{home}/checkpoint", ["user_id"], ["user_id", "event_type", "value", "props"], pipeline.index_order(), buckets=8).awaitTermination()
    return replay.current_table(t.spark, f"{home}/out")
