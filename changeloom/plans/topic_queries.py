"""Queries over topics, progress logs, replay, validation and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import FieldSpec, TableSpec
from changeloom.operators import changes, envelope, metrics, ops, progress, replay, validate
from changeloom.plans.book import Book, Inputs
from changeloom.sources import topic_log
from changeloom.sources.work import cut

BOOK = Book()

USER = TableSpec("app", "user_state", "app_user_state_v2", (FieldSpec("user_id", "bigint", 1, 1), FieldSpec("event_type", "varchar", 2, truncate_after=4), FieldSpec("value", "float", 3), FieldSpec("props", "nvarchar", 4)), topic="app_user_state_cdc")
_INDEX = "lsn, command_id, seqval, operation"
_BAD = "topic_user_bad"


# ------------------------------------------------------------------ messages


@BOOK.query(
    "parse_rows",
    """SELECT 'app_user_state_cdc' AS topic, CASE WHEN operation = 0 THEN 'table-snapshot' ELSE 'table-change' END AS message_type, lsn, command_id, operation, tran_end_time AS event_time, user_id,
CASE WHEN operation = 4 THEN concat_ws(',', CASE WHEN update_mask & 1 <> 0 THEN 'user_id' END, CASE WHEN update_mask & 2 <> 0 THEN 'event_type' END, CASE WHEN update_mask & 4 <> 0 THEN 'value' END, CASE WHEN update_mask & 8 <> 0 THEN 'props' END) ELSE 'user_id,event_type,value,props' END AS fields,
left(event_type, 4) AS event_type, CASE WHEN strlen(event_type) > 4 THEN strlen(event_type) || ',4' END AS cut FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)""",
)
def parse_rows(t: Inputs):
    rows = envelope.envelope(changes.with_event_time(changes.published(t.ct_user), t.ltm), USER, X.int_mask(F.col("update_mask")))
    return rows.select("topic", "message_type", F.col("idx.lsn").alias("lsn"), F.col("idx.command_id").alias("command_id"), "operation", "event_time", F.col("key.user_id").alias("user_id"), F.array_join("updated_fields", ",").alias("fields"), F.col("value.event_type").alias("event_type"), F.col("headers")["truncated_event_type"].alias("cut"))


@BOOK.query(
    "change_messages",
    """SELECT topic, message_type, partition_id, row_number() OVER (PARTITION BY topic, partition_id ORDER BY lsn, command_id, seqval) - 1 AS msg_offset, lsn, command_id, operation, entity FROM (
SELECT 'app_user_state_cdc' AS topic, 'table-change' AS message_type, CAST(user_id % 3 AS INT) AS partition_id, lsn, command_id, seqval, operation, user_id AS entity FROM ct_user WHERE operation IN (1,2,4)
UNION ALL SELECT 'app_customer_order_cdc', 'table-change', CAST(o_custkey % 3 AS INT), lsn, command_id, seqval, operation, o_custkey FROM ct_order WHERE operation IN (1,2,4)) x""",
)
def change_messages(t: Inputs):
    def one(ct, topic, key):
        return changes.published(ct).select(F.lit(topic).alias("topic"), F.lit("table-change").alias("message_type"), (F.col(key) % 3).cast("int").alias("partition_id"), "lsn", "command_id", "seqval", "operation", F.col(key).alias("entity"))

    both = changes.union_all([one(t.ct_user, "app_user_state_cdc", "user_id"), one(t.ct_order, "app_customer_order_cdc", "o_custkey")])
    place = F.row_number().over(Window.partitionBy("topic", "partition_id").orderBy("lsn", "command_id", "seqval")).cast("long") - 1
    return both.withColumn("msg_offset", place).drop("seqval")


@BOOK.query(
    "tombstones",
    "SELECT user_id, lsn, command_id, 0 AS sub, operation, event_type, 'table-change' AS message_type FROM ct_user WHERE operation IN (1,2,4) UNION ALL SELECT user_id, lsn, command_id, 1, NULL, NULL, 'deletion-tombstone' FROM ct_user WHERE operation = 1",
)
def tombstones(t: Inputs):
    rows = envelope.with_tombstones(changes.published(t.ct_user).select("user_id", "lsn", "command_id", "operation", F.lit("table-change").alias("message_type"), F.col("event_type").alias("value")))
    return rows.select("user_id", "lsn", "command_id", "sub", "operation", F.col("value").alias("event_type"), "message_type")


@BOOK.query(
    "unified_topic",
    f"SELECT 'app_all_changes' AS topic, 'unified-change' AS message_type, original_topic, {_INDEX} FROM (SELECT 'app_user_state_cdc' AS original_topic, {_INDEX} FROM ct_user WHERE operation IN (1,2,4) UNION ALL SELECT 'app_customer_order_cdc', {_INDEX} FROM ct_order WHERE operation IN (1,2,4)) x UNION ALL SELECT 'users_only', 'unified-change', 'app_user_state_cdc', {_INDEX} FROM ct_user WHERE operation IN (1,2,4)",
)
def unified_topic(t: Inputs):
    tables = t.change_tables.where("object_id IN (12, 13)").withColumn("topic", X.topic_name("{schema_name}_{table_name}_cdc", F.col("schema_name"), F.col("table_name")))
    routes = envelope.routes(tables, {"app_all_changes": r"APP\.", "users_only": r"app\.user"})
    messages = changes.union_all([changes.published(df).select(F.lit(topic).alias("topic"), "lsn", "command_id", "seqval", "operation") for df, topic in ((t.ct_user, "app_user_state_cdc"), (t.ct_order, "app_customer_order_cdc"))])
    return envelope.unified_copies(messages, routes).select("topic", "message_type", "original_topic", "lsn", "command_id", "seqval", "operation")


# ------------------------------------------------------------------ reading topics


@BOOK.query("topic_full_read", "SELECT topic, partition_id, msg_offset, operation, lsn FROM topic_user")
def topic_full_read(t: Inputs):
    return t.topic_user.select("topic", "partition_id", "msg_offset", "operation", "lsn")


@BOOK.query("topic_watermarks", "SELECT topic, partition_id, min(msg_offset) AS low, max(msg_offset) + 1 AS high, count(*) AS messages FROM topic_user GROUP BY topic, partition_id")
def topic_watermarks(t: Inputs):
    return topic_log.watermarks(t.topic_user)


@BOOK.query(
    "topic_bounded_read",
    "SELECT t.topic, t.partition_id, t.msg_offset FROM topic_user t JOIN (SELECT topic, partition_id, min(msg_offset) AS lo, max(msg_offset) + 1 AS hi, count(*) OVER (PARTITION BY topic) AS parts FROM topic_user GROUP BY topic, partition_id) w ON w.topic = t.topic AND w.partition_id = t.partition_id WHERE t.msg_offset >= greatest(lo, hi - 1000 // parts) AND t.msg_offset < hi",
)
def topic_bounded_read(t: Inputs):
    log = t.topic_user
    return topic_log.bounded(log, topic_log.watermarks(log).select("topic", "partition_id", "low", "high"), 1000).select("topic", "partition_id", "msg_offset")


_TIMED = "SELECT u.topic, u.partition_id, u.msg_offset, l.tran_end_time AS seen FROM topic_user u JOIN ltm l ON l.start_lsn = u.lsn"


@BOOK.query("topic_from_timestamp", f"WITH m AS ({_TIMED}), f AS (SELECT partition_id, min(msg_offset) AS o FROM m WHERE seen >= (SELECT max(tran_end_time) - INTERVAL 2 DAY FROM ltm) GROUP BY 1) SELECT m.topic, m.partition_id, m.msg_offset FROM m LEFT JOIN f ON f.partition_id = m.partition_id WHERE f.o IS NULL OR m.msg_offset >= f.o")
def topic_from_timestamp(t: Inputs):
    log = t.topic_user.join(t.ltm, F.col("lsn") == F.col("start_lsn")).select("topic", "partition_id", "msg_offset", F.col("tran_end_time").alias("at"))
    since = t.ltm.agg((F.max("tran_end_time") - F.expr("INTERVAL 2 DAY")).alias("t")).first()["t"]
    return topic_log.since(log, "at", F.lit(since)).select("topic", "partition_id", "msg_offset")


@BOOK.query("topic_name_parse", "SELECT topic, 'app' AS schema_name, CASE topic WHEN 'app_user_state_cdc' THEN 'user_state' ELSE 'customer_order' END AS table_name FROM (VALUES ('app_user_state_cdc'), ('app_customer_order_cdc')) v(topic)")
def topic_name_parse(t: Inputs):
    names = t.spark.createDataFrame([("app_user_state_cdc",), ("app_customer_order_cdc",), ("_progress",)], "topic string")
    return topic_log.parse_names(names, r"^([a-z]+)_(\w+)_cdc$")


# ------------------------------------------------------------------ progress


@BOOK.query(
    "progress_latest",
    "SELECT topic_name, progress_kind, msg_offset, lsn, command_id, seqval, operation FROM (SELECT *, row_number() OVER (PARTITION BY topic_name, progress_kind, change_table_name ORDER BY msg_offset DESC) AS r FROM progress_log) x WHERE r = 1 AND lsn IS NOT NULL",
)
def progress_latest(t: Inputs):
    return progress.latest(t.progress_log, ["topic_name", "progress_kind", "change_table_name"], "lsn").select("topic_name", "progress_kind", "msg_offset", "lsn", "command_id", "seqval", "operation")


@BOOK.query("progress_per_topic", f"SELECT topic, 'change_rows' AS progress_kind, {_INDEX}, n FROM (SELECT topic, {_INDEX}, count(*) OVER (PARTITION BY topic) AS n, row_number() OVER (PARTITION BY topic ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC) AS r FROM topic_full WHERE operation IN (1,2,4)) x WHERE r = 1")
def progress_per_topic(t: Inputs):
    return progress.per_topic(t.topic_full)


@BOOK.query("snapshot_progress_per_topic", "SELECT topic, 'snapshot_rows' AS progress_kind, min(user_id) AS user_id FROM topic_full WHERE operation = 0 GROUP BY topic")
def snapshot_progress_per_topic(t: Inputs):
    return progress.snapshot_per_topic(t.topic_full, ["user_id"])


@BOOK.query("heartbeat_progress", "SELECT 'app_idle_cdc' AS topic, 'change_rows' AS progress_kind, '0x00000000000000000400' AS lsn, 2147483647 AS command_id, '0xffffffffffffffffffff' AS seqval, 4 AS operation")
def heartbeat_progress(t: Inputs):
    topics = t.spark.createDataFrame([("app_user_state_cdc",), ("app_idle_cdc",)], "topic string")
    return progress.heartbeats(topics, progress.per_topic(t.topic_full), "0x00000000000000000400")


_REQUESTS = "(SELECT 'app_user_state_cdc' AS topic_name, 'change_rows' AS progress_kind UNION ALL SELECT 'app_user_state_cdc', 'snapshot_rows' UNION ALL SELECT 'unknown', 'change_rows')"


def _requests(t: Inputs):
    return t.spark.createDataFrame([("app_user_state_cdc", "change_rows"), ("app_user_state_cdc", "snapshot_rows"), ("unknown", "change_rows")], "topic_name string, progress_kind string")


@BOOK.query(
    "progress_reset_plan",
    f"SELECT q.topic_name, q.progress_kind, CASE WHEN EXISTS (SELECT 1 FROM (SELECT topic_name, progress_kind, arg_max(coalesce(lsn, ''), msg_offset) AS l FROM progress_log GROUP BY 1, 2) p WHERE p.topic_name = q.topic_name AND p.progress_kind = q.progress_kind AND l <> '') THEN 'reset' ELSE 'no progress' END AS action FROM {_REQUESTS} q",
)
def progress_reset_plan(t: Inputs):
    return progress.reset_plan(_requests(t), progress.latest(t.progress_log, ["topic_name", "progress_kind"], "lsn"))


@BOOK.query("progress_after_reset", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS left_over, (SELECT count(*) FROM progress_log) + 1 AS entries FROM (SELECT 1) x")
def progress_after_reset(t: Inputs):
    log = t.progress_log
    plan = progress.reset_plan(_requests(t), progress.latest(log, ["topic_name", "progress_kind"], "lsn"))
    after = progress.with_resets(log, plan, 10_000_000)
    left = progress.latest(after, ["topic_name", "progress_kind"], "lsn").agg(F.count("*").alias("left_over"))
    return left.join(F.broadcast(after.agg(F.count("*").alias("entries"))), how="cross").select(F.lit(1).cast("long").alias("n"), "left_over", "entries")  # one row each


@BOOK.query("snapshot_log_event", "SELECT msg_offset, topic_name, action, string_agg(partition_id || '=' || high_watermark, ',' ORDER BY partition_id) AS watermarks FROM snapshot_log GROUP BY msg_offset, topic_name, action")
def snapshot_log_event(t: Inputs):
    return progress.snapshot_event(t.snapshot_log)


@BOOK.query("progress_order_problems", f"SELECT topic_name, msg_offset, CASE WHEN ROW(lsn, command_id, seqval, operation) = b AND NOT (seqval = '0xffffffffffffffffffff' AND operation = 4) THEN 'duplicate' ELSE 'unordered' END AS problem FROM (SELECT *, lag(ROW({_INDEX})) OVER (PARTITION BY topic_name ORDER BY msg_offset) AS b FROM progress_log WHERE lsn IS NOT NULL) x WHERE (ROW({_INDEX}) = b AND NOT (seqval = '0xffffffffffffffffffff' AND operation = 4)) OR b > ROW({_INDEX})")
def progress_order_problems(t: Inputs):
    return validate.progress_problems(t.progress_log)


@BOOK.query("snapshot_progress_problems", "SELECT topic_name, msg_offset, CASE WHEN bt <> change_table_name THEN 'evolution' ELSE 'problem' END AS kind FROM (SELECT *, lag(last_key) OVER w AS b, lag(change_table_name) OVER w AS bt FROM snapshot_progress WINDOW w AS (PARTITION BY topic_name ORDER BY msg_offset)) x WHERE last_key IS NOT NULL AND bt IS NOT NULL AND (b IS NULL OR b < last_key)")
def snapshot_progress_problems(t: Inputs):
    return validate.snapshot_problems(t.snapshot_progress)


_SUMMARY = f"""SELECT s.*, coalesce(p.problems, 0) AS problems FROM (SELECT topic_name, count(*) FILTER (progress_kind = 'change_rows' AND lsn IS NOT NULL) AS change_entries, count(*) FILTER (progress_kind = 'snapshot_rows') AS snapshot_entries,
count(*) FILTER (progress_kind = 'change_rows' AND lsn IS NULL) AS resets, count(*) FILTER (seqval = '0xffffffffffffffffffff' AND operation = 4) AS heartbeats, count(DISTINCT change_table_name) FILTER (lsn IS NOT NULL OR progress_kind = 'snapshot_rows') AS change_tables FROM progress_kinds GROUP BY 1) s
LEFT JOIN (SELECT topic_name, count(*) AS problems FROM (SELECT *, lag(ROW({_INDEX})) OVER (PARTITION BY topic_name ORDER BY msg_offset) AS b FROM progress_log WHERE lsn IS NOT NULL) x WHERE (ROW({_INDEX}) = b AND NOT (seqval = '0xffffffffffffffffffff' AND operation = 4)) OR b > ROW({_INDEX}) GROUP BY 1) p ON p.topic_name = s.topic_name"""


@BOOK.query("progress_topic_summary", _SUMMARY)
def progress_topic_summary(t: Inputs):
    return validate.progress_summary(t.progress_kinds)


@BOOK.query("progress_anomalies", f"SELECT * FROM ({_SUMMARY}) y WHERE change_tables > 1 OR resets > 0 OR problems > 0")
def progress_anomalies(t: Inputs):
    return validate.anomalies(validate.progress_summary(t.progress_kinds))


# ------------------------------------------------------------------ replay

_LIVE = "SELECT user_id, event_type, value, props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY msg_offset DESC) AS r FROM topic_user) x WHERE r = 1 AND operation IS NOT NULL AND operation <> 1"
_COLUMNS = ["user_id", "event_type", "value", "props"]


@BOOK.query("latest_per_key", "SELECT user_id, msg_offset, operation FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY msg_offset DESC) AS r FROM topic_user) x WHERE r = 1")
def latest_per_key(t: Inputs):
    return replay.latest_per_key(t.topic_user, ["user_id"]).select("user_id", "msg_offset", "operation")


@BOOK.query("replay_apply", _LIVE)
def replay_apply(t: Inputs):
    return replay.apply(None, t.topic_user, ["user_id"], _COLUMNS)


@BOOK.query("replay_in_two_batches", _LIVE)
def replay_in_two_batches(t: Inputs):
    first = replay.apply(None, t.topic_user.where("msg_offset < 700"), ["user_id"], _COLUMNS)
    return replay.apply(first, t.topic_user.where("msg_offset >= 700"), ["user_id"], _COLUMNS)


@BOOK.query("replay_cols_to_not_sync", f"SELECT user_id, event_type, props FROM ({_LIVE}) y")
def replay_cols_to_not_sync(t: Inputs):
    return replay.apply(None, t.topic_user, ["user_id"], _COLUMNS, skip=["VALUE"])


@BOOK.query("replay_delete_anti_join", "SELECT user_id, event_type FROM live_user l WHERE NOT EXISTS (SELECT 1 FROM ct_user c WHERE c.user_id = l.user_id AND operation = 1 AND lsn > '0x00000000000000000900')")
def replay_delete_anti_join(t: Inputs):
    deletes = t.ct_user.where("operation = 1 AND lsn > '0x00000000000000000900'").select("user_id").distinct()
    return replay.without_deleted(t.live_user.select("user_id", "event_type"), deletes, ["user_id"])


@BOOK.query("replay_merge_upsert", "SELECT coalesce(u.user_id, l.user_id) AS user_id, CASE WHEN u.user_id IS NOT NULL THEN u.event_type ELSE l.event_type END AS event_type FROM live_user l FULL OUTER JOIN (SELECT user_id, 'merged' AS event_type FROM (SELECT DISTINCT user_id FROM ct_user WHERE user_id % 4 = 1) d) u ON u.user_id = l.user_id")
def replay_merge_upsert(t: Inputs):
    fresh = t.ct_user.where("user_id % 4 = 1").select("user_id").distinct().withColumn("event_type", F.lit("merged"))
    return replay.upserted(t.live_user.select("user_id", "event_type"), fresh, ["user_id"])


@BOOK.query("replay_progress", "SELECT topic, partition_id, max(msg_offset) AS last_offset FROM topic_user GROUP BY topic, partition_id")
def replay_progress(t: Inputs):
    log = t.topic_user
    return replay.merged_progress(replay.progress(log.where("msg_offset < 500")), replay.progress(log.where("msg_offset >= 500")))


@BOOK.query("replay_resume_offsets", "SELECT topic, partition_id, msg_offset FROM topic_user WHERE partition_id = 2 OR msg_offset > 300 + partition_id")
def replay_resume_offsets(t: Inputs):
    done = t.spark.createDataFrame([("app_user_state_cdc", 0, 300), ("app_user_state_cdc", 1, 301)], "topic string, partition_id int, last_offset long")
    return replay.resume_from(t.topic_user.select("topic", "partition_id", "msg_offset"), done)


# ------------------------------------------------------------------ validation


@BOOK.query("missing_offsets", f"SELECT topic, partition_id, CAST(sum(g) AS BIGINT) AS missing FROM (SELECT topic, partition_id, msg_offset - coalesce(lag(msg_offset) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset), -1) - 1 AS g FROM {_BAD}) x GROUP BY topic, partition_id")
def missing_offsets(t: Inputs):
    return validate.missing_offsets(t.topic_user_bad)


@BOOK.query("change_order_regressions", f"SELECT topic, partition_id, count(*) FILTER (b > ROW({_INDEX})) AS regressions FROM (SELECT *, lag(ROW({_INDEX})) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset) AS b FROM {_BAD} WHERE operation IN (1,2,4)) x GROUP BY topic, partition_id")
def change_order_regressions(t: Inputs):
    return validate.change_regressions(t.topic_user_bad)


_FULL_BAD = "(SELECT topic, partition_id, CASE WHEN msg_offset % 10 = 3 THEN msg_offset + 1 WHEN msg_offset % 10 = 4 THEN msg_offset - 1 ELSE msg_offset END AS msg_offset, user_id, operation FROM topic_full)"


@BOOK.query("snapshot_order_regressions", f"SELECT topic, partition_id, count(*) FILTER (b < user_id) AS regressions FROM (SELECT *, lag(user_id) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset) AS b FROM {_FULL_BAD} f WHERE operation = 0) x GROUP BY topic, partition_id")
def snapshot_order_regressions(t: Inputs):
    swapped = F.when(F.col("msg_offset") % 10 == 3, F.col("msg_offset") + 1).when(F.col("msg_offset") % 10 == 4, F.col("msg_offset") - 1).otherwise(F.col("msg_offset"))
    return validate.snapshot_regressions(t.topic_full.withColumn("msg_offset", swapped), ["user_id"])


@BOOK.query("missing_tombstones", f"SELECT topic, partition_id, msg_offset FROM (SELECT *, lead(coalesce(operation, -1)) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset) AS a FROM {_BAD}) x WHERE operation = 1 AND a <> -1")
def missing_tombstones(t: Inputs):
    return validate.missing_tombstones(t.topic_user_bad)


@BOOK.query(
    "topic_message_summary",
    f"SELECT topic, count(*) AS total, count(*) FILTER (operation IS NULL) AS tombstones, count(*) FILTER (operation = 1) AS all_deletes, count(*) FILTER (operation = 1 AND lsn >= '0x00000000000000000065') AS deletes, count(*) FILTER (operation = 2 AND lsn >= '0x00000000000000000065') AS inserts, count(*) FILTER (operation = 4 AND lsn >= '0x00000000000000000065') AS updates, count(*) FILTER (operation = 0) AS snapshots, CAST(0 AS BIGINT) AS unknown_operations, min(lsn) FILTER (lsn >= '0x00000000000000000065' AND operation IN (1,2,4)) AS low_lsn, max(lsn) FILTER (lsn >= '0x00000000000000000065' AND operation IN (1,2,4)) AS high_lsn FROM topic_full GROUP BY topic",
)
def topic_message_summary(t: Inputs):
    return validate.summary(t.topic_full, "0x00000000000000000065").withColumn("low_lsn", F.col("low.lsn")).withColumn("high_lsn", F.col("high.lsn")).drop("low", "high")


@BOOK.query(
    "distinct_key_counts",
    "SELECT topic, count(DISTINCT user_id) FILTER (operation = 0) AS snapshot_keys, count(DISTINCT user_id) FILTER (operation IN (1,2,4)) AS change_keys, count(DISTINCT user_id) FILTER (operation = 1) AS deleted_keys, (SELECT count(*) FROM (SELECT user_id FROM topic_full WHERE operation = 0 EXCEPT SELECT user_id FROM topic_full WHERE operation = 1) e) AS snapshot_keys_left FROM topic_full GROUP BY topic",
)
def distinct_key_counts(t: Inputs):
    return validate.distinct_keys(t.topic_full, ["user_id"])


@BOOK.query("snapshot_keys_minus_deleted", "SELECT topic, user_id FROM topic_full WHERE operation = 0 EXCEPT SELECT topic, user_id FROM topic_full WHERE operation = 1 AND lsn > '0x00000000000000000900'")
def snapshot_keys_minus_deleted(t: Inputs):
    log = t.topic_full
    return log.where("operation = 0").select("topic", "user_id").distinct().join(log.where("operation = 1 AND lsn > '0x00000000000000000900'").select("topic", "user_id"), ["topic", "user_id"], "left_anti")


_RANGE = "user_id BETWEEN (SELECT min(user_id) FROM topic_full WHERE operation = 0) AND (SELECT max(user_id) FROM topic_full WHERE operation = 0)"


_LATE = "(SELECT * FROM topic_full WHERE operation = 0 OR lsn > '0x00000000000000000900')"


@BOOK.query("expected_live_keys", f"SELECT topic, user_id FROM {_LATE} a WHERE operation IN (0,1,2,4) AND {_RANGE} EXCEPT SELECT topic, user_id FROM {_LATE} b WHERE operation = 1")
def expected_live_keys(t: Inputs):
    return validate.live_keys(t.topic_full.where("operation = 0 OR lsn > '0x00000000000000000900'"), ["user_id"])


@BOOK.query("expected_live_keys_by_last", f"SELECT 'app_user_state_cdc' AS topic, user_id FROM live_user WHERE {_RANGE}")
def expected_live_keys_by_last(t: Inputs):
    return validate.live_keys(t.topic_full, ["user_id"], by_last_operation=True)


def _verdicts(t: Inputs, log):
    # A topic and a change table are tables in use; here they are derived, so they are written once instead of made anew for each part.
    ct = cut(t.ct_user)
    last = progress.per_topic(changes.published(ct).withColumn("topic", F.lit("app_user_state_cdc"))).select("topic", "lsn", "command_id", "seqval", "operation")
    return validate.table_verdicts(cut(log), ["user_id"], "0x", ct, t.live_user, last)


def _verdict_sql(log: str, recorded: str) -> str:
    """Every rule and warning, over any number of topics."""
    rules = {
        "source_rows": "coalesce(keys_left, 0) > 0 AND coalesce(source_rows, 0) <> coalesce(expected_rows, 0)",
        "no_progress": "recorded IS NULL",
        "heartbeat_behind": "recorded IS NOT NULL AND beat AND high > recorded",
        "progress_differs": "recorded IS NOT NULL AND NOT beat AND high IS DISTINCT FROM recorded",
        "index_order": "index_regressions > 0",
        "snapshot_order": "snapshot_regressions > 0 AND keys_left = snapshots",
        "unknown_operations": "unknown_operations > 0",
        "tombstones": "tombstones > 0 AND tombstones < all_deletes",
        **{n: f"{n} <> (SELECT count(*) FROM ct_user WHERE operation = {op} AND ROW({_INDEX}) <= high)" for n, op in (("deletes", 1), ("inserts", 2), ("updates", 4))},
    }
    warnings = {"snapshot_repeats": "snapshots > 0 AND snapshot_keys <> snapshots", "snapshot_order": "snapshot_regressions > 0 AND keys_left <> snapshots"}
    said = lambda found: "concat_ws(',', " + ", ".join(f"CASE WHEN {when} THEN '{name}' END" for name, when in found.items()) + ")"
    return f"""WITH c AS (SELECT * FROM {log}), r AS (SELECT topic, ROW({_INDEX}) AS recorded, seqval = '0xffffffffffffffffffff' AND operation = 4 AS beat FROM {recorded}),
ch AS (SELECT topic, ROW({_INDEX}) AS i, lag(ROW({_INDEX})) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset) AS b FROM c WHERE operation IN (1,2,4)),
sn AS (SELECT topic, user_id, lag(user_id) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset) AS b FROM c WHERE operation = 0),
base AS (SELECT topic, count(*) AS total, count(*) FILTER (operation IS NULL) AS tombstones, count(*) FILTER (operation = 1) AS all_deletes, count(*) FILTER (operation = 1) AS deletes, count(*) FILTER (operation = 2) AS inserts, count(*) FILTER (operation = 4) AS updates,
 count(*) FILTER (operation = 0) AS snapshots, count(*) FILTER (operation NOT IN (0,1,2,4)) AS unknown_operations FROM c GROUP BY topic),
hi AS (SELECT topic, max(i) AS high, count(*) FILTER (b > i) AS index_regressions FROM ch GROUP BY topic),
sr AS (SELECT topic, count(*) FILTER (b < user_id) AS snapshot_regressions, min(user_id) AS lo, max(user_id) AS up, count(DISTINCT user_id) AS snapshot_keys FROM sn GROUP BY topic),
k AS (SELECT topic, user_id, bool_or(operation = 0) AS s, bool_or(operation = 1) AS d FROM c WHERE operation IS NOT NULL GROUP BY 1, 2),
e AS (SELECT k.topic, count(*) FILTER (s AND NOT d) AS keys_left, count(*) FILTER (NOT d AND user_id BETWEEN lo AND up) AS expected_rows FROM k LEFT JOIN sr ON sr.topic = k.topic GROUP BY 1),
h AS (SELECT topic, count(*) AS source_rows FROM sr JOIN live_user ON user_id BETWEEN lo AND up GROUP BY 1),
f AS (SELECT * FROM base LEFT JOIN hi USING (topic) LEFT JOIN sr USING (topic) LEFT JOIN e USING (topic) LEFT JOIN h USING (topic) LEFT JOIN r USING (topic))
SELECT topic, total, tombstones, all_deletes, deletes, inserts, updates, snapshots, coalesce(index_regressions, 0) AS index_regressions, coalesce(expected_rows, 0) AS expected_rows, coalesce(source_rows, 0) AS source_rows, {said(rules)} AS failures, {said(warnings)} AS warnings FROM f"""


_RECORDED = "(SELECT 'app_user_state_cdc' AS topic, * FROM (SELECT lsn, command_id, seqval, operation FROM ct_user WHERE operation IN (1,2,4) ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1) l)"


@BOOK.query("validation_rules", _verdict_sql("topic_faults", "fault_progress"))
def validation_rules(t: Inputs):
    """A topic for each rule that is broken, and a sound one."""
    return validate.table_verdicts(cut(t.topic_faults), ["user_id"], "0x", cut(t.ct_user), t.live_user, t.fault_progress)


@BOOK.query("validate_table_topic", _verdict_sql("topic_full", _RECORDED))
def validate_table_topic(t: Inputs):
    return _verdicts(t, t.topic_full)


@BOOK.query("validation_verdicts", _verdict_sql("topic_user_bad", _RECORDED))
def validation_verdicts(t: Inputs):
    return _verdicts(t, t.topic_user_bad)


def _unified_sql(log: str) -> str:
    near = f"(SELECT *, last_value(CASE WHEN operation IS NOT NULL THEN ROW({_INDEX}) END IGNORE NULLS) OVER (PARTITION BY topic, partition_id ORDER BY msg_offset ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM {log})"
    counts = f"SELECT topic, count(*) AS total, count(*) FILTER (operation IS NOT NULL AND b > ROW({_INDEX})) AS regressions, count(*) FILTER (operation IS NULL) AS tombstones, count(*) FILTER (operation IS NOT NULL AND original_topic NOT IN ('app_user_state_cdc', 'app_customer_order_cdc')) AS unexpected, count(*) FILTER (operation = 0) AS snapshots FROM {near} x GROUP BY topic"
    return f"SELECT *, concat_ws(',', CASE WHEN regressions > 0 THEN 'index_order' END, CASE WHEN tombstones > 0 THEN 'tombstones' END, CASE WHEN snapshots > 0 THEN 'snapshots' END) AS failures, CASE WHEN unexpected > 0 THEN 'unexpected_topics' ELSE '' END AS warnings FROM ({counts}) y"


@BOOK.query("unified_regressions", f"SELECT topic, regressions FROM ({_unified_sql('topic_unified')}) z")
def unified_regressions(t: Inputs):
    return validate.unified_verdicts(t.topic_unified, ["app_user_state_cdc", "app_customer_order_cdc"]).select("topic", "regressions")


@BOOK.query("unified_rules", _unified_sql("unified_faults"))
def unified_rules(t: Inputs):
    return validate.unified_verdicts(t.unified_faults, ["app_user_state_cdc", "app_customer_order_cdc"])


@BOOK.query("validate_unified_topic", _unified_sql("topic_unified"))
def validate_unified_topic(t: Inputs):
    return validate.unified_verdicts(t.topic_unified, ["app_user_state_cdc", "app_customer_order_cdc"])


_POSITIONS = f"""(SELECT coalesce(m.partition_id, r.partition_id) AS partition_id, coalesce(m.n, r.n) AS n, m.n AS mn, r.n AS rn, m.i = r.i AS same FROM (SELECT partition_id, row_number() OVER (PARTITION BY partition_id ORDER BY msg_offset) AS n, ROW({_INDEX}) AS i FROM topic_user_bad WHERE operation IN (1,2,4)) m
FULL OUTER JOIN (SELECT CAST(user_id % 3 AS INT) AS partition_id, row_number() OVER (PARTITION BY user_id % 3 ORDER BY {_INDEX}) AS n, ROW({_INDEX}) AS i FROM ct_user WHERE operation IN (1,2,4)) r ON r.partition_id = m.partition_id AND r.n = m.n)"""


@BOOK.query("row_compare", f"SELECT partition_id, count(*) AS rows, count(*) FILTER (same) AS same, count(*) FILTER (mn IS NULL) AS only_table, count(*) FILTER (rn IS NULL) AS only_topic FROM {_POSITIONS} x GROUP BY partition_id")
def row_compare(t: Inputs):
    return validate.comparison(cut(t.topic_user_bad), cut(t.ct_user), (F.col("user_id") % 3).cast("int"))


@BOOK.query("mismatch_blocks", f"SELECT partition_id, count(*) AS blocks, min(size) AS least, max(size) AS most, round(avg(size), 6) AS mean FROM (SELECT partition_id, run, count(*) AS size FROM (SELECT partition_id, n - row_number() OVER (PARTITION BY partition_id ORDER BY n) AS run FROM {_POSITIONS} x WHERE NOT coalesce(same, false)) y GROUP BY partition_id, run) z GROUP BY partition_id")
def mismatch_blocks(t: Inputs):
    return validate.mismatch_blocks(cut(t.topic_user_bad), cut(t.ct_user), (F.col("user_id") % 3).cast("int"))


@BOOK.query("summary_json", """SELECT topic, '{"total":' || count(*) || ',"tombstones":' || count(*) FILTER (operation IS NULL) || ',"deletes":' || count(*) FILTER (operation = 1) || '}' AS report FROM topic_user GROUP BY topic""")
def summary_json(t: Inputs):
    return validate.summary(t.topic_user, "0x").select("topic", F.to_json(F.struct("total", "tombstones", "deletes")).alias("report"))


# ------------------------------------------------------------------ reports and metrics


@BOOK.query("truncation_opportunities", "SELECT s.topic_name, s.partition_id, s.m AS start_mark, c.m AS completion_mark, l.low_watermark, CASE WHEN c.m IS NULL OR c.m < s.m THEN '!NOT COMPLETE!' WHEN l.low_watermark >= s.m THEN 'No' ELSE 'Yes' END AS needs_truncation FROM (SELECT topic_name, partition_id, arg_max(high_watermark, msg_offset) AS m FROM snapshot_log WHERE action = 'started' GROUP BY 1, 2) s JOIN topic_low_watermarks l ON l.topic_name = s.topic_name AND l.partition_id = s.partition_id LEFT JOIN (SELECT topic_name, partition_id, arg_max(high_watermark, msg_offset) AS m FROM snapshot_log WHERE action = 'completed' GROUP BY 1, 2) c ON c.topic_name = s.topic_name AND c.partition_id = s.partition_id")
def truncation_opportunities(t: Inputs):
    return ops.truncation(t.snapshot_log, t.topic_low_watermarks)


@BOOK.query("snapshot_completion_state", "SELECT topic_name, coalesce(max(msg_offset) FILTER (action = 'completed') > max(msg_offset) FILTER (action = 'started'), false) AS complete FROM snapshot_log GROUP BY topic_name")
def snapshot_completion_state(t: Inputs):
    return ops.completion_state(t.snapshot_log)


@BOOK.query("snapshot_history", "SELECT s.topic_name, bool_and(coalesce(l.low_watermark = s.m, false)) AS begins_at_snapshot, (SELECT coalesce(max(msg_offset) FILTER (action = 'completed') > max(msg_offset) FILTER (action = 'started'), false) FROM snapshot_log z WHERE z.topic_name = s.topic_name) AS complete FROM (SELECT topic_name, partition_id, arg_max(high_watermark, msg_offset) AS m FROM snapshot_log WHERE action = 'started' GROUP BY 1, 2) s LEFT JOIN topic_low_watermarks l ON l.topic_name = s.topic_name AND l.partition_id = s.partition_id GROUP BY s.topic_name")
def snapshot_history(t: Inputs):
    return ops.history(t.snapshot_log, t.topic_low_watermarks)


def _produced(t: Inputs):
    rows = t.topic_user.join(t.ltm, F.col("lsn") == F.col("start_lsn"), "left").select("operation", "lsn", F.col("tran_end_time").alias("event_time"), "msg_offset")
    return rows.select("operation", "lsn", "event_time", F.timestamp_add("SECOND", F.col("msg_offset") % 7 + 1, F.col("event_time")).alias("produced_at"), F.lit(False).alias("unified"))


_PRODUCED = "(SELECT operation, lsn, tran_end_time AS event_time, msg_offset % 7 + 1 AS late FROM topic_user LEFT JOIN ltm ON start_lsn = lsn)"
_METRICS = "count(*) AS produces_count, count(*) FILTER (operation = 1) AS produced_delete_changes_count, count(*) FILTER (operation = 2) AS produced_insert_changes_count, count(*) FILTER (operation = 4) AS produced_update_changes_count, CAST(0 AS BIGINT) AS produced_snapshot_records_count, count(*) FILTER (operation IS NULL) AS produced_deletion_tombstones_count, CAST(0 AS BIGINT) AS messages_copied_to_unified_topics, min(CASE WHEN operation IS NOT NULL THEN event_time END) AS earliest_change_db_tran_end_time_produced, max(CASE WHEN operation IS NOT NULL THEN event_time END) AS latest_change_db_tran_end_time_produced, count(operation) AS db_change_data_rows_retrieved_count, CAST(0 AS BIGINT) AS db_snapshot_rows_retrieved_count, count(operation) AS db_all_data_rows_retrieved_count, min(lsn) AS earliest_change_lsn_produced, max(lsn) AS latest_change_lsn_produced, round(avg(CASE WHEN operation IS NOT NULL THEN CAST(late AS DOUBLE) END), 3) AS e2e_latency_avg_sec, round(CAST(min(CASE WHEN operation IS NOT NULL THEN late END) AS DOUBLE), 3) AS e2e_latency_min_sec, round(CAST(max(CASE WHEN operation IS NOT NULL THEN late END) AS DOUBLE), 3) AS e2e_latency_max_sec"


@BOOK.query("metrics_interval", f"SELECT {_METRICS} FROM {_PRODUCED} x")
def metrics_interval(t: Inputs):
    return metrics.interval(_produced(t))


@BOOK.query("metrics_tumbling", f"SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start, {_METRICS} FROM {_PRODUCED} x WHERE event_time IS NOT NULL GROUP BY 1")
def metrics_tumbling(t: Inputs):
    return metrics.tumbling(_produced(t), "1 day")


@BOOK.query("cdc_lag", "SELECT date_diff('second', max(tran_end_time), TIMESTAMP '2030-01-01 00:00:00') AS lag_sec FROM (SELECT date_trunc('second', tran_end_time) AS tran_end_time FROM ltm) x")
def cdc_lag(t: Inputs):
    return metrics.lag_seconds(t.ltm.select(F.date_trunc("second", "tran_end_time").cast("timestamp_ntz").alias("tran_end_time")), F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))


@BOOK.query("progress_of_topics", "SELECT topic_name, count(*) FILTER (progress_kind = 'change_rows' AND lsn IS NOT NULL) AS change_entries, count(*) FILTER (progress_kind = 'snapshot_rows') AS snapshot_entries FROM progress_kinds WHERE topic_name IN ('app_user_state_cdc', 'other') GROUP BY 1")
def progress_of_topics(t: Inputs):
    """The report over chosen topics."""
    chosen = t.progress_kinds.where(F.col("topic_name").isin("app_user_state_cdc", "other"))
    return validate.progress_summary(chosen).select("topic_name", "change_entries", "snapshot_entries")
