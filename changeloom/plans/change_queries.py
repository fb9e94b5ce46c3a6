"""Queries over change tables, source tables and the catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import INDEX_COLUMNS, ChangeIndex
from changeloom.operators import catalog, changes, envelope, snapshot
from changeloom.plans.book import Book, Inputs
from changeloom.sources.work import numbered

BOOK = Book()

START = ChangeIndex.of("0x00000000000000000065", 1, "0x00000000000000000191", 2)
CEILING = ChangeIndex.of("0x00000000000000000400", 3, "0x00000000000000001000", 4)
MAX_LSN = "0x00000000000000000400"
PAGE = 2000
ROW = ("lsn", "command_id", "seqval", "operation", "event_time", "user_id", "event_type", "value", "props")
_ROW = ", ".join(ROW)
_UPTO = f"(lsn, command_id, seqval, operation) <= ('{MAX_LSN}', 3, '0x00000000000000001000', 4)"
_AT = {"lsn": "0x00000000000000000065", "command_id": 1, "seqval": "0x00000000000000000191"}
_AFTER3 = "(lsn > '{lsn}' OR lsn = '{lsn}' AND command_id > {command_id} OR lsn = '{lsn}' AND command_id = {command_id} AND seqval > '{seqval}')".format(**_AT)
_ORDER = "lsn, command_id, seqval, operation"


@BOOK.query(
    "global_change_order",
    f"""SELECT row_number() OVER (ORDER BY {_ORDER}) AS pos, source, {_ORDER}, tran_end_time AS event_time, entity
FROM (SELECT 'app.user_state' AS source, {_ORDER}, user_id AS entity FROM ct_user UNION ALL SELECT 'app.customer_order', {_ORDER}, o_custkey FROM ct_order) u
JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4)""",
)
def global_change_order(t: Inputs):
    rows = changes.union_all([changes.published(df).select(F.lit(name).alias("source"), *INDEX_COLUMNS, F.col(key).alias("entity")) for name, df, key in (("app.user_state", t.ct_user, "user_id"), ("app.customer_order", t.ct_order, "o_custkey"))])
    return numbered(changes.with_event_time(rows, t.ltm), [F.col(c) for c in INDEX_COLUMNS]).select("pos", "source", *INDEX_COLUMNS, "event_time", "entity")


@BOOK.query("changes_incremental", f"SELECT {_ROW.replace('event_time', 'tran_end_time AS event_time')} FROM ct_user JOIN ltm ON start_lsn = lsn WHERE operation IN (1,2,4) AND lsn <= '{MAX_LSN}' AND {_AFTER3} ORDER BY {_ORDER} LIMIT {PAGE}")
def changes_incremental(t: Inputs):
    return changes.scan(t.ct_user, t.ltm, START, MAX_LSN, PAGE, with_operation=False).select(*ROW)


@BOOK.query("change_event_time_join", f"SELECT {_ORDER}, tran_end_time AS event_time FROM ct_order JOIN ltm ON start_lsn = lsn")
def change_event_time_join(t: Inputs):
    return changes.with_event_time(t.ct_order, t.ltm).select(*INDEX_COLUMNS, "event_time")


@BOOK.query("global_order_check", "SELECT CAST(0 AS BIGINT) AS violations")
def global_order_check(t: Inputs):
    return changes.order_violations(global_change_order(t), "pos").agg(F.count("*").alias("violations"))


@BOOK.query("common_lsn_ceiling", f"SELECT {_ORDER} FROM (SELECT * FROM (SELECT {_ORDER} FROM ct_user ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1) a UNION ALL SELECT * FROM (SELECT {_ORDER} FROM ct_order ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1) b) x ORDER BY {_ORDER} LIMIT 1")
def common_lsn_ceiling(t: Inputs):
    return changes.common_ceiling({"user": t.ct_user, "order": t.ct_order})


@BOOK.query("max_lsn", "SELECT max(start_lsn) AS max_lsn FROM ltm")
def max_lsn(t: Inputs):
    return changes.max_lsn(t.ltm)


@BOOK.query("latest_cdc_entry_time", "SELECT max(tran_end_time) AS latest_entry_time FROM ltm")
def latest_cdc_entry_time(t: Inputs):
    return changes.latest_entry_time(t.ltm)


@BOOK.query(
    "change_rows_per_second",
    "SELECT CAST(coalesce(n // nullif(s, 0), 0) AS BIGINT) AS rows_per_second FROM (SELECT count(*) AS n, date_diff('second', date_trunc('second', min(tran_end_time)), date_trunc('second', max(tran_end_time))) AS s FROM ct_user JOIN ltm ON start_lsn = lsn) x",
)
def change_rows_per_second(t: Inputs):
    return changes.rows_per_second(t.ct_user, t.ltm)


@BOOK.query(
    "auto_partition_count",
    "SELECT greatest(1, CAST(floor(coalesce(n // nullif(s, 0), 0) / 10.0) AS BIGINT)) AS partitions FROM (SELECT count(*) AS n, date_diff('second', date_trunc('second', min(tran_end_time)), date_trunc('second', max(tran_end_time))) AS s FROM ct_user JOIN ltm ON start_lsn = lsn) x",
)
def auto_partition_count(t: Inputs):
    return changes.rows_per_second(t.ct_user, t.ltm).select(envelope.partition_count(F.col("rows_per_second")).alias("partitions"))


@BOOK.query(
    "max_index_for_change_table",
    f"SELECT {_ORDER} FROM (SELECT {_ORDER} FROM ct_user UNION ALL SELECT '0x00000000000000000100', 0, '0x00000000000000000000', 0) x ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1",
)
def max_index_for_change_table(t: Inputs):
    return changes.max_index(t.ct_user, "0x000000000000000000ff")


@BOOK.query("count_by_operation", f"SELECT operation, count(*) AS n FROM ct_user WHERE operation IN (1,2,4) AND {_UPTO} GROUP BY operation")
def count_by_operation(t: Inputs):
    return changes.count_by_operation(t.ct_user, CEILING)


@BOOK.query("operation_counts", f"SELECT count(*) FILTER (operation=1) AS deletes, count(*) FILTER (operation=2) AS inserts, count(*) FILTER (operation=4) AS updates FROM ct_user WHERE {_UPTO}")
def operation_counts(t: Inputs):
    return changes.operation_counts(t.ct_user, CEILING)


@BOOK.query("change_indexes_for_validation", f"SELECT {_ORDER} FROM ct_user WHERE operation IN (1,2,4) AND lsn >= '0x00000000000000000065' ORDER BY {_ORDER} LIMIT 1500")
def change_indexes_for_validation(t: Inputs):
    return changes.indexes_for_validation(t.ct_user, 1500, "0x00000000000000000065")


@BOOK.query("min_lsn_for_max_age", "SELECT min(start_lsn) AS lsn FROM ltm WHERE tran_end_time >= (SELECT max(tran_end_time) - INTERVAL 1 DAY FROM ltm)")
def min_lsn_for_max_age(t: Inputs):
    latest = t.ltm.agg(F.max("tran_end_time").alias("t")).select((F.col("t") - F.expr("INTERVAL 1 DAY")).alias("since"))
    return t.ltm.join(F.broadcast(latest), F.col("tran_end_time") >= F.col("since")).agg(F.min("start_lsn").alias("lsn"))  # one row is broadcast


@BOOK.query("lsn_asof_time", "SELECT o.at, min(start_lsn) AS lsn FROM (SELECT DISTINCT date_trunc('hour', tran_end_time) AS at FROM ltm) o LEFT JOIN ltm ON tran_end_time >= o.at GROUP BY o.at")
def lsn_asof_time(t: Inputs):
    return changes.lsn_at_or_after(t.ltm, t.ltm.select(F.date_trunc("hour", "tran_end_time").cast("timestamp_ntz").alias("at")).distinct())


@BOOK.query("tran_end_time_for_lsn", "SELECT tran_end_time FROM ltm WHERE start_lsn = '0x00000000000000000065'")
def tran_end_time_for_lsn(t: Inputs):
    return t.ltm.where(F.col("start_lsn") == START.text()[0]).select("tran_end_time")


@BOOK.query(
    "infer_command_id",
    "SELECT p.msg_offset, p.lsn, p.seqval, p.operation, coalesce(c.command_id, 1) AS command_id FROM progress_log p LEFT JOIN (SELECT lsn, seqval, operation, min(command_id) AS command_id FROM ct_user GROUP BY 1, 2, 3) c ON c.lsn = p.lsn AND c.seqval = p.seqval AND c.operation = p.operation WHERE p.lsn IS NOT NULL",
)
def infer_command_id(t: Inputs):
    return changes.infer_command_id(t.progress_log.where("lsn IS NOT NULL").select("msg_offset", "lsn", "seqval", "operation"), t.ct_user).select("msg_offset", "lsn", "seqval", "operation", "command_id")


# ------------------------------------------------------------------ source tables


@BOOK.query("snapshot_first_page", "SELECT conv_id, turn, role FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 100")
def snapshot_first_page(t: Inputs):
    return snapshot.page(t.table("conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], 100)


@BOOK.query("snapshot_next_page", "SELECT conv_id, turn, role FROM conversations WHERE conv_id < 20 OR conv_id = 20 AND turn < 2 ORDER BY conv_id DESC, turn DESC LIMIT 30")
def snapshot_next_page(t: Inputs):
    return snapshot.page(t.table("conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], 30, [20, 2])


@BOOK.query("snapshot_full", "SELECT row_number() OVER (ORDER BY conv_id DESC, turn DESC) AS pos, conv_id, turn, role FROM conversations")
def snapshot_full(t: Inputs):
    return numbered(t.table("conversations").select("conv_id", "turn", "role"), [F.col("conv_id").desc(), F.col("turn").desc()])


@BOOK.query("snapshot_dropped_columns", "SELECT user_id, event_type, CAST(NULL AS VARCHAR) AS old_col FROM live_user")
def snapshot_dropped_columns(t: Inputs):
    return snapshot.columns(t.live_user, [("user_id", "long"), ("event_type", "string"), ("old_col", "string")])


@BOOK.query("composite_key_range", "SELECT conv_id, turn FROM conversations WHERE (conv_id > 5 OR conv_id = 5 AND turn >= 1) AND (conv_id < 40 OR conv_id = 40 AND turn <= 1)")
def composite_key_range(t: Inputs):
    return t.table("conversations").where(snapshot.range_condition(["conv_id", "turn"], [5, 1], [40, 1])).select("conv_id", "turn")


@BOOK.query("range_count", "SELECT count(*) AS n FROM orders WHERE o_orderkey BETWEEN 100 AND 900")
def range_count(t: Inputs):
    return snapshot.range_count(t.table("orders"), ["o_orderkey"], [100], [900])


@BOOK.query("bounded_count", "SELECT count(*) AS n FROM (SELECT 1 FROM lineitem LIMIT 5000) x")
def bounded_count(t: Inputs):
    return snapshot.bounded_count(t.table("lineitem"), 5000)


@BOOK.query("max_key", "SELECT conv_id, turn FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1")
def max_key(t: Inputs):
    return snapshot.extreme_key(t.table("conversations"), ["conv_id", "turn"], True)


@BOOK.query("min_key", "SELECT conv_id, turn FROM conversations ORDER BY conv_id, turn LIMIT 1")
def min_key(t: Inputs):
    return snapshot.extreme_key(t.table("conversations"), ["conv_id", "turn"], False)


@BOOK.query("column_has_non_null", "SELECT count(*) > 0 AS has_value FROM live_user WHERE props IS NOT NULL")
def column_has_non_null(t: Inputs):
    return snapshot.has_non_null(t.live_user, "props")


# ------------------------------------------------------------------ catalog

_COLUMNS = "schema_name, table_name, capture_instance, start_lsn, column_ordinal, column_name, column_type, is_computed, pk_ordinal, num_precision, num_scale, is_nullable"


@BOOK.query("tracked_table_metadata", f"SELECT {_COLUMNS} FROM change_tables c JOIN captured_columns k ON c.object_id = k.object_id WHERE capture_instance IN ('app_user_state_v1', 'app_user_state_v2')")
def tracked_table_metadata(t: Inputs):
    return catalog.column_metadata(t.change_tables, t.captured_columns, ["app_user_state_v1", "app_user_state_v2"])


@BOOK.query(
    "capture_instance_checksum",
    """WITH c AS (SELECT capture_instance, string_agg(concat_ws(':', column_ordinal, column_name, column_type, is_computed), ',' ORDER BY column_ordinal) AS cols, count(*) AS n FROM change_tables t JOIN captured_columns k ON t.object_id = k.object_id GROUP BY 1)
SELECT a.capture_instance AS a, b.capture_instance AS b, a.cols = b.cols AS same, a.n AS a_columns, b.n AS b_columns FROM c a JOIN c b ON a.capture_instance < b.capture_instance""",
)
def capture_instance_checksum(t: Inputs):
    sums = catalog.type_checksums(t.change_tables, t.captured_columns)
    a, b = sums.select(F.col("capture_instance").alias("a"), F.col("checksum").alias("x"), F.col("columns").alias("a_columns")), sums.select(F.col("capture_instance").alias("b"), F.col("checksum").alias("y"), F.col("columns").alias("b_columns"))
    return a.join(F.broadcast(b), F.col("a") < F.col("b")).select("a", "b", (F.col("x") == F.col("y")).alias("same"), "a_columns", "b_columns")  # a catalog's instances are few


@BOOK.query("indexed_cols", "SELECT DISTINCT schema_name, table_name, column_name FROM index_columns WHERE key_ordinal = 1 AND is_disabled = 0 AND has_filter = 0 AND index_type <> 0")
def indexed_cols(t: Inputs):
    return catalog.leading_index_columns(t.index_columns)


@BOOK.query("ddl_history_age", "SELECT object_id, ddl_command, age_seconds, age_seconds <= 3600 AS recent FROM ddl_history")
def ddl_history_age(t: Inputs):
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    logged = t.ddl_history.withColumn("ddl_time", F.timestamp_add("SECOND", -F.col("age_seconds"), now))
    age = F.timestamp_diff("SECOND", F.col("ddl_time"), now).cast("int")
    return logged.select("object_id", "ddl_command", age.alias("age_seconds"), (age <= 3600).alias("recent"))


_LATEST = "SELECT schema_name, table_name, capture_instance, start_lsn, object_id FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, table_name ORDER BY create_date DESC, object_id DESC) AS r FROM change_tables WHERE start_lsn IS NOT NULL AND create_date IS NOT NULL) x WHERE r = 1"


@BOOK.query("latest_capture_instance", _LATEST)
def latest_capture_instance(t: Inputs):
    return catalog.latest_instances(t.change_tables)


@BOOK.query("latest_capture_instance_regex", "SELECT schema_name, table_name, capture_instance, start_lsn, object_id FROM (SELECT *, row_number() OVER (PARTITION BY schema_name, table_name ORDER BY regexp_extract(capture_instance, '_v(\\d+)$', 1) DESC, object_id DESC) AS r FROM change_tables WHERE start_lsn IS NOT NULL AND create_date IS NOT NULL) x WHERE r = 1")
def latest_capture_instance_regex(t: Inputs):
    return catalog.latest_instances(t.change_tables, "regex", r"_v(\d+)$")


@BOOK.query("table_filter", "SELECT schema_name, table_name, capture_instance FROM change_tables WHERE schema_name || '.' || table_name LIKE 'app.%' AND schema_name || '.' || table_name NOT LIKE 'app.brand%'")
def table_filter(t: Inputs):
    return catalog.included(t.change_tables, r"APP\.", r"app\.brand").select("schema_name", "table_name", "capture_instance")


@BOOK.query("snapshot_table_filter", "SELECT capture_instance, schema_name || '.' || table_name LIKE 'app.user%' AS snapshot_allowed, false AS without_pattern FROM change_tables")
def snapshot_table_filter(t: Inputs):
    allowed = catalog.snapshot_allowed(t.change_tables, r"app\.(user|customer)", r"app\.cust")
    return catalog.snapshot_allowed(allowed.select("capture_instance", "schema_name", "table_name", F.col("snapshot_allowed").alias("a")), None, None).select("capture_instance", F.col("a").alias("snapshot_allowed"), F.col("snapshot_allowed").alias("without_pattern"))


@BOOK.query("topic_names", "SELECT capture_instance, schema_name || '_' || table_name || '_cdc' AS topic FROM change_tables")
def topic_names(t: Inputs):
    return t.change_tables.select("capture_instance", X.topic_name("{schema_name}_{table_name}_cdc", F.col("schema_name"), F.col("table_name")).alias("topic"))


@BOOK.query(
    "capture_instance_change",
    """SELECT 'app' AS schema_name, 'user_state' AS table_name, 'app_user_state_v1' AS old_instance, 'app_user_state_v2' AS new_instance,
CASE WHEN (SELECT coalesce(max(lsn), '') FROM progress_log WHERE change_table_name = 'cdc.app_user_state_v1_CT') < '0x000000000000000003e8' AND (SELECT count(*) FROM ct_user) > 0 THEN 'defer' ELSE 'terminate' END AS decision""",
)
def capture_instance_change(t: Inputs):
    sums = catalog.type_checksums(t.change_tables, t.captured_columns).select("capture_instance", "checksum")
    current = t.change_tables.where("object_id IN (11, 13)").join(sums, "capture_instance")
    new = catalog.latest_instances(t.change_tables).join(sums, "capture_instance")
    seen = t.progress_log.where("change_table_name = 'cdc.app_user_state_v1_CT'").agg(F.max("lsn").alias("lsn")).select(F.lit("app").alias("schema_name"), F.lit("user_state").alias("table_name"), "lsn")
    rows = t.ct_user.select(F.lit(1).alias("one")).limit(1).agg((F.count("*") > 0).alias("has_rows")).select(F.lit("app").alias("schema_name"), F.lit("user_state").alias("table_name"), "has_rows")
    return catalog.instance_changes(current, new, seen, rows)


@BOOK.query(
    "index_contract",
    "SELECT table_name, columns, columns = '__$start_lsn,__$command_id,__$seqval,__$operation' AS in_order FROM (SELECT table_name, string_agg(column_name, ',' ORDER BY key_ordinal) AS columns FROM ct_index_columns WHERE index_type = 1 GROUP BY 1) x",
)
def index_contract(t: Inputs):
    return catalog.unordered_indexes(t.ct_index_columns)
