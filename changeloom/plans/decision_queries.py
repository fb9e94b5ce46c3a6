"""Queries over start-up scenarios."""

from __future__ import annotations

from pyspark.sql import functions as F

from changeloom.operators import decisions, snapshot
from changeloom.plans.book import Book, Inputs

BOOK = Book()
_MAX = "0x00000000000000000fff"
_ZERO = "0x00000000000000000000"


@BOOK.query(
    "start_points",
    f"SELECT topic, CASE WHEN k THEN lsn WHEN start_point = 'latest' THEN '{_MAX}' ELSE '{_ZERO}' END AS lsn, CASE WHEN k THEN coalesce(command_id, 1) ELSE 1 END AS command_id, CASE WHEN k THEN seqval ELSE '{_ZERO}' END AS seqval, CASE WHEN k THEN operation ELSE 0 END AS operation FROM (SELECT *, lsn IS NOT NULL AND NOT coalesce(progress_table <> change_table AND overlap = 'republish', false) AS k FROM start_cases) x",
)
def start_points(t: Inputs):
    return decisions.start_points(t.start_cases, _MAX)


@BOOK.query("lsn_gap_decision", "SELECT * FROM (VALUES (1,'no gap'),(2,'no gap'),(3,'proceed at min_lsn'),(4,'raise'),(5,'ignore'),(6,'begin new snapshot'),(7,'raise'),(8,'no gap')) v(case_id, decision)")
def lsn_gap_decision(t: Inputs):
    return decisions.gap_decision(t.gap_cases)


@BOOK.query("snapshot_decision", "SELECT * FROM (VALUES ('t1','continue'),('t2','start again'),('t3','mark complete'),('t4','mark complete'),('t5','start')) v(topic, decision)")
def snapshot_decision(t: Inputs):
    return decisions.snapshot_decision(t.instance_cases)


@BOOK.query("snapshot_state", "SELECT * FROM (VALUES (1,'complete'),(2,'raise'),(3,'complete'),(4,'complete'),(5,'resume'),(6,'full'),(7,'complete')) v(case_id, state)")
def snapshot_state(t: Inputs):
    return decisions.snapshot_state(t.state_cases)


def _columns(t: Inputs, object_id: int):
    return t.captured_columns.where(F.col("object_id") == object_id)


@BOOK.query(
    "schema_diff",
    "SELECT coalesce(a.column_name, b.column_name) AS column_name, CASE WHEN a.column_name IS NULL THEN 'added' WHEN b.column_name IS NULL THEN 'removed' WHEN a.column_type = b.column_type AND a.num_precision IS NOT DISTINCT FROM b.num_precision AND a.num_scale IS NOT DISTINCT FROM b.num_scale AND a.is_nullable = b.is_nullable THEN 'same' ELSE 'changed' END AS change FROM (SELECT * FROM captured_columns WHERE object_id = 11) a FULL OUTER JOIN (SELECT * FROM captured_columns WHERE object_id = 12) b ON a.column_name = b.column_name",
)
def schema_diff(t: Inputs):
    return decisions.schema_diff(_columns(t, 11), _columns(t, 12)).select("column_name", "change")


@BOOK.query("recently_added_cols", "SELECT 'props' AS column_name")
def recently_added_cols(t: Inputs):
    return decisions.recently_added(t.ddl_history)


@BOOK.query("resnapshot_decision", "SELECT * FROM (VALUES ('v1 to v2', true, 'type changed'), ('v2 to v1', true, 'column removed'), ('v1 to v1', false, 'none'), ('gone', true, 'old instance gone'), ('only added, empty', false, 'none'), ('only added, values', true, 'added column has values'), ('only added, large and recent', false, 'none'), ('only added, large and old', true, 'added column not recent')) v(scenario, needed, reason)")
def resnapshot_decision(t: Inputs):
    v1, v2, recent = _columns(t, 11), _columns(t, 12), decisions.recently_added(t.ddl_history)
    wider = v1.unionByName(v2.where("column_name = 'props'"))
    none = recent.where("false")
    small, large = 1000, decisions.SMALL_TABLE_ROWS
    cases = [
        ("v1 to v2", v1, v2, True, small, [], recent), ("v2 to v1", v2, v1, True, small, [], recent), ("v1 to v1", v1, v1, True, small, [], recent), ("gone", v1, v1, False, small, [], recent), ("only added, empty", v1, wider, True, small, [], none),
        ("only added, values", v1, wider, True, small, ["props"], none), ("only added, large and recent", v1, wider, True, large, [], recent), ("only added, large and old", v1, wider, True, large, ["props"], none),
    ]
    out = None
    for name, old, new, exists, rows, values, lately in cases:
        one = decisions.resnapshot(decisions.schema_diff(old, new), exists, rows, [], values, lately).select(F.lit(name).alias("scenario"), "needed", "reason")
        out = one if out is None else out.unionByName(one)
    return out


@BOOK.query("table_is_small", "SELECT count(*) < 5000 AS small FROM (SELECT 1 FROM orders LIMIT 5000) x")
def table_is_small(t: Inputs):
    return snapshot.bounded_count(t.table("orders"), 5000).select((F.col("n") < 5000).alias("small"))
