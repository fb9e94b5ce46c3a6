"""Derived inputs: change tables, topics, logs and catalogs made from the base tables by SQL.

The text runs unchanged in Spark and DuckDB, so a query over these views and the SQL beside it see the same rows. Views
may use those above them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

VIEWS: dict[str, str] = {
    "ct_user": """
WITH r AS (SELECT event_id, ts, user_id, event_type, value, props,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS p_event_type,
    lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p_value,
    lag(props) OVER (PARTITION BY user_id ORDER BY event_id) AS p_props FROM events),
o AS (SELECT r.*, CASE WHEN (rn-1)%5=0 THEN 2 WHEN rn%5=0 THEN 1 ELSE 4 END AS op,
    '0x' || lower(lpad(hex(CAST(floor(event_id/4) AS BIGINT)+1),20,'0')) AS lsn,
    CAST(event_id%4+1 AS INT) AS command_id,
    '0x' || lower(lpad(hex(event_id+1),20,'0')) AS seqval FROM r)
SELECT lsn, command_id, seqval, op AS operation,
  CASE WHEN op=4 THEN CAST((CASE WHEN event_type IS DISTINCT FROM p_event_type THEN 2 ELSE 0 END)
     +(CASE WHEN value IS DISTINCT FROM p_value THEN 4 ELSE 0 END)
     +(CASE WHEN props IS DISTINCT FROM p_props THEN 8 ELSE 0 END) AS INT) ELSE 15 END AS update_mask,
  user_id, event_type, value, props FROM o
UNION ALL
SELECT lsn, command_id, seqval, 3, 0, user_id, p_event_type, p_value, p_props FROM o WHERE op=4
""",
    "ct_order": """
WITH r AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)
SELECT '0x' || lower(lpad(hex(CAST(floor(o_orderkey/6) AS BIGINT)+1),20,'0')) AS lsn,
  CAST(o_orderkey%6+5 AS INT) AS command_id, '0x' || lower(lpad(hex(o_orderkey+1),20,'0')) AS seqval,
  CASE WHEN (rn-1)%5=0 THEN 2 WHEN rn%5=0 THEN 1 ELSE 4 END AS operation, 15 AS update_mask,
  o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM r
""",
    "ltm": """
SELECT '0x' || lower(lpad(hex(CAST(floor(event_id/4) AS BIGINT)+1),20,'0')) AS start_lsn, max(ts) AS tran_end_time
FROM events GROUP BY 1
""",
    "live_user": """
SELECT user_id, event_type, value, props FROM (SELECT ct_user.*, row_number() OVER (PARTITION BY user_id
   ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC) AS rd FROM ct_user WHERE operation IN (1,2,4)) x
WHERE rd=1 AND operation<>1
""",
    "topic_user": """
WITH m AS (SELECT lsn, command_id, seqval, operation, user_id, event_type, value, props, 0 AS sub
           FROM ct_user WHERE operation IN (1,2,4)
 UNION ALL SELECT lsn, command_id, seqval, NULL, user_id, NULL, NULL, NULL, 1 FROM ct_user WHERE operation=1)
SELECT 'app_user_state_cdc' AS topic, CAST(user_id%3 AS INT) AS partition_id,
  row_number() OVER (PARTITION BY user_id%3 ORDER BY lsn, command_id, seqval, sub)-1 AS msg_offset,
  user_id, operation, CASE WHEN sub=0 THEN lsn END AS lsn, CASE WHEN sub=0 THEN command_id END AS command_id,
  CASE WHEN sub=0 THEN seqval END AS seqval, event_type, value, props FROM m
""",
    "topic_user_bad": """
SELECT topic, partition_id, CASE WHEN msg_offset%50=10 THEN msg_offset+1 WHEN msg_offset%50=11 THEN msg_offset-1 ELSE msg_offset END AS msg_offset,
  user_id, operation, lsn, command_id, seqval, event_type, value, props
FROM topic_user WHERE msg_offset%97<>13 AND NOT (operation IS NULL AND user_id%7=0)
""",
    "progress_log": """
WITH b AS (SELECT CAST(floor(event_id/400) AS BIGINT) AS bkt, max(event_id) AS e FROM events GROUP BY 1),
d AS (SELECT bkt, CASE WHEN bkt=7 THEN e-400 WHEN bkt=11 THEN e-1200 ELSE e END AS e FROM b)
SELECT bkt AS msg_offset, 'app_user_state_cdc' AS topic_name, 'change_rows' AS progress_kind,
  CASE WHEN bkt<13 THEN 'cdc.app_user_state_v1_CT' ELSE 'cdc.app_user_state_v2_CT' END AS change_table_name,
  CASE WHEN bkt%9<>8 THEN '0x' || lower(lpad(hex(CAST(floor(e/4) AS BIGINT)+1),20,'0')) END AS lsn,
  CASE WHEN bkt%9=8 THEN NULL WHEN bkt%5=4 THEN 2147483647 ELSE CAST(e%4+1 AS INT) END AS command_id,
  CASE WHEN bkt%9=8 THEN NULL WHEN bkt%5=4 THEN '0xffffffffffffffffffff' ELSE '0x' || lower(lpad(hex(e+1),20,'0')) END AS seqval,
  CASE WHEN bkt%9=8 THEN NULL ELSE 4 END AS operation FROM d
""",
    "snapshot_log": """
SELECT * FROM (VALUES (0,'t1','started',0,100),(0,'t1','started',1,120),(1,'t1','completed',0,180),(1,'t1','completed',1,200),
 (2,'t2','started',0,500),(3,'t2','resumed',0,510),(4,'t2','completed',0,900),(5,'t3','completed',0,40),(6,'t3','started',0,70))
 AS t(msg_offset, topic_name, action, partition_id, high_watermark)
""",
    "topic_low_watermarks": """
SELECT * FROM (VALUES ('t1',0,100),('t1',1,130),('t2',0,0),('t3',0,0)) AS t(topic_name, partition_id, low_watermark)
""",
    "change_tables": """
SELECT * FROM (VALUES (11,'app','user_state','app_user_state_v1','0x00000000000000000001',TIMESTAMP '2024-01-01 00:00:00'),
 (12,'app','user_state','app_user_state_v2','0x000000000000000003e8',TIMESTAMP '2024-01-15 00:00:00'),
 (13,'app','customer_order','app_customer_order_v1','0x00000000000000000001',TIMESTAMP '2024-01-01 00:00:00'),
 (14,'app','brand_new','app_brand_new_v1',NULL,NULL)) AS t(object_id, schema_name, table_name, capture_instance, start_lsn, create_date)
""",
    "captured_columns": """
SELECT * FROM (VALUES (11,'user_id',1,'bigint',1,0,1,19,0,0),(11,'event_type',2,'varchar',2,0,NULL,0,0,1),(11,'value',3,'real',3,0,NULL,24,0,1),
 (12,'user_id',1,'bigint',1,0,1,19,0,0),(12,'event_type',2,'varchar',2,0,NULL,0,0,1),(12,'value',3,'float',3,0,NULL,53,0,1),(12,'props',4,'nvarchar',4,0,NULL,0,0,1),
 (13,'o_custkey',1,'bigint',1,0,1,19,0,0),(13,'o_orderkey',2,'bigint',2,0,NULL,19,0,1),(13,'o_orderstatus',3,'char',3,0,NULL,0,0,1),(13,'o_totalprice',4,'decimal',4,0,NULL,18,2,1))
 AS t(object_id, column_name, column_id, column_type, column_ordinal, is_computed, pk_ordinal, num_precision, num_scale, is_nullable)
""",
    "ddl_history": """
SELECT * FROM (VALUES (11,'ALTER TABLE app.user_state ADD props nvarchar(max) NULL',120),(11,'alter table [app].[user_state] add [old_col] int NULL',90000),
 (12,'ALTER TABLE app.user_state ADD CONSTRAINT pk_x PRIMARY KEY (user_id, value)',50),(12,'ALTER TABLE app.user_state ALTER COLUMN props nvarchar(20)',70),
 (11,'ALTER TABLE [app].[user_state] WITH NOCHECK ADD a int NULL, [b c] decimal(10, 2) NOT NULL DEFAULT (0), "D" varchar(5) DEFAULT ''x, y'', CONSTRAINT e UNIQUE (a, [b c])',100000))
 AS t(object_id, ddl_command, age_seconds)
""",
    "topic_full": """
WITH m AS (SELECT 0 AS phase, -user_id AS ord, NULL AS lsn, NULL AS command_id, NULL AS seqval, 0 AS operation, user_id, event_type, value, props, 0 AS sub FROM live_user
 UNION ALL SELECT 1, 0, lsn, command_id, seqval, operation, user_id, event_type, value, props, 0 FROM ct_user WHERE operation IN (1,2,4)
 UNION ALL SELECT 1, 0, lsn, command_id, seqval, NULL, user_id, NULL, NULL, NULL, 1 FROM ct_user WHERE operation=1)
SELECT 'app_user_state_cdc' AS topic, CAST(user_id%3 AS INT) AS partition_id,
  row_number() OVER (PARTITION BY user_id%3 ORDER BY phase, ord, lsn, command_id, seqval, sub)-1 AS msg_offset,
  user_id, operation, CASE WHEN sub=0 THEN lsn END AS lsn, CASE WHEN sub=0 THEN command_id END AS command_id,
  CASE WHEN sub=0 THEN seqval END AS seqval, event_type, value, props FROM m
""",
    "topic_unified": """
WITH m AS (SELECT 'app_user_state_cdc' AS original_topic, lsn, command_id, seqval, operation FROM ct_user WHERE operation IN (1,2,4)
 UNION ALL SELECT 'app_customer_order_cdc', lsn, command_id, seqval, operation FROM ct_order WHERE operation IN (1,2,4)),
n AS (SELECT m.*, row_number() OVER (ORDER BY lsn, command_id, seqval, operation)-1 AS o FROM m)
SELECT 'app_all_changes' AS topic, 0 AS partition_id, CASE WHEN o%400=20 THEN o+1 WHEN o%400=21 THEN o-1 ELSE o END AS msg_offset,
  CASE WHEN o%1000=7 THEN 'app_surprise_cdc' ELSE original_topic END AS original_topic, lsn, command_id, seqval, CASE WHEN o%5000=9 THEN NULL ELSE operation END AS operation FROM n
""",
    "snapshot_progress": """
SELECT * FROM (VALUES (0,'t1','cdc.a_v1_CT',900),(1,'t1','cdc.a_v1_CT',500),(2,'t1','cdc.a_v1_CT',NULL),(3,'t1','cdc.a_v2_CT',950),(4,'t1','cdc.a_v2_CT',400),(5,'t1','cdc.a_v2_CT',700),(6,'t1','cdc.a_v2_CT',NULL),
 (7,'t2','cdc.b_v1_CT',300),(8,'t2','cdc.b_v1_CT',300),(9,'t2','cdc.b_v1_CT',NULL),(10,'t2','cdc.b_v1_CT',800)) AS t(msg_offset, topic_name, change_table_name, last_key)
""",
    "index_columns": """
SELECT * FROM (VALUES (1,1,'app','user_state','user_id',1,0,0,1),(1,2,'app','user_state','event_type',1,0,0,2),(1,2,'app','user_state','value',2,0,0,2),(1,3,'app','user_state','props',1,1,0,2),(1,4,'app','user_state','value',1,0,1,2),(2,1,'app','customer_order','o_custkey',1,0,0,1),(1,5,'app','user_state','user_id',1,0,0,2)) AS t(object_id, index_id, schema_name, table_name, column_name, key_ordinal, is_disabled, has_filter, index_type)
""",
    "progress_kinds": """
SELECT msg_offset, topic_name, progress_kind, lsn, command_id, seqval, operation, change_table_name FROM progress_log
 UNION ALL SELECT msg_offset+1000000, 'app_user_state_cdc', 'snapshot_rows', NULL, NULL, NULL, NULL, change_table_name FROM progress_log WHERE msg_offset%4=1
""",
}

VIEWS |= {
    # One topic for each rule of validation, by what is done to a sound one; offsets are spread so that rows can be moved.
    "topic_faults": """
WITH k AS (SELECT * FROM (VALUES ('sound'),('unknown'),('snapshot_order'),('snapshot_repeats'),('no_progress'),('heartbeat_behind'),('progress_differs'),('index_order'),('tombstones'),('deletes'),('inserts'),('updates'),('no_snapshot'),('source_rows'),('snapshot_only')) AS t(fault))
SELECT fault AS topic, partition_id, CASE WHEN fault IN ('snapshot_order','snapshot_only') AND operation=0 THEN -msg_offset*10 WHEN fault='index_order' AND operation=4 AND msg_offset%50=10 THEN msg_offset*10+305 ELSE msg_offset*10 END AS msg_offset,
  user_id, CASE WHEN fault='unknown' AND operation=4 AND msg_offset%101=5 THEN 9 ELSE operation END AS operation, lsn, command_id, seqval, event_type, value, props
FROM topic_full CROSS JOIN k WHERE NOT (fault='snapshot_only' AND (operation IS NULL OR operation<>0)) AND NOT (fault='tombstones' AND operation IS NULL AND user_id%3=0) AND NOT (fault='deletes' AND (operation IS NULL OR operation=1) AND user_id%5=0) AND NOT (fault='inserts' AND operation=2 AND user_id%5=1)
  AND NOT (fault='updates' AND operation=4 AND msg_offset%97=13) AND NOT (fault='no_snapshot' AND operation=0) AND NOT (fault='source_rows' AND user_id%7=3)
UNION ALL SELECT 'snapshot_repeats', partition_id, msg_offset*10+5, user_id, operation, lsn, command_id, seqval, event_type, value, props FROM topic_full WHERE operation=0 AND user_id%4=0
""",
    "fault_progress": """
SELECT topic, CASE WHEN topic IN ('heartbeat_behind','progress_differs') THEN '0x00000000000000000002' ELSE lsn END AS lsn, CASE WHEN topic='heartbeat_behind' THEN 2147483647 ELSE command_id END AS command_id,
  CASE WHEN topic='heartbeat_behind' THEN '0xffffffffffffffffffff' ELSE seqval END AS seqval, CASE WHEN topic='heartbeat_behind' THEN 4 ELSE operation END AS operation
FROM (SELECT DISTINCT topic FROM topic_faults) t CROSS JOIN (SELECT lsn, command_id, seqval, operation FROM ct_user WHERE operation IN (1,2,4) ORDER BY lsn DESC, command_id DESC, seqval DESC, operation DESC LIMIT 1) l WHERE topic<>'no_progress'
""",
    "unified_faults": """
WITH m AS (SELECT 'app_user_state_cdc' AS original_topic, lsn, command_id, seqval, operation FROM ct_user WHERE operation IN (1,2,4)
 UNION ALL SELECT 'app_customer_order_cdc', lsn, command_id, seqval, operation FROM ct_order WHERE operation IN (1,2,4)),
n AS (SELECT m.*, row_number() OVER (ORDER BY lsn, command_id, seqval, operation)-1 AS o FROM m),
k AS (SELECT * FROM (VALUES ('sound'),('order'),('tombstones'),('unexpected'),('snapshots')) AS t(fault))
SELECT fault AS topic, 0 AS partition_id, CASE WHEN fault='order' AND o%400=20 THEN o*10+405 ELSE o*10 END AS msg_offset, CASE WHEN fault='unexpected' AND o%1000=7 THEN 'app_surprise_cdc' ELSE original_topic END AS original_topic,
  lsn, command_id, seqval, CASE WHEN fault='tombstones' AND o%5000=9 THEN NULL WHEN fault='snapshots' AND o%700=3 THEN 0 ELSE operation END AS operation FROM n CROSS JOIN k
""",
    "ct_index_columns": """
SELECT * FROM (VALUES ('app_a_CT','__$start_lsn',1,1),('app_a_CT','__$command_id',2,1),('app_a_CT','__$seqval',3,1),('app_a_CT','__$operation',4,1),('app_b_CT','__$seqval',2,1),('app_b_CT','__$start_lsn',1,1),('app_b_CT','__$operation',3,1),
 ('app_c_CT','__$operation',4,1),('app_c_CT','__$seqval',3,1),('app_c_CT','__$command_id',2,1),('app_c_CT','__$start_lsn',1,1),('app_c_CT','x',1,2)) AS t(table_name, column_name, key_ordinal, index_type)
""",
    "gap_cases": """
SELECT * FROM (VALUES (1,'0x00000000000000000000','0x00000000000000000100',NULL,'raise_exception',true),(2,'0x00000000000000000100','0x00000000000000000100',NULL,'raise_exception',true),
 (3,'0x00000000000000000050','0x00000000000000000100','0x00000000000000000050','raise_exception',false),(4,'0x00000000000000000050','0x00000000000000000100','0x00000000000000000060','raise_exception',true),
 (5,'0x00000000000000000050','0x00000000000000000100',NULL,'ignore',true),(6,'0x00000000000000000050','0x00000000000000000100',NULL,'begin_new_snapshot',true),
 (7,'0x00000000000000000050','0x00000000000000000100',NULL,'begin_new_snapshot',false),(8,'0x00000000000000000200','0x00000000000000000100',NULL,'raise_exception',true)) AS t(case_id, start_lsn, min_lsn, prior_max_lsn, handling, snapshot_allowed)
""",
    "state_cases": """
SELECT * FROM (VALUES (1,false,true,NULL,false,5),(2,true,false,NULL,false,5),(3,true,true,NULL,true,5),(4,true,true,5,false,5),(5,true,true,40,false,5),(6,true,true,NULL,false,5),(7,true,true,NULL,false,NULL))
 AS t(case_id, snapshot_allowed, has_key, resume_key, sentinel, min_key)
""",
    "start_cases": """
SELECT * FROM (VALUES ('t1','cdc.a_v1_CT','cdc.a_v1_CT','0x00000000000000000010',3,'0x00000000000000000011',2,'latest','skip'),('t2',NULL,'cdc.b_v1_CT',NULL,NULL,NULL,NULL,'latest','skip'),('t3',NULL,'cdc.c_v1_CT',NULL,NULL,NULL,NULL,'earliest','skip'),
 ('t4','cdc.d_v1_CT','cdc.d_v2_CT','0x00000000000000000020',1,'0x00000000000000000021',4,'latest','skip'),('t5','cdc.e_v1_CT','cdc.e_v2_CT','0x00000000000000000020',1,'0x00000000000000000021',4,'earliest','republish'))
 AS t(topic, progress_table, change_table, lsn, command_id, seqval, operation, start_point, overlap)
""",
    "instance_cases": """
SELECT * FROM (VALUES ('t1','cdc.a_v1_CT','cdc.a_v1_CT','begin_new',true),('t2','cdc.a_v1_CT','cdc.a_v2_CT','begin_new',true),('t3','cdc.a_v1_CT','cdc.a_v2_CT','begin_new',false),('t4','cdc.a_v1_CT','cdc.a_v2_CT','ignore',true),('t5',NULL,'cdc.a_v2_CT','begin_new',false))
 AS t(topic, progress_table, change_table, handling, needs_snapshot)
""",
}

_WORD = re.compile(r"[A-Za-z_][A-Za-z_0-9]*")


def needed(sql: str) -> list[str]:
    """The views that a statement uses, themselves or through others, in the order of definition."""
    used = set(_WORD.findall(sql))
    for name in reversed(VIEWS):
        if name in used:
            used |= set(_WORD.findall(VIEWS[name]))
    return [name for name in VIEWS if name in used]


def self_contained(sql: str) -> str:
    """The statement with the views it needs in front, for an engine that has the base tables."""
    views = [f"{name} AS ({VIEWS[name].strip()})" for name in needed(sql)]
    if not views:
        return sql
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(views) + ",\n" + body[5:]
    return "WITH " + ",\n".join(views) + "\n" + body


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame over the tables of sf_dir."""
    statement = f"SELECT * FROM {name}"
    views = needed(statement)
    words = {w for v in views for w in _WORD.findall(VIEWS[v])}
    tables = [f"{t} AS (SELECT * FROM parquet.`{sf_dir}/{t}.parquet`)" for t in BASE_TABLES if t in words]
    return spark.sql("WITH " + ",\n".join([*tables, *(f"{v} AS ({VIEWS[v].strip()})" for v in views)]) + f"\n{statement}")
