"""Interval metrics over produced messages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.model import DELETE, INSERT, POST_UPDATE, SNAPSHOT

#: Produced messages have: operation (null for a tombstone), lsn, event_time, produced_at, unified (boolean).
KINDS = ((DELETE, "produced_delete_changes_count"), (INSERT, "produced_insert_changes_count"), (POST_UPDATE, "produced_update_changes_count"), (SNAPSHOT, "produced_snapshot_records_count"))


def _aggregates() -> list:
    own = ~F.col("unified")
    change = own & F.col("operation").isin(DELETE, INSERT, POST_UPDATE)
    # Whole microseconds are averaged, so that the mean doesn't depend on the order of addition.
    micros = F.when(change, F.unix_micros(F.col("produced_at").cast("timestamp")) - F.unix_micros(F.col("event_time").cast("timestamp")))
    counts = [F.count_if(own & (F.col("operation") == op)).alias(n) for op, n in KINDS]
    return [
        F.count("*").alias("produces_count"), *counts, F.count_if(own & F.col("operation").isNull()).alias("produced_deletion_tombstones_count"), F.count_if("unified").alias("messages_copied_to_unified_topics"),
        F.min(F.when(change, F.col("event_time"))).alias("earliest_change_db_tran_end_time_produced"), F.max(F.when(change, F.col("event_time"))).alias("latest_change_db_tran_end_time_produced"),
        F.count_if(change).alias("db_change_data_rows_retrieved_count"), F.count_if(own & (F.col("operation") == SNAPSHOT)).alias("db_snapshot_rows_retrieved_count"), F.count_if(own & F.col("operation").isNotNull()).alias("db_all_data_rows_retrieved_count"),
        F.min(F.when(change, F.col("lsn"))).alias("earliest_change_lsn_produced"), F.max(F.when(change, F.col("lsn"))).alias("latest_change_lsn_produced"),
        F.round(F.avg(micros) / 1e6, 3).alias("e2e_latency_avg_sec"), F.round(F.min(micros) / 1e6, 3).alias("e2e_latency_min_sec"), F.round(F.max(micros) / 1e6, 3).alias("e2e_latency_max_sec"),
    ]


def interval(messages: DataFrame) -> DataFrame:
    return messages.agg(*_aggregates())


def tumbling(messages: DataFrame, length: str) -> DataFrame:
    """The same for each window of the commit time."""
    out = messages.where("event_time IS NOT NULL").groupBy(F.window("event_time", length).alias("w")).agg(*_aggregates())
    return out.select(F.col("w.start").alias("window_start"), *[c for c in out.columns if c != "w"])


def lag_seconds(ltm: DataFrame, now) -> DataFrame:
    """Seconds from the latest commit that the log map knows to `now`."""
    return ltm.agg(F.max("tran_end_time").alias("t")).select(F.timestamp_diff("SECOND", F.col("t"), F.lit(now)).alias("lag_sec"))
