"""From change rows to messages: envelopes, tombstones, combined topics, partitions and offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import DELETE, DELETION_TOMBSTONE, POST_UPDATE, SNAPSHOT, TABLE_CHANGE, TABLE_SNAPSHOT, UNIFIED_CHANGE, TableSpec
from changeloom.sources.work import numbered


def envelope(rows: DataFrame, table: TableSpec, mask: Column | None = None) -> DataFrame:
    """Change or snapshot rows (index columns, event_time, captured columns) as envelope rows.

    Inserts, deletes and snapshots list all columns as updated; an update lists those in its mask. Texts longer than
    their field's limit are cut, which a header records. A table without a key gets an identifier made of its content.
    """
    names = table.value_names
    everything = F.array(*[F.lit(n) for n in names])
    changed = everything if mask is None else F.when(F.col("operation") == POST_UPDATE, X.updated_fields(mask, names)).otherwise(everything)
    cut = {f.name: f.truncate_after for f in table.fields if f.truncate_after is not None}
    values = [(X.truncate_utf8(F.col(n), cut[n]) if n in cut else F.col(n)).alias(n) for n in names]
    key = X.key_struct(table.key_names) if table.has_key else F.struct(X.row_hash_uuid(names, table.table_name).alias("_row_hash"))
    notes = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(f"truncated_{n}").alias("key"), X.truncation_header(F.col(n), size).alias("value")) for n, size in cut.items()]), lambda e: e["value"].isNotNull())) if cut else F.create_map().cast("map<string,string>")
    return rows.select(
        F.lit(table.topic).alias("topic"),
        F.when(F.col("operation") == SNAPSHOT, TABLE_SNAPSHOT).otherwise(TABLE_CHANGE).alias("message_type"),
        F.col("operation"), F.col("event_time"), X.index().alias("idx"), changed.alias("updated_fields"), key.alias("key"), F.struct(*values).alias("value"), notes.alias("headers"),
    )


def with_tombstones(messages: DataFrame) -> DataFrame:
    """After each delete a tombstone of the same key; `sub` orders the two. One row makes both, without a shuffle."""
    subs = F.when(F.col("operation") == DELETE, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = messages.withColumn("sub", F.explode(subs))
    kept = {c: F.when(F.col("sub") == 0, F.col(c)) for c in ("operation", "value", "updated_fields", "event_time") if c in messages.columns}
    kept["message_type"] = F.when(F.col("sub") == 1, DELETION_TOMBSTONE).otherwise(F.col("message_type")) if "message_type" in messages.columns else F.when(F.col("sub") == 1, DELETION_TOMBSTONE).otherwise(TABLE_CHANGE)
    return out.withColumns(kept)


def routes(tables: DataFrame, unified: dict[str, str]) -> DataFrame:
    """(topic, unified_topic) by patterns over `schema.table`. The patterns come from the settings, so no join is needed."""
    name = F.concat_ws(".", "schema_name", "table_name")
    targets = F.array_compact(F.array(*[F.when(X.matches_start(name, pattern), F.lit(topic)) for topic, pattern in unified.items()]))
    return tables.select("topic", F.explode(targets).alias("unified_topic"))


def unified_copies(messages: DataFrame, topic_routes: DataFrame) -> DataFrame:
    """Copies of changes, not of snapshots or tombstones, for combined topics; a header keeps where they came from."""
    changes = messages.where(F.col("operation").isNotNull() & (F.col("operation") != SNAPSHOT))
    copies = changes.join(topic_routes, "topic")
    return copies.select(F.col("unified_topic").alias("topic"), F.lit(UNIFIED_CHANGE).alias("message_type"), F.col("topic").alias("original_topic"), *[c for c in changes.columns if c not in ("topic", "message_type", "original_topic")])


def placed(messages: DataFrame, key: Column, partitions: int, order: list[Column]) -> DataFrame:
    """Messages with the partition their key hashes to and their offset in it. All messages of a key keep their order.

    Places come from one range-partitioned sort over all topics and partitions, so none is one task's.
    """
    dealt = messages.withColumn("partition_id", F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int"))
    ranked = numbered(dealt, [F.col("topic"), F.col("partition_id"), *order], "_pos")
    firsts = ranked.groupBy("topic", "partition_id").agg(F.min("_pos").alias("_first"))  # one row for each partition
    return ranked.join(F.broadcast(firsts), ["topic", "partition_id"]).withColumn("msg_offset", (F.col("_pos") - F.col("_first")).cast("long")).drop("_pos", "_first")


def partition_count(rows_per_second: Column) -> Column:
    """One partition for each ten rows a second, at least one; more than a hundred is taken for a mistake."""
    n = F.greatest(F.lit(1).cast("long"), F.expr("cast(0 as bigint)") + F.floor(rows_per_second / 10))
    return F.when(n > 100, F.raise_error(F.lit("over 100 partitions: set the number yourself")).cast("long")).otherwise(n)
