"""Reconciliation of a topic with its change table, its source table and its recorded progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeloom.functions import expr as X
from changeloom.model import DELETE, INDEX_COLUMNS, INSERT, POST_UPDATE, SNAPSHOT
from changeloom.sources.work import numbered

_LOG = ["topic", "partition_id"]


BUCKET = 1 << 16  # offsets of a partition that one task puts in order


def _with_neighbour(log: DataFrame, value: Column, name: str = "_near", after: bool = False, bucket: int = BUCKET) -> DataFrame:
    """Each row with the last value that isn't null before it in its partition of the log, or the next one after it.

    A partition is cut into buckets of offsets, so one that holds most of a topic isn't one task's. A bucket's own end value
    is carried over to the buckets beyond; there is one such row for each bucket.
    """
    cols = log.columns
    rows = log.withColumn("_bucket", F.floor(F.col("msg_offset") / bucket)).withColumn("_value", value)
    # What comes after is met by going backwards: a frame that grows is added to, one that shrinks is made anew for each row.
    place = (lambda c: F.desc(c)) if after else F.col
    inside = Window.partitionBy(*_LOG, "_bucket").orderBy(place("msg_offset")).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*_LOG).orderBy(place("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    where = F.when(F.col("_value").isNotNull(), F.col("msg_offset"))
    own, carried = F.last("_value", ignorenulls=True).over(inside), F.last("_edge", ignorenulls=True).over(across)
    edge = (F.min_by if after else F.max_by)("_value", where)
    edges = rows.groupBy(*_LOG, "_bucket").agg(edge.alias("_edge")).withColumn("_carried", carried)
    near = rows.withColumn("_own", own).join(edges.select(*_LOG, "_bucket", "_carried"), [*_LOG, "_bucket"])
    return near.select(*cols, F.coalesce("_own", "_carried").alias(name))


def missing_offsets(log: DataFrame, first: int = 0, bucket: int = BUCKET) -> DataFrame:
    """Offsets that each partition's read lacks, counted from `first` on."""
    near = _with_neighbour(log.select(*_LOG, "msg_offset"), F.col("msg_offset"), bucket=bucket)
    gap = F.col("msg_offset") - F.coalesce("_near", F.lit(first - 1)) - 1
    return near.groupBy(*_LOG).agg(F.sum(gap).cast("long").alias("missing"))


def _is_change() -> Column:
    return F.col("operation").isNotNull() & (F.col("operation") != SNAPSHOT)


def change_regressions(log: DataFrame, min_lsn: str | None = None, bucket: int = BUCKET) -> DataFrame:
    """For each partition the published changes whose index is below that of the change before."""
    rows = log.where(X.is_published(F.col("operation")))
    if min_lsn is not None:
        rows = rows.where(F.col("lsn") >= min_lsn)
    near = _with_neighbour(rows.select(*_LOG, "msg_offset", X.index().alias("_idx")), F.col("_idx"), bucket=bucket)
    return near.groupBy(*_LOG).agg(F.count_if(F.col("_near") > F.col("_idx")).alias("regressions"))


def snapshot_regressions(log: DataFrame, key: list[str], bucket: int = BUCKET) -> DataFrame:
    """For each partition the snapshot rows whose key is above that of the snapshot row before, as snapshots run downwards."""
    rows = log.where(F.col("operation") == SNAPSHOT).select(*_LOG, "msg_offset", X.key_struct(key).alias("_key"))
    near = _with_neighbour(rows, F.col("_key"), bucket=bucket)
    return near.groupBy(*_LOG).agg(F.count_if(F.col("_near") < F.col("_key")).alias("regressions"))


def missing_tombstones(log: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Deletes that no tombstone follows, snapshots aside. A partition's last message can't be judged."""
    rows = log.where(F.col("operation").isNull() | (F.col("operation") != SNAPSHOT)).select(*_LOG, "msg_offset", "operation")
    near = _with_neighbour(rows, F.coalesce("operation", F.lit(-1)), after=True, bucket=bucket)
    return near.where((F.col("operation") == DELETE) & F.col("_near").isNotNull() & (F.col("_near") != -1)).select(*_LOG, "msg_offset")


def summary(log: DataFrame, min_lsn: str) -> DataFrame:
    """Counts of each topic's messages by kind, and the least and greatest change index."""
    return _summary(log, min_lsn)


def _summary(log: DataFrame, min_lsn: str, *more: Column) -> DataFrame:
    counted = X.is_published(F.col("operation")) & (F.col("lsn") >= min_lsn)
    known = F.col("operation").isin(SNAPSHOT, DELETE, INSERT, POST_UPDATE)
    return log.groupBy("topic").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("operation").isNull()).alias("tombstones"),
        F.count_if(F.col("operation") == DELETE).alias("all_deletes"),
        *[F.count_if(counted & (F.col("operation") == op)).alias(n) for op, n in ((DELETE, "deletes"), (INSERT, "inserts"), (POST_UPDATE, "updates"))],
        F.count_if(F.col("operation") == SNAPSHOT).alias("snapshots"),
        F.count_if(F.col("operation").isNotNull() & ~known).alias("unknown_operations"),
        F.min(F.when(counted, X.index())).alias("low"), F.max(F.when(counted, X.index())).alias("high"), *more,
    )


def key_sets(log: DataFrame, key: list[str]) -> DataFrame:
    """For each topic and key whether it occurs in snapshots, in changes, among deletes, and whether its last change is a delete.

    One aggregate by key gives what sets of keys in memory would.
    """
    change = _is_change()
    return log.where("operation IS NOT NULL").groupBy("topic", *key).agg(
        F.max(F.col("operation") == SNAPSHOT).alias("in_snapshot"), F.max(change).alias("in_changes"), F.max(change & (F.col("operation") == DELETE)).alias("deleted"),
        F.max_by(F.col("operation") == DELETE, F.when(change, X.index())).alias("ends_deleted"),
    )


def distinct_keys(log: DataFrame, key: list[str]) -> DataFrame:
    return key_sets(log, key).groupBy("topic").agg(F.count_if("in_snapshot").alias("snapshot_keys"), F.count_if("in_changes").alias("change_keys"), F.count_if("deleted").alias("deleted_keys"), F.count_if(F.col("in_snapshot") & ~F.col("deleted")).alias("snapshot_keys_left"))


def live_keys(log: DataFrame, key: list[str], by_last_operation: bool = False) -> DataFrame:
    """Keys that the source table should hold, within the range of snapshot keys.

    By sets, a key that was ever deleted is out; by the last operation, one that came back counts.
    """
    sets = key_sets(log, key)
    bounds = sets.where("in_snapshot").groupBy("topic").agg(F.min(X.key_struct(key)).alias("low"), F.max(X.key_struct(key)).alias("high"))
    gone = F.coalesce("ends_deleted", F.lit(False)) if by_last_operation else F.col("deleted")
    inside = sets.join(bounds, "topic").where(X.key_struct(key).between(F.col("low"), F.col("high")))
    return inside.where(~gone).select("topic", *key)


def table_verdicts(log: DataFrame, key: list[str], min_lsn: str, ct: DataFrame, source: DataFrame, progress: DataFrame) -> DataFrame:
    """One row for each topic: what was found and the names of the rules it breaks.

    progress: topic, lsn, command_id, seqval, operation of the last change progress (all but topic null where there is none).
    """
    counted = X.is_published(F.col("operation")) & (F.col("lsn") >= min_lsn)
    # One walk along the log finds both kinds of regressions, one aggregate by key all counts of keys.
    walked = log.select(*_LOG, "msg_offset", "operation", *key, *[c for c in INDEX_COLUMNS if c != "operation"])
    walked = _with_neighbour(walked, F.when(counted, X.index()), "_idx_before")
    walked = _with_neighbour(walked, F.when(F.col("operation") == SNAPSHOT, X.key_struct(key)), "_key_before")
    base = _summary(
        walked, min_lsn,
        F.count_if(counted & (F.col("_idx_before") > X.index())).alias("index_regressions"),
        F.count_if((F.col("operation") == SNAPSHOT) & (F.col("_key_before") < X.key_struct(key))).alias("snapshot_regressions"),
        F.min(F.when(F.col("operation") == SNAPSHOT, X.key_struct(key))).alias("low_key"), F.max(F.when(F.col("operation") == SNAPSHOT, X.key_struct(key))).alias("high_key"),
    )
    sets = key_sets(log, key)
    bounds = sets.where("in_snapshot").groupBy("topic").agg(F.min(X.key_struct(key)).alias("low"), F.max(X.key_struct(key)).alias("high"))
    # Topics are one for each table: their rows may be broadcast, so that source and change tables are read once and not moved.
    inside = X.key_struct(key).between(F.col("low"), F.col("high"))
    keys = sets.join(F.broadcast(bounds), "topic", "left").groupBy("topic").agg(
        F.count_if("in_snapshot").alias("snapshot_keys"), F.count_if(F.col("in_snapshot") & ~F.col("deleted")).alias("snapshot_keys_left"), F.count_if(F.coalesce(inside, F.lit(False)) & ~F.col("deleted")).alias("expected_rows")
    )
    tops = base.select("topic", "high", "low_key", "high_key")
    held = source.select(X.key_struct(key).alias("k")).join(F.broadcast(tops), F.col("k").between(F.col("low_key"), F.col("high_key"))).groupBy("topic").agg(F.count("*").alias("source_rows"))
    table = ct.where(X.is_published(F.col("operation"))).select("operation", X.index().alias("idx")).join(F.broadcast(tops), F.col("idx") <= F.col("high"))
    table = table.groupBy("topic").agg(*[F.count_if(F.col("operation") == op).alias(n) for op, n in ((DELETE, "db_deletes"), (INSERT, "db_inserts"), (POST_UPDATE, "db_updates"))])
    seen = progress.select("topic", X.index().alias("recorded"), X.is_heartbeat().alias("beat"))
    out = base
    for part in (keys, held, table, seen):
        out = out.join(F.broadcast(part), "topic", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    has_progress = F.col("recorded.lsn").isNotNull()
    rules = [
        ("source_rows", (zero("snapshot_keys_left") > 0) & (zero("source_rows") != zero("expected_rows"))),
        ("no_progress", ~F.coalesce(has_progress, F.lit(False))),
        ("heartbeat_behind", has_progress & F.col("beat") & (F.col("high") > F.col("recorded"))),
        ("progress_differs", has_progress & ~F.col("beat") & ~F.col("high").eqNullSafe(F.col("recorded"))),
        ("index_order", zero("index_regressions") > 0),
        ("snapshot_order", (zero("snapshot_regressions") > 0) & (F.col("snapshot_keys_left") == F.col("snapshots"))),
        ("unknown_operations", F.col("unknown_operations") > 0),
        ("tombstones", (F.col("tombstones") > 0) & (F.col("tombstones") < F.col("all_deletes"))),
        *[(n, F.col(n) != zero(f"db_{n}")) for n in ("deletes", "inserts", "updates")],
    ]
    failures = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules]))
    warned = [("snapshot_repeats", (F.col("snapshots") > 0) & (F.col("snapshot_keys") != F.col("snapshots"))), ("snapshot_order", (zero("snapshot_regressions") > 0) & (F.col("snapshot_keys_left") != F.col("snapshots")))]
    warnings = F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in warned]))
    return out.select(
        "topic", "total", "tombstones", "all_deletes", "deletes", "inserts", "updates", "snapshots", zero("index_regressions").cast("long").alias("index_regressions"), zero("expected_rows").cast("long").alias("expected_rows"),
        zero("source_rows").cast("long").alias("source_rows"), F.array_join(failures, ",").alias("failures"), F.array_join(warnings, ",").alias("warnings"),
    )


def unified_verdicts(log: DataFrame, expected_topics: list[str]) -> DataFrame:
    """One row for each combined topic of one partition: regressions, tombstones and messages of other topics."""
    rows = _with_neighbour(log.select(*_LOG, "msg_offset", "original_topic", *INDEX_COLUMNS), F.when(F.col("operation").isNotNull(), X.index()))
    rows = rows.withColumn("back", F.col("operation").isNotNull() & (F.col("_near") > X.index()))
    out = rows.groupBy("topic").agg(
        F.count("*").alias("total"), F.count_if("back").alias("regressions"), F.count_if(F.col("operation").isNull()).alias("tombstones"),
        F.count_if(F.col("operation").isNotNull() & ~F.col("original_topic").isin(*expected_topics)).alias("unexpected"), F.count_if(F.col("operation") == SNAPSHOT).alias("snapshots"),
    )
    rules = [("index_order", F.col("regressions") > 0), ("tombstones", F.col("tombstones") > 0), ("snapshots", F.col("snapshots") > 0)]
    return out.withColumn("failures", F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules])), ",")).withColumn("warnings", F.when(F.col("unexpected") > 0, "unexpected_topics").otherwise(""))


def _places(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their place `n` in their partition, by a sort over all partitions at once, so that none is one task's."""
    ranked = numbered(rows, [F.col("partition_id"), *[F.col(c) for c in order]], "_pos")
    firsts = ranked.groupBy("partition_id").agg(F.min("_pos").alias("_first"))  # one row for each partition
    return ranked.join(F.broadcast(firsts), "partition_id").withColumn("n", F.col("_pos") - F.col("_first") + 1).drop("_pos", "_first")


def positional(log: DataFrame, ct: DataFrame, partition: Column) -> DataFrame:
    """The n-th published change of a partition beside the n-th row of the change table that belongs there.

    Messages from before the change table's first row are left out; from there on places are counted, not keys matched.
    """
    rows = ct.where(X.is_published(F.col("operation"))).select(partition.alias("partition_id"), X.index().alias("table_idx"))
    first = rows.groupBy("partition_id").agg(F.min("table_idx").alias("first"))  # one row for each partition
    messages = log.where(X.is_published(F.col("operation"))).select("partition_id", "msg_offset", X.index().alias("topic_idx")).join(F.broadcast(first), "partition_id").where(F.col("topic_idx") >= F.col("first"))
    messages = _places(messages.select("partition_id", "msg_offset", "topic_idx"), ["msg_offset"]).select("partition_id", "n", "topic_idx")
    rows = _places(rows, ["table_idx"]).select("partition_id", "n", "table_idx")
    return messages.join(rows, ["partition_id", "n"], "full_outer").withColumn("same", F.coalesce(F.col("topic_idx") == F.col("table_idx"), F.lit(False)))


def comparison(log: DataFrame, ct: DataFrame, partition: Column) -> DataFrame:
    both = positional(log, ct, partition)
    return both.groupBy("partition_id").agg(F.count("*").alias("rows"), F.count_if("same").alias("same"), F.count_if(F.col("topic_idx").isNull()).alias("only_table"), F.count_if(F.col("table_idx").isNull()).alias("only_topic"))


def mismatch_blocks(log: DataFrame, ct: DataFrame, partition: Column) -> DataFrame:
    """Runs of positions that differ: how many, and their sizes."""
    rows = _places(positional(log, ct, partition).where(~F.col("same")).select("partition_id", F.col("n").alias("at")), ["at"])
    blocks = rows.withColumn("run", F.col("at") - F.col("n")).groupBy("partition_id", "run").agg(F.count("*").alias("size"))
    return blocks.groupBy("partition_id").agg(F.count("*").alias("blocks"), F.min("size").alias("least"), F.max("size").alias("most"), F.round(F.avg("size"), 6).alias("mean"))


def progress_problems(log: DataFrame) -> DataFrame:
    """Change progress entries that repeat the one before (heartbeats may) or lie before it; resets don't count as entries."""
    rows = log.where("lsn IS NOT NULL AND progress_kind = 'change_rows'")
    before = F.lag(X.index()).over(Window.partitionBy("topic_name").orderBy("msg_offset"))
    judged = rows.withColumn("_before", before)
    return judged.withColumn("problem", F.when((F.col("_before") == X.index()) & ~X.is_heartbeat(), "duplicate").when(F.col("_before") > X.index(), "unordered")).where("problem IS NOT NULL").select("topic_name", "msg_offset", "problem")


def snapshot_problems(log: DataFrame) -> DataFrame:
    """Snapshot progress that rises, or starts again after its end (a null key): an evolution where the change table is another one."""
    w = Window.partitionBy("topic_name").orderBy("msg_offset")
    seen = F.lag(F.struct("last_key", "change_table_name")).over(w)
    judged = log.withColumn("_b", seen).where(F.col("last_key").isNotNull() & F.col("_b").isNotNull())
    restarted = F.col("_b.last_key").isNull() | (F.col("_b.last_key") < F.col("last_key"))
    return judged.where(restarted).select("topic_name", "msg_offset", F.when(F.col("_b.change_table_name") != F.col("change_table_name"), "evolution").otherwise("problem").alias("kind"))


def progress_summary(log: DataFrame) -> DataFrame:
    """For each topic the entries of its progress log, resets (no change table's value), heartbeats and problems."""
    change = (F.col("progress_kind") == "change_rows") & F.col("lsn").isNotNull()
    snap = F.col("progress_kind") == "snapshot_rows"
    totals = log.groupBy("topic_name").agg(
        F.count_if(change).alias("change_entries"), F.count_if(snap).alias("snapshot_entries"), F.count_if(~change & ~snap).alias("resets"), F.count_if(change & X.is_heartbeat()).alias("heartbeats"),
        F.count_distinct(F.when(change | snap, F.col("change_table_name"))).alias("change_tables"),
    )
    problems = progress_problems(log).groupBy("topic_name").agg(F.count("*").alias("problems"))
    return totals.join(problems, "topic_name", "left").withColumn("problems", F.coalesce("problems", F.lit(0)))


def anomalies(summary_rows: DataFrame) -> DataFrame:
    return summary_rows.where("change_tables > 1 OR resets > 0 OR problems > 0")


