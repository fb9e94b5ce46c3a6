"""The continuous pipeline: change tables and snapshots to messages and progress, under the settings.

Each micro-batch reads all followed tables between the same two log positions, and one more page of every snapshot that is
still running. Its messages, with those copied to combined topics, the progress of each topic (a heartbeat where it had no
change) and the snapshot log become visible in one commit. What was recorded there sets where a new run starts.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changeloom import plugins
from changeloom.config import CdcConfig
from changeloom.functions import expr as X
from changeloom.model import INDEX_COLUMNS, LOWEST_TEXT, SNAPSHOT, UNIFIED_CHANGE, ChangeIndex, FieldSpec, TableSpec
from changeloom.operators import changes, decisions, envelope, progress, snapshot
from changeloom.sources.work import cut, numbered, scoped
from changeloom.streaming import sink, source

#: Called with a batch's id and its messages, after the commit.
Reporter = Callable[[int, DataFrame], None]
#: Called between batches; `terminate` ends the run, anything else doesn't.
Watch = Callable[[], str]

_INDEX = "lsn string, command_id int, seqval string, operation int"


@dataclass(frozen=True)
class Capture:
    """A table to follow: what it is like, and the Parquet folders of its changes and, for a snapshot, of itself."""

    spec: TableSpec
    changes: str
    table: str | None = None
    mask: str | None = "update_mask"  # the column with the update mask, as a number
    known_lsn: str | None = None  # the highest position that an instance before this one has published


def position_stream(spark: SparkSession, lsn_map: str, **options: str) -> DataFrame:
    # The source is planned in a Python process that doesn't see files added to the application: its code goes along.
    cloudpickle.register_pickle_by_value(source)
    spark.dataSource.register(source.PositionSource)
    return spark.readStream.format(source.NAME).options(lsn_map=lsn_map, **options).load()


def named(c: Capture, config: CdcConfig) -> Capture:
    """The capture with what the settings say: its topic's name, fields to cut, whether it gets a snapshot."""
    spec = c.spec
    topic = spec.topic or config.topic_template.format(schema_name=spec.schema_name, table_name=spec.table_name, capture_instance_name=spec.capture_instance)
    limits = {k.lower(): v for k, v in config.truncate_fields.items()}
    fields = tuple(replace(f, truncate_after=limits.get(f"{spec.qualified_name}.{f.name}".lower(), f.truncate_after)) for f in spec.fields)
    return replace(c, spec=replace(spec, topic=topic, fields=fields, snapshot_allowed=config.snapshots(spec.qualified_name) and c.table is not None))


class Pipeline:
    def __init__(self, spark: SparkSession, config: CdcConfig, captures: list[Capture], lsn_map: str, out: str, checkpoint: str, reporters: list[Reporter] | None = None, watch: Watch | None = None):
        self.spark, self.config, self.lsn_map, self.out, self.checkpoint = spark, config, lsn_map, out, checkpoint
        self.captures = [named(c, config) for c in captures if config.follows(c.spec.qualified_name)]
        self.reporters, self.watch, self.ended = reporters or [], watch, ""
        self.codec = plugins.load(config.serializer)
        done = sink.committed(spark, out)
        self._first_batch = done[-1] + 1 if done else 0  # of this run
        self.starts = {r.topic: r for r in self.report().collect()}  # one row for each table
        refused = sorted(t for t, r in self.starts.items() if r.gap == "raise" or r.snapshot == "raise")
        if refused and not config.report_only:
            raise RuntimeError(f"cannot start {refused}: the log doesn't reach back to their progress, or a snapshot needs a key")

    # -------------------------------------------------------------- start

    def recorded(self) -> DataFrame:
        """The last change progress of each topic."""
        found = sink.read(self.spark, self.out, "progress")
        if found is None:
            return self.spark.createDataFrame([], f"topic string, {_INDEX}")
        last = found.groupBy("topic").agg(F.max(X.index()).alias("i"))
        return last.select("topic", *[F.col(f"i.{c}").alias(c) for c in INDEX_COLUMNS])

    def snapshot_states(self) -> dict[str, tuple[str | None, bool]]:
        """For each topic with snapshot progress: the last key sent, and whether the snapshot is complete."""
        found = sink.read(self.spark, self.out, "snapshot_progress")
        if found is None:
            return {}
        last = found.groupBy("topic").agg(F.max_by(F.struct("last_key", "complete"), "batch_id").alias("x"))
        return {r.topic: (r.x.last_key, r.x.complete) for r in last.collect()}

    def report(self) -> DataFrame:
        """For each followed table where its changes start, what a gap in the log leads to, and the state of its snapshot."""
        cfg = self.config
        ltm = self.spark.read.parquet(self.lsn_map)
        top = changes.max_lsn(ltm).first().max_lsn or LOWEST_TEXT
        cases = [(c.spec.topic, c.spec.qualified_name, c.spec.capture_instance, "0x" + c.spec.min_lsn.hex(), c.known_lsn, c.spec.snapshot_allowed, c.spec.has_key, ",".join(cfg.combined(c.spec.qualified_name))) for c in self.captures]
        tables = self.spark.createDataFrame(cases, "topic string, table_name string, capture_instance string, min_lsn string, known_lsn string, snapshot_allowed boolean, has_key boolean, combined string")
        same = F.lit("")  # progress is kept by topic, so the change table it came from isn't another one here
        point = F.lit("earliest" if cfg.run_validations else cfg.new_follow_start_point)
        wanted = tables.join(self.recorded(), "topic", "left").withColumns({"progress_table": same, "change_table": same, "overlap": F.lit(cfg.new_instance_overlap), "start_point": point})
        starts = decisions.start_points(wanted, top)
        gaps = tables.join(starts, "topic").select(F.col("topic").alias("case_id"), F.col("lsn").alias("start_lsn"), "min_lsn", F.col("known_lsn").alias("prior_max_lsn"), F.lit(cfg.lsn_gap_handling).alias("handling"), "snapshot_allowed")
        gaps = decisions.gap_decision(gaps).select(F.col("case_id").alias("topic"), F.col("decision").alias("gap"))
        done = self.snapshot_states()
        state = [(t, k, c) for t, (k, c) in done.items()]
        seen = self.spark.createDataFrame(state, "topic string, last_key string, complete boolean")
        kept = tables.join(seen, "topic", "left").join(gaps, "topic")
        allowed = F.col("snapshot_allowed") & F.lit(not cfg.run_validations)
        snap = (
            F.when(~allowed, "none").when(~F.col("has_key"), "raise").when(F.col("gap") == "begin new snapshot", "full")
            .when(F.col("complete"), "complete").when(F.col("last_key").isNotNull(), "resume").otherwise("full")
        )
        rows = kept.withColumn("snapshot", snap).join(starts, "topic")
        return rows.select("topic", "table_name", "capture_instance", *INDEX_COLUMNS, "gap", "snapshot", "combined").orderBy("topic")

    # -------------------------------------------------------------- messages of a batch

    def _encoded(self, rows: DataFrame, spec: TableSpec, mask: Column | None) -> DataFrame:
        messages = envelope.envelope(rows, spec, mask)
        carried = messages.withColumn("place", F.monotonically_increasing_id()) if mask is None else messages.withColumn("place", F.lit(0).cast("long"))
        if self.config.disable_tombstones or mask is None:
            carried = carried.withColumn("sub", F.lit(0))
        else:
            carried = envelope.with_tombstones(carried)
        kind = F.create_map(F.lit(self.config.message_type_header), F.col("message_type"))
        out = self.codec.encode(carried, spec)
        return out.select("topic", "message_type", "operation", "event_time", *[F.col(f"idx.{c}").alias(c) for c in INDEX_COLUMNS if c != "operation"], "sub", "place", "key", "value", F.map_concat("headers", kind).alias("headers"))

    def change_messages(self, c: Capture, after: str, upto: str, ltm: DataFrame) -> DataFrame:
        """Messages of a table's changes after one position and its own start, up to another."""
        at = self.starts[c.spec.topic]
        own = ChangeIndex.of(at.lsn, at.command_id, at.seqval, at.operation)
        rows = changes.published(self.spark.read.parquet(c.changes)).where((F.col("lsn") <= upto) & X.after_index(own))
        if after != LOWEST_TEXT:
            rows = rows.where(F.col("lsn") > after)
        mask = F.lit(None).cast("binary") if c.mask is None else X.int_mask(F.col(c.mask))
        return self._encoded(changes.with_event_time(rows, ltm), c.spec, mask)

    def snapshot_page(self, c: Capture, below: str | None) -> tuple[DataFrame, str | None, bool]:
        """(messages of the next page, the least key sent so far, whether the table's end is reached)."""
        spec, limit = c.spec, self.config.snapshot_rows or self.config.batch_rows
        types = {f.name: f.spark.dataType.simpleString() for f in spec.value_fields}
        table = snapshot.columns(self.spark.read.parquet(c.table), list(types.items()))
        bound = None if below is None else [F.lit(v).cast(types[n]) for n, v in zip(spec.key_names, json.loads(below), strict=True)]
        page = cut(snapshot.page(table, spec.key_names, limit, bound), "page")
        n = page.count()
        low = snapshot.extreme_key(page, spec.key_names, highest=False).select(*[F.col(k).cast("string") for k in spec.key_names]).first()
        none = {"lsn": "string", "command_id": "int", "seqval": "string"}
        rows = page.orderBy(*[F.col(k).desc() for k in spec.key_names]).select("*", *[F.lit(None).cast(t).alias(k) for k, t in none.items()], F.lit(SNAPSHOT).alias("operation"), F.current_timestamp().cast("timestamp_ntz").alias("event_time"))
        return self._encoded(rows, spec, None), (json.dumps(list(low)) if n else below), n < limit

    def _combined(self, messages: DataFrame) -> DataFrame | None:
        """Copies of changes for combined topics."""
        pairs = [(c.spec.topic, t) for c in self.captures for t in self.config.combined(c.spec.qualified_name)]
        if not pairs:
            return None
        targets = F.create_map(*[x for topic in {t for t, _ in pairs} for x in (F.lit(topic), F.array(*[F.lit(u) for t, u in pairs if t == topic]))])
        copies = messages.where(F.col("operation").isNotNull() & (F.col("operation") != SNAPSHOT)).withColumn("_to", F.explode(targets[F.col("topic")]))
        headers = F.map_concat(F.map_filter("headers", lambda k, _: k != self.config.message_type_header), F.create_map(F.lit(self.config.message_type_header), F.lit(UNIFIED_CHANGE), F.lit(self.config.original_topic_header), F.col("topic")))
        return copies.withColumn("headers", headers).withColumn("message_type", F.lit(UNIFIED_CHANGE)).withColumn("topic", F.col("_to")).drop("_to")

    def _placed(self, messages: DataFrame) -> DataFrame:
        """With partition and offset: a key's messages in one partition, offsets going on from the batches before."""
        n = self.config.partition_count or 1
        combined = list(self.config.unified_topics)
        parts = F.when(F.col("topic").isin(*combined), 0).otherwise(F.pmod(F.xxhash64("key"), F.lit(n))).cast("int") if combined else F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")
        order = ["topic", "partition_id", "lsn", "command_id", "seqval", "operation_order", "place", "sub"]
        dealt = messages.withColumn("partition_id", parts).withColumn("operation_order", F.coalesce("operation", F.lit(1)))
        ranked = numbered(dealt, [F.col(c).asc_nulls_first() for c in order], "_pos")
        firsts = ranked.groupBy("topic", "partition_id").agg(F.min("_pos").alias("_first"))  # one row for each partition
        before = sink.read(self.spark, self.out, "offsets")
        if before is None:
            firsts = firsts.withColumn("_next", F.lit(0).cast("long"))
        else:
            firsts = firsts.join(before.groupBy("topic", "partition_id").agg(F.max("next_offset").alias("_next")), ["topic", "partition_id"], "left")
        offset = F.coalesce("_next", F.lit(0)) + F.col("_pos") - F.col("_first")
        return ranked.join(F.broadcast(firsts), ["topic", "partition_id"]).withColumn("msg_offset", offset.cast("long")).drop("_pos", "_first", "_next", "operation_order", "place")

    def _batch(self, batch: DataFrame, batch_id: int) -> None:
        with scoped(self.spark):
            self._publish(batch, batch_id + self._first_commit)

    def _publish(self, batch: DataFrame, batch_id: int) -> None:
        spark = self.spark
        if sink.is_committed(spark, self.out, batch_id):
            return
        at = batch.agg(F.min("start_lsn").alias("a"), F.max("end_lsn").alias("b"), F.min("start_page").alias("p"), F.max("end_page").alias("q")).first()
        if at.b is None:
            return
        ltm = spark.read.parquet(self.lsn_map).where((F.col("start_lsn") > at.a) & (F.col("start_lsn") <= at.b)) if at.a != LOWEST_TEXT else spark.read.parquet(self.lsn_map).where(F.col("start_lsn") <= at.b)
        frames = [self.change_messages(c, at.a, at.b, ltm) for c in self.captures] if at.b > at.a else []
        states, log, keys = self.snapshot_states(), [], []
        for c in self.captures if at.q > at.p and not self.config.run_validations else []:
            topic = c.spec.topic
            key, complete = states.get(topic, (None, False))
            if self.starts[topic].gap == "begin new snapshot" and batch_id == self._first_batch:
                key, complete = None, False
            if not c.spec.snapshot_allowed or complete:
                continue
            page, low, ends = self.snapshot_page(c, key)
            frames.append(page)
            keys.append((topic, low, ends))
            log += [(topic, "started" if key is None else "resumed", at.b)] * (key is None or batch_id == self._first_batch) + [(topic, "completed", at.b)] * ends
        if frames:
            own = cut(reduce(DataFrame.unionByName, frames), "messages")
            copies = self._combined(own)
            messages = cut(self._placed(own if copies is None else own.unionByName(copies)), "placed")
            moved = progress.per_topic(own)
        else:
            messages, moved = None, spark.createDataFrame([], f"topic string, progress_kind string, {_INDEX}, n long")
        topics = spark.createDataFrame([(c.spec.topic,) for c in self.captures], "topic string")
        beats = progress.heartbeats(topics, moved, at.b) if at.b > at.a else None
        moved = moved if beats is None else moved.unionByName(beats, allowMissingColumns=True)
        tables = {"progress": moved}
        if messages is not None:
            tables["messages"] = messages.sortWithinPartitions("topic", "partition_id", "msg_offset")
            tables["offsets"] = messages.groupBy("topic", "partition_id").agg((F.max("msg_offset") + 1).alias("next_offset"))
        if keys:
            tables["snapshot_progress"] = spark.createDataFrame(keys, "topic string, last_key string, complete boolean")
            tables["snapshot_log"] = spark.createDataFrame(log, "topic string, action string, ceiling string")
        sink.commit(tables, self.out, batch_id)
        for report in self.reporters:
            if messages is not None:
                report(batch_id, messages)

    # -------------------------------------------------------------- running

    def _pages(self) -> int:
        """Pages that the largest table with an unfinished snapshot needs, and one that finds its end."""
        states, limit = self.snapshot_states(), self.config.snapshot_rows or self.config.batch_rows
        open_ = [c for c in self.captures if c.spec.snapshot_allowed and not self.config.run_validations and (not states.get(c.spec.topic, (None, False))[1] or self.starts[c.spec.topic].gap == "begin new snapshot")]
        return max((self.spark.read.parquet(c.table).count() // limit + 1 for c in open_), default=0)

    def start(self, every: str | None = None) -> StreamingQuery:
        """One run of the stream: a batch of what is there, or with `every` batch after batch at that pace."""
        # A new checkpoint counts its batches from 0: its commits go on from those that are there.
        done = sink.committed(self.spark, self.out)
        self._first_commit = int(sink.once(self.spark, f"{self.checkpoint}/first_commit", str(done[-1] + 1 if done else 0)))
        # A table that is behind the others is read from its own start; the others' own starts keep them from repeating.
        first = min((r.lsn for r in self.starts.values()), default=LOWEST_TEXT)
        options = {"checkpoint": self.checkpoint, "starting_lsn": first, "max_lsns": str(self.config.max_lsns), "pages": str(self._pages_wanted)}
        stream = position_stream(self.spark, self.lsn_map, **options)
        writer = stream.writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
        return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()

    def run(self, every: str | None = None) -> int:
        """Publishes all there is, batch by batch, or goes on at a pace until the watch ends it; the number of batches."""
        if self.config.report_only or not self.captures:
            return len(sink.committed(self.spark, self.out))
        self._pages_wanted = self._page_offset() + self._pages()
        while True:
            before = len(sink.committed(self.spark, self.out))
            query = self.start(every)
            while every and not query.awaitTermination(10):
                if self._ends():
                    query.stop()
            if not every:
                query.awaitTermination()
            if every or self._ends() or len(sink.committed(self.spark, self.out)) == before:
                return len(sink.committed(self.spark, self.out))

    def _page_offset(self) -> int:
        """Pages that the checkpoint has handed out already."""
        given = source.PositionReader._resumed(self.checkpoint)
        return given["page"] if given else 0

    def _ends(self) -> bool:
        """Whether a change of capture instances asks for the end: only where the settings say so."""
        if self.watch is None or not self.config.terminate_on_instance_change or self.ended:
            return bool(self.ended)
        self.ended = "terminate" if self.watch() == "terminate" else ""
        return bool(self.ended)


def instance_watch(decide: Callable[[], DataFrame]) -> Watch:
    """A watch over `catalog.instance_changes`: ends the run when tables have other instances and none has to wait."""

    def look() -> str:
        found = [r.decision for r in decide().select("decision").collect()]  # one row for each table that changed
        return "none" if not found else "defer" if "defer" in found else "terminate"

    return look


def captures_of(tables: list[dict]) -> list[Capture]:
    """Captures from plain data: schema_name, table_name, capture_instance, changes, fields and, if wanted, table, mask, topic, min_lsn, known_lsn."""
    out = []
    for t in tables:
        fields = tuple(FieldSpec(**f) for f in t["fields"])
        low = {"min_lsn": bytes.fromhex(t["min_lsn"][2:])} if "min_lsn" in t else {}
        spec = TableSpec(t["schema_name"], t["table_name"], t["capture_instance"], fields, topic=t.get("topic", ""), **low)
        out.append(Capture(spec, t["changes"], t.get("table"), t.get("mask", "update_mask"), t.get("known_lsn")))
    return out


def decoded(messages: DataFrame, capture: Capture, codec: plugins.Codec) -> DataFrame:
    """A topic's messages as rows, with what orders them, for replay."""
    own = messages.where(F.col("topic") == capture.spec.topic)
    return codec.decode(own, capture.spec, ["topic", "partition_id", "msg_offset", "operation", *[c for c in INDEX_COLUMNS if c != "operation"], "sub"])


def index_order() -> Column:
    """The change index with the tombstone after its delete, as one value to order messages by."""
    return F.struct(*[F.col(c) for c in INDEX_COLUMNS], F.col("sub"))


def messages_of(batch: DataFrame, ltm: DataFrame, tombstones: bool = True) -> DataFrame:
    """Bare rows of published changes with commit times, and tombstones after deletes."""
    rows = changes.with_event_time(changes.published(batch), ltm)
    return envelope.with_tombstones(rows) if tombstones else rows.withColumn("sub", F.lit(0))


def published_batch(ct: DataFrame, ltm: DataFrame, topic: Column) -> DataFrame:
    """What the stream publishes of a table, in one batch and before it is encoded: the measure for the stream."""
    return messages_of(ct, ltm).withColumn("topic", topic)
