from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom import plugins
from changeloom.config import CdcConfig
from changeloom.model import FieldSpec, TableSpec
from changeloom.operators import catalog, changes, envelope, ops, replay, snapshot, validate
from changeloom.sources import database, topic_log
from changeloom.sources.fixtures import view
from changeloom.sources.work import numbered
from changeloom.streaming import pipeline, sink
from changeloom.streaming import replay as streamed
from changeloom.streaming.reporters import FileReporter, batch_reporter

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("bad", [{"lsn_gap_handling": "x"}, {"capture_strategy": "regex"}, {"table_include": "("}, {"batch_rows": 0}, {"topic_template": "{nope}"}, {"new_follow_start_point": "now"}])
def test_bad_settings_raise(bad):
    with pytest.raises((ValueError, KeyError, Exception)):
        CdcConfig(**bad)


def test_good_settings():
    assert CdcConfig(unified_topics={"all": "app\\."}).batch_rows == 2000


def test_numbered_is_a_total_order(spark):
    rows = spark.range(1000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(1_000_003)))
    got = numbered(rows, [F.col("k"), F.col("id")]).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 1001))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_pages_are_the_whole_snapshot(spark):
    table = view(spark, SF, "live_user").select("user_id")
    want = [r.user_id for r in snapshot.full(table, ["user_id"]).collect()]
    got, below = [], None
    while True:
        rows = [r.user_id for r in snapshot.page(table, ["user_id"], 7, below).collect()]
        got += rows
        if len(rows) < 7:
            break
        below = [rows[-1]]
    assert got == want


def test_pages_of_changes_lose_nothing(spark):
    from changeloom.model import LOWEST, ChangeIndex

    ct, ltm = view(spark, SF, "ct_user"), view(spark, SF, "ltm")
    total = changes.with_event_time(changes.published(ct), ltm).count()
    at, seen = LOWEST, 0
    while True:
        rows = changes.scan(ct, ltm, at, "0x" + "ff" * 10, 400).select("lsn", "command_id", "seqval", "operation").collect()
        seen += len(rows)
        if len(rows) < 400:
            break
        at = ChangeIndex.of(*rows[-1])
    assert seen == total


def test_replay_in_batches_equals_the_source(spark):
    topic, live = view(spark, SF, "topic_user"), view(spark, SF, "live_user")
    columns = ["user_id", "event_type", "value", "props"]
    state = None
    for low in range(0, 600, 150):
        state = replay.apply(state, topic.where((F.col("msg_offset") >= low) & (F.col("msg_offset") < low + 150)), ["user_id"], columns)
    assert sorted(map(tuple, state.collect()), key=str) == sorted(map(tuple, live.select(*columns).collect()), key=str)


def test_bounded_read_clamps_at_the_low_mark(spark):
    log = spark.createDataFrame([("t", p, o) for p, n in ((0, 20), (1, 2), (2, 8)) for o in range(n)], "topic string, partition_id int, msg_offset long")
    marks = topic_log.watermarks(log).select("topic", "partition_id", "low", "high")
    got = topic_log.bounded(log, marks, 10).groupBy("partition_id").agg(F.min("msg_offset").alias("lo"), F.count("*").alias("n")).collect()
    assert {r.partition_id: (r.lo, r.n) for r in got} == {0: (17, 3), 1: (0, 2), 2: (5, 3)}


def test_missing_connector_is_named(spark):
    with pytest.raises(RuntimeError, match="connector"):
        topic_log.read_broker(spark, **topic_log.broker_options("host:1", ["t"]))
    assert topic_log.starting_offsets({("t", 0): 5}, {"t": 2}) == '{"t": {"0": 6, "1": -2}}'


def test_clustered_index_contract():
    catalog.clustered_index_in_order(["__$start_lsn", "__$command_id", "__$seqval", "__$operation"])
    with pytest.raises(ValueError):
        catalog.clustered_index_in_order(["__$start_lsn", "__$seqval"])


def test_partition_count_bounds(spark):
    n = spark.createDataFrame([(0,), (9,), (25,), (1000,)], "r long").select(envelope.partition_count(F.col("r")).alias("n"))
    assert [r.n for r in n.collect()] == [1, 1, 2, 100]
    with pytest.raises(Exception, match="partitions"):
        spark.createDataFrame([(5000,)], "r long").select(envelope.partition_count(F.col("r")).alias("n")).collect()


def test_clean_and_faulty_topics_get_different_verdicts(spark):
    clean = view(spark, SF, "topic_user")
    assert validate.missing_tombstones(clean).count() == 0
    assert validate.missing_tombstones(view(spark, SF, "topic_user_bad")).count() > 0
    assert validate.missing_offsets(clean).agg(F.sum("missing").alias("n")).first().n == 0
    assert validate.change_regressions(clean).agg(F.sum("regressions").alias("n")).first().n == 0


def test_truncation_script():
    text = ops.truncation_commands([("t", 0, 5), ("t", 1, 7)], "host:1")
    assert '{"topic":"t","partition":1,"offset":7}' in text


def test_placed_keeps_key_order(spark):
    rows = spark.range(200).select(F.lit("t").alias("topic"), (F.col("id") % 7).alias("k"), "id")
    got = envelope.placed(rows, F.col("k"), 3, [F.col("id")]).collect()
    assert len({(r.k, r.partition_id) for r in got}) == 7
    for p in {r.partition_id for r in got}:
        own = sorted((r.msg_offset, r.id) for r in got if r.partition_id == p)
        assert [o for o, _ in own] == list(range(len(own)))
        assert [i for _, i in own] == sorted(i for _, i in own)


def test_sink_is_idempotent(spark, tmp_path):
    out = f"file://{tmp_path}/out"
    sink.commit({"messages": spark.range(3)}, out, 0)
    sink.commit({"messages": spark.range(50)}, out, 0)  # the same batch once more
    assert sink.read(spark, out, "messages").count() == 3
    spark.range(9).write.parquet(f"{out}/messages/batch_id=1")  # died before its marker
    assert sink.read(spark, out, "messages").count() == 3


USER = TableSpec("app", "user", "app_user_v1", (FieldSpec("user_id", "bigint", 1, 1), FieldSpec("event_type", "varchar", 2), FieldSpec("value", "float", 3), FieldSpec("props", "nvarchar", 4)))


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    home = f"file://{tmp_path_factory.mktemp('store')}"
    for name in ("ct_user", "ltm", "live_user"):
        view(spark, SF, name).write.parquet(f"{home}/{name}")
    return home


def made(spark, store, out, config, known_lsn=None, spec=USER, checkpoint="cp", **more):
    capture = pipeline.Capture(spec, f"{store}/ct_user", f"{store}/live_user", known_lsn=known_lsn)
    return pipeline.Pipeline(spark, config, [capture], f"{store}/ltm", f"{out}/out", f"{out}/{checkpoint}", **more)


def changes_of(spark, out):
    return sink.read(spark, f"{out}/out", "messages").where("message_type <> 'table-snapshot'")


def test_stream_in_batches_with_restart_equals_batch(spark, store, tmp_path):
    out, values = f"file://{tmp_path}", []
    config = CdcConfig(new_follow_start_point="earliest", max_lsns=100, serializer="avro", partition_count=4)
    keep = type("R", (), {"report": lambda self, v: values.append(v)})()
    assert made(spark, store, out, config, reporters=[batch_reporter([keep], "ns")]).run() == 3
    got = changes_of(spark, out).select("lsn", "command_id", "sub", "operation")
    want = pipeline.published_batch(spark.read.parquet(f"{store}/ct_user"), spark.read.parquet(f"{store}/ltm"), F.lit("t")).select("lsn", "command_id", "sub", "operation")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sum(v["produces_count"] for v in values) == want.count() and {v["metrics_namespace"] for v in values} == {"ns"}
    FileReporter(str(tmp_path / "m.json")).report(values[0])
    assert (tmp_path / "m.json").read_text().startswith("{")
    placed = changes_of(spark, out).groupBy("partition_id").agg(F.count("*").alias("n"), F.max("msg_offset").alias("top"), F.count_distinct("msg_offset").alias("d")).collect()
    assert 1 < len(placed) <= 4 and all(r.n == r.top + 1 == r.d for r in placed)
    assert changes_of(spark, out).groupBy("key").agg(F.count_distinct("partition_id").alias("n")).where("n > 1").isEmpty()
    assert validate.change_regressions(changes_of(spark, out).where("operation IS NOT NULL")).where("regressions > 0").isEmpty()
    # Nothing new: a run from the checkpoint adds nothing, nor does one from recorded progress without it.
    assert made(spark, store, out, config).run() == 3
    made(spark, store, out, config, checkpoint="cp-new").run()
    assert changes_of(spark, out).count() == want.count()


def test_snapshot_pages_resume_and_complete(spark, store, tmp_path):
    out, n = f"file://{tmp_path}", view(spark, SF, "live_user").count()
    config = CdcConfig(new_follow_start_point="latest", snapshot_include="app", snapshot_rows=-(-n // 3), disable_tombstones=True)
    first = made(spark, store, out, config)
    assert first.starts["app_user_cdc"].snapshot == "full"
    first._pages_wanted = 1  # one page, then the run is over
    first.start().awaitTermination()
    again = made(spark, store, out, config)
    assert again.starts["app_user_cdc"].snapshot == "resume"
    again.run()
    rows = sink.read(spark, f"{out}/out", "messages").where("message_type = 'table-snapshot'")
    keys = [r.k for r in rows.select("msg_offset", F.get_json_object(F.col("key").cast("string"), "$.user_id").cast("long").alias("k")).orderBy("msg_offset").collect()]
    assert keys == sorted((r.user_id for r in view(spark, SF, "live_user").collect()), reverse=True)
    assert made(spark, store, out, config).starts["app_user_cdc"].snapshot == "complete"
    assert [r.action for r in sink.read(spark, f"{out}/out", "snapshot_log").orderBy("batch_id", F.desc("action")).collect()] == ["started", "resumed", "completed"]
    assert made(spark, store, out, CdcConfig(run_validations=True, snapshot_include="app")).starts["app_user_cdc"].snapshot == "none"


def test_gaps_and_keyless_snapshots_stop_the_start(spark, store, tmp_path):
    out = f"file://{tmp_path}"
    run = made(spark, store, out, CdcConfig(new_follow_start_point="earliest", max_lsns=10))
    run._pages_wanted = 0
    run.start().awaitTermination()  # ten positions are recorded
    late = TableSpec("app", "user", "app_user_v1", USER.fields, min_lsn=(100).to_bytes(10, "big"))
    with pytest.raises(RuntimeError, match="reach back"):
        made(spark, store, out, CdcConfig(), spec=late)
    assert made(spark, store, out, CdcConfig(lsn_gap_handling="ignore"), spec=late).starts["app_user_cdc"].gap == "ignore"
    assert made(spark, store, out, CdcConfig(report_only=True), spec=late).starts["app_user_cdc"].gap == "raise"
    assert made(spark, store, out, CdcConfig(), spec=late, known_lsn="0x" + "00" * 9 + "05").starts["app_user_cdc"].gap == "proceed at min_lsn"
    again = made(spark, store, out, CdcConfig(lsn_gap_handling="begin_new_snapshot", snapshot_include="app"), spec=late)
    assert again.starts["app_user_cdc"].gap == "begin new snapshot" and again.starts["app_user_cdc"].snapshot == "full"
    keyless = TableSpec("app", "user", "app_user_v1", tuple(FieldSpec(f.name, f.sql_type, f.ordinal) for f in USER.fields))
    with pytest.raises(RuntimeError, match="key"):
        made(spark, store, f"{out}/other", CdcConfig(snapshot_include="app"), spec=keyless)


def test_a_changed_instance_ends_the_run(spark, store, tmp_path):
    decided = spark.createDataFrame([("app", "user", "a", "b", "terminate")], "schema_name string, table_name string, old_instance string, new_instance string, decision string")
    config = CdcConfig(new_follow_start_point="earliest", max_lsns=50, terminate_on_instance_change=True)
    run = made(spark, store, f"file://{tmp_path}", config, watch=pipeline.instance_watch(lambda: decided))
    assert run.run() == 1 and run.ended == "terminate"
    assert pipeline.instance_watch(lambda: decided.withColumn("decision", F.lit("defer")))() == "defer"
    assert pipeline.instance_watch(lambda: decided.where("false"))() == "none"


def test_fields_are_cut_and_topics_combined_by_the_settings(spark, store, tmp_path):
    out = f"file://{tmp_path}"
    config = CdcConfig(new_follow_start_point="earliest", truncate_fields={"APP.user.event_type": 4}, unified_topics={"all": "app"}, table_exclude=None)
    made(spark, store, out, config).run()
    rows = sink.read(spark, f"{out}/out", "messages")
    assert rows.where("operation IS NOT NULL").select(F.max(F.length(F.get_json_object(F.col("value").cast("string"), "$.event_type")))).first()[0] == 4
    assert rows.where("headers['truncated_event_type'] LIKE '%,4'").count() > 0
    own, copies = rows.where("topic = 'app_user_cdc' AND operation IS NOT NULL"), rows.where("topic = 'all'")
    assert own.count() == copies.count() and copies.where("headers['original_topic'] = 'app_user_cdc' AND headers['message_type'] = 'unified-change'").count() == copies.count()
    assert not made(spark, store, out, CdcConfig(table_include="other")).captures


def test_buckets_that_a_batch_does_not_touch_stay(spark, tmp_path):
    out = f"file://{tmp_path}/t"
    schema = "id long, v string, operation int, n long"
    batches = [[(i, "a", 2, i) for i in range(40)], [(3, "b", 4, 100)], [(3, None, 1, 200), (5, "c", 4, 201)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{out}/in")
        streamed.replay_stream(spark.readStream.schema(schema).parquet(f"{out}/in"), f"{out}/out", f"{out}/cp", ["id"], ["id", "v"], F.col("n"), buckets=8).awaitTermination()
        versions = streamed._versions(spark, f"{out}/out")
        assert len(versions) == 8 and 1 <= sum(v == k for v in versions.values()) <= (8, 1, 2)[k]
    got = {r.id: r.v for r in streamed.current_table(spark, f"{out}/out").collect()}
    assert got == {i: "a" for i in range(40) if i != 3} | {5: "c"}


def test_plugins_are_loaded_by_path():
    assert isinstance(plugins.load("changeloom.plugins.JsonCodec"), plugins.JsonCodec) and plugins.load("avro", key_id=7).key_id == 7
    with pytest.raises(ValueError, match="dotted"):
        plugins.load("nothing")


def test_codecs_read_what_they_wrote(spark):
    rows = changes.with_event_time(changes.published(view(spark, SF, "ct_user")), view(spark, SF, "ltm"))
    messages = envelope.with_tombstones(envelope.envelope(rows, USER))
    for name in ("json", "avro"):
        codec = plugins.load(name)
        again = codec.decode(codec.encode(messages, USER), USER, ["sub"])
        got = again.select("sub", "user_id", "event_type", "value", "props")
        want = messages.select("sub", F.col("key.user_id").alias("user_id"), "value.event_type", "value.value", "value.props")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_options_of_connections(spark):
    options = database.jdbc_options("db:1433", "shop", "me", "secret", failover="db2", loginTimeout="5")
    assert options["url"] == "jdbc:sqlserver://db:1433;databaseName=shop;applicationIntent=ReadOnly;encrypt=true;failoverPartner=db2" and options["loginTimeout"] == "5"
    ranges = database.change_ranges("0x" + "00" * 10, "0x" + "00" * 9 + "ff", 4)
    assert len(ranges) == 4 and ranges[0].startswith("__$start_lsn > 0x00000000000000000000 AND") and ranges[-1].endswith("<= 0x000000000000000000ff")
    assert database.change_ranges("0x05", "0x05", 4) == []
    assert database.described(spark.createDataFrame([], "a int, B string"), ["b"]) == [("a", 1, "int", None, True), ("B", 2, "string", 1, True)]
    with pytest.raises(ValueError, match="no column"):
        database.described(spark.createDataFrame([], "a int"), ["z"])
    rows = spark.createDataFrame([("t", b"k", None, 1, {"message_type": "x"})], "topic string, key binary, value binary, partition_id int, headers map<string,string>")
    assert topic_log.broker_rows(rows).first().asDict(recursive=True) == {"topic": "t", "key": b"k", "value": None, "partition": 1, "headers": [{"key": "message_type", "value": b"x"}]}
    with pytest.raises(RuntimeError, match="connector"):
        topic_log.write_broker(rows, "host:1")


def test_clock_is_measured_again():
    import datetime as dt

    now, reads = [1000.0], []

    def read():
        reads.append(1)
        return dt.datetime.fromtimestamp(now[0], dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(seconds=7)

    sync = database.ClockSync(read, 300, lambda: now[0])
    assert sync.microseconds() == 7_000_000 and sync.microseconds() == 7_000_000 and len(reads) == 1
    now[0] += 301
    assert sync.microseconds() == 7_000_000 and len(reads) == 2


def test_a_batch_leaves_no_tables_behind(spark, store, tmp_path):
    from pathlib import Path

    from changeloom.sources.work import cut, scoped, shared_dir

    shared = Path(shared_dir(spark).removeprefix("file://"))
    before = set(shared.iterdir())
    made(spark, store, f"file://{tmp_path}", CdcConfig(new_follow_start_point="earliest", max_lsns=150)).run()
    assert set(shared.iterdir()) == before
    with scoped(spark):
        cut(spark.range(3))
        with scoped(spark):
            cut(spark.range(4))
        assert len(set(shared.iterdir()) - before) == 1
    assert set(shared.iterdir()) == before


def test_topics_to_create():
    config = CdcConfig(partition_count=None, extra_topic_config={"min.insync.replicas": "2"})
    assert config.topic_options(5, 2) == {"partitions": "5", "replication_factor": "2", "cleanup.policy": "compact", "min.insync.replicas": "2"}
    assert config.topic_options(5, 9, progress=True) == {"partitions": "1", "replication_factor": "3", "cleanup.policy": "compact", "segment.bytes": "16777216"}
    assert config.topic_options(5, 9, log=True)["retention.ms"] == "31536000000"


@pytest.mark.parametrize("bucket", [1, 7, 100])
def test_neighbours_across_buckets(spark, bucket):
    bad, full = view(spark, SF, "topic_user_bad").cache(), view(spark, SF, "topic_full").cache()
    for check in (lambda b: validate.missing_offsets(bad, bucket=b), lambda b: validate.change_regressions(bad, bucket=b), lambda b: validate.missing_tombstones(bad, bucket=b), lambda b: validate.snapshot_regressions(full, ["user_id"], bucket=b)):
        assert sorted(map(tuple, check(bucket).collect())) == sorted(map(tuple, check(1 << 40).collect()))


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "4000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_reach_the_scan(spark, tmp_path):
    from changeloom.model import ChangeIndex

    view(spark, SF, "ct_user").write.parquet(f"{tmp_path}/ct")
    view(spark, SF, "ltm").write.parquet(f"{tmp_path}/ltm")
    at = ChangeIndex.of("0x" + "00" * 9 + "10", 1, "0x" + "00" * 10, 0)
    text = plan(changes.scan(spark.read.parquet(f"{tmp_path}/ct"), spark.read.parquet(f"{tmp_path}/ltm"), at, "0x" + "00" * 9 + "40", 100).select("lsn", "user_id", "event_time"))
    assert "GreaterThanOrEqual(lsn,0x00000000000000000010)" in text and "LessThanOrEqual(lsn,0x00000000000000000040)" in text
    assert "TakeOrderedAndProject" in text and "props" not in text.split("ReadSchema")[1].split("\n")[0]
    assert "GreaterThanOrEqual(start_lsn" in text


def test_latest_per_key_reduces_before_the_shuffle(spark, tmp_path):
    view(spark, SF, "topic_user").write.parquet(f"{tmp_path}/t")
    text = plan(replay.latest_per_key(spark.read.parquet(f"{tmp_path}/t"), ["user_id"]))
    assert "partial_max_by" in text and "Window" not in text


def test_nothing_imports_the_training_operators():
    from pathlib import Path

    import changeloom

    home = Path(changeloom.__file__).parent
    assert not [f for f in home.rglob("*.py") if "llm" not in f.parts and "changeloom.llm" in f.read_text()]
