from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from changeloom.cli import main, parser
from changeloom.operators import progress
from changeloom.sources.fixtures import view

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    at = f"file://{tmp_path_factory.mktemp('cli')}"
    for name in ("ct_user", "ltm", "topic_full", "topic_user_bad", "live_user", "snapshot_log", "topic_low_watermarks"):
        view(spark, SF, name).write.parquet(f"{at}/{name}")
    view(spark, "/root/testdata/sf0.01", "progress_log").write.parquet(f"{at}/progress_log")
    progress.per_topic(view(spark, SF, "topic_full")).write.parquet(f"{at}/recorded")
    return at


def said(capsys):
    return [json.loads(line) for line in capsys.readouterr().out.splitlines() if line.startswith("{")]


def test_publish_and_replay(spark, home, capsys, tmp_path):
    fields = [{"name": n, "sql_type": k, "ordinal": i} for i, (n, k) in enumerate([("user_id", "bigint"), ("event_type", "varchar"), ("value", "float"), ("props", "nvarchar")], 1)]
    fields[0]["key_ordinal"] = 1
    table = {"schema_name": "app", "table_name": "user", "capture_instance": "app_user", "changes": f"{home}/ct_user", "fields": fields}
    plan = tmp_path / "plan.json"
    plan.write_text(json.dumps({"settings": {"new_follow_start_point": "earliest", "max_lsns": 150, "metrics_namespace": "here"}, "tables": [table]}))
    publish = ["publish", "--plan", str(plan), "--lsn-map", f"{home}/ltm", "--out", f"{home}/out", "--checkpoint", f"{home}/cp"]
    assert main([*publish, "--report-only"]) == 0
    assert [(x["topic"], x["gap"], x["snapshot"]) for x in said(capsys)] == [("app_user_cdc", "no gap", "none")]
    assert main([*publish, "--metrics-stdout"]) == 0
    lines = said(capsys)
    assert lines[-1] == {"batches": 2} and sum(x.get("produces_count", 0) for x in lines) > 0 and {x.get("metrics_namespace") for x in lines} >= {"here"}
    assert main(["replay", "--plan", str(plan), "--topic", "app_user_cdc", "--messages", f"{home}/out/messages/batch_id=*", "--out", f"{home}/table", "--checkpoint", f"{home}/cp2", "--skip", "EVENT_TYPE"]) == 0
    assert said(capsys)[-1] == {"rows": view(spark, SF, "live_user").count()}


def test_validate(home, capsys):
    base = ["validate", "--changes", f"{home}/ct_user", "--source", f"{home}/live_user", "--key", "user_id", "--progress", f"{home}/recorded"]
    main([*base, "--log", f"{home}/topic_full"])
    clean = said(capsys)[0]
    assert not {"deletes", "inserts", "updates", "index_order", "tombstones", "progress_differs"} & set(clean["failures"].split(","))
    assert main([*base, "--log", f"{home}/topic_user_bad"]) == 1
    assert "index_order" in said(capsys)[0]["failures"]
    assert main(["compare", "--log", f"{home}/topic_user_bad", "--changes", f"{home}/ct_user", "--partition-expression", "cast(user_id % 3 as int)"]) == 1


def test_progress_and_reset(spark, home, capsys):
    assert main(["progress", "--log", f"{home}/progress_log", "--anomalies"]) == 0
    assert said(capsys)[0]["problems"] == 2
    reset = ["reset", "--log", f"{home}/progress_log", "--topics", "app_user_state_cdc,other"]
    main(reset)
    assert [x["action"] for x in said(capsys)] == ["reset", "no progress", "no progress", "no progress"]
    before = spark.read.parquet(f"{home}/progress_log").count()
    main([*reset, "--execute"])
    after = spark.read.parquet(f"{home}/progress_log")
    assert after.count() == before + 1
    assert progress.latest(after, ["topic_name", "progress_kind"], "lsn").where(F.col("progress_kind") == "change_rows").isEmpty()


def test_reports(home, capsys):
    main(["truncation", "--log", f"{home}/snapshot_log", "--watermarks", f"{home}/topic_low_watermarks"])
    assert {x["topic_name"]: x["needs_truncation"] for x in said(capsys)} == {"t1": "No", "t2": "Yes", "t3": "!NOT COMPLETE!"}
    main(["truncation", "--log", f"{home}/snapshot_log", "--watermarks", f"{home}/topic_low_watermarks", "--bootstrap", "host:1"])
    assert '"offset":500' in capsys.readouterr().out
    main(["history", "--log", f"{home}/snapshot_log", "--watermarks", f"{home}/topic_low_watermarks"])
    assert [x["complete"] for x in said(capsys)] == [True, True, False]
    main(["history", "--log", f"{home}/snapshot_log", "--watermarks", f"{home}/topic_low_watermarks", "--topics", "t2"])
    assert [x["topic_name"] for x in said(capsys)] == ["t2"]


def test_defaults_come_from_the_environment(monkeypatch):
    monkeypatch.setenv("CHANGELOOM_LOG", "here")
    assert parser().parse_args(["progress"]).log == "here"
    monkeypatch.delenv("CHANGELOOM_LOG")
    with pytest.raises(SystemExit):
        parser().parse_args(["progress"])
