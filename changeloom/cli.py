"""The engine's tools on the command line. A flag's default comes from the environment: `--lsn-map` from CHANGELOOM_LSN_MAP."""

from __future__ import annotations

import argparse
import json
import os
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import changeloom
from changeloom import plugins
from changeloom.config import CdcConfig
from changeloom.model import INDEX_COLUMNS
from changeloom.operators import ops, progress, validate
from changeloom.streaming import pipeline, reporters
from changeloom.streaming import replay as streamed


def _flag(parser: argparse.ArgumentParser, name: str, required: bool = False, **kwargs) -> None:
    found = os.environ.get("CHANGELOOM_" + name.upper().replace("-", "_"))
    default = kwargs.pop("default", None) if found is None else found
    parser.add_argument("--" + name, default=default, required=required and default is None, **kwargs)


def _list(text: str | None) -> list[str]:
    return [x for x in (text or "").split(",") if x]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="changeloom", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    p = sub.add_parser("publish", help="change tables and snapshots to messages and progress")
    for name in ("plan", "lsn-map", "out", "checkpoint"):
        _flag(p, name, True, **({"help": "JSON file with `settings` (of CdcConfig) and `tables`"} if name == "plan" else {}))
    _flag(p, "every", help="go on at this pace, such as '3 seconds'; without it the run ends when all is published")
    _flag(p, "metrics-file", help="keeps the last batch's metrics")
    p.add_argument("--metrics-stdout", action="store_true")
    p.add_argument("--report-only", action="store_true", help="says where each table would start, and publishes nothing")

    p = sub.add_parser("replay", help="a topic's published messages to a table")
    for name in ("plan", "topic", "messages", "out", "checkpoint"):
        _flag(p, name, True)
    _flag(p, "skip", help="columns not to keep up")

    p = sub.add_parser("validate", help="a topic log against its change and source tables; exit code 1 if a rule is broken")
    for name in ("log", "changes", "source", "key"):
        _flag(p, name, True)
    _flag(p, "progress", help="Parquet with topic and the recorded change index")
    _flag(p, "min-lsn", default="0x")

    p = sub.add_parser("compare", help="a topic log with its change table, row by row")
    for name in ("log", "changes", "partition-expression"):
        _flag(p, name, True)

    p = sub.add_parser("progress", help="what a progress log holds, or its anomalies")
    _flag(p, "log", True)
    _flag(p, "topics", help="only these")
    p.add_argument("--anomalies", action="store_true")

    p = sub.add_parser("reset", help="forget a topic's progress; a dry run unless --execute")
    for name in ("log", "topics"):
        _flag(p, name, True)
    _flag(p, "kinds", default="change_rows,snapshot_rows")
    p.add_argument("--execute", action="store_true")

    for command, what in (("history", "snapshots of each topic"), ("truncation", "topics with messages from before their last snapshot")):
        p = sub.add_parser(command, help=what)
        for name in ("log", "watermarks"):
            _flag(p, name, True)
        _flag(p, "topics", help="only these")
        if command == "truncation":
            _flag(p, "bootstrap", help="prints a script for this broker")
    return top


def _plan(path: str, **more) -> tuple[CdcConfig, list[pipeline.Capture]]:
    """Settings and tables from a JSON file."""
    with open(path) as f:
        found = json.load(f)
    settings = found.get("settings", {}) | {k: v for k, v in more.items() if v}
    return CdcConfig(**settings | {"reporters": tuple(settings.get("reporters", ()))}), pipeline.captures_of(found["tables"])


def _of(log: DataFrame, topics: str | None) -> DataFrame:
    return log.where(F.col("topic_name").isin(*_list(topics))) if topics else log


def _rows(df: DataFrame, order: Sequence[str] = ()) -> list[dict]:
    """A report's rows: one for each topic, partition or batch."""
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]


def run(spark: SparkSession, args: argparse.Namespace) -> tuple[list[dict] | str, int]:
    changeloom.ship(spark)
    read = spark.read.parquet
    if args.command == "publish":
        config, captures = _plan(args.plan, report_only=args.report_only)
        told = ([reporters.StdoutReporter()] if args.metrics_stdout else []) + ([reporters.FileReporter(args.metrics_file)] if args.metrics_file else []) + [plugins.load(x) for x in config.reporters]
        report = [reporters.batch_reporter(told, config.metrics_namespace, config)] if told else []
        if told:
            spark.streams.addListener(reporters.ProgressListener(told))
        run_ = pipeline.Pipeline(spark, config, captures, args.lsn_map, args.out, args.checkpoint, report)
        if config.report_only:
            return _rows(run_.report()), 0
        return [{"batches": run_.run(args.every)}], 0
    if args.command == "replay":
        config, captures = _plan(args.plan)
        named = {c.spec.topic: c for c in (pipeline.named(c, config) for c in captures)}
        capture = named[args.topic]
        stream = spark.readStream.schema(read(args.messages).schema).parquet(args.messages)
        rows = pipeline.decoded(stream, capture, plugins.load(config.serializer))
        streamed.replay_stream(rows, args.out, args.checkpoint, capture.spec.key_names, capture.spec.value_names, pipeline.index_order(), _list(args.skip)).awaitTermination()
        table = streamed.current_table(spark, args.out)
        return [{"rows": 0 if table is None else table.count()}], 0
    if args.command == "validate":
        log = read(args.log)
        empty = spark.createDataFrame([], "topic string, lsn string, command_id int, seqval string, operation int")
        recorded = read(args.progress).select("topic", *INDEX_COLUMNS) if args.progress else empty
        found = _rows(validate.table_verdicts(log, _list(args.key), args.min_lsn, read(args.changes), read(args.source), recorded), ["topic"])
        return found, int(any(r["failures"] for r in found))
    if args.command == "compare":
        found = _rows(validate.comparison(read(args.log), read(args.changes), F.expr(args.partition_expression)), ["partition_id"])
        return found, int(any(r["rows"] != r["same"] for r in found))
    if args.command == "progress":
        found = validate.progress_summary(_of(read(args.log), args.topics))
        return _rows(validate.anomalies(found) if args.anomalies else found, ["topic_name"]), 0
    if args.command == "reset":
        log = read(args.log)
        wanted = spark.createDataFrame([(t, k) for t in _list(args.topics) for k in _list(args.kinds)], "topic_name string, progress_kind string")
        plan = progress.reset_plan(wanted, progress.latest(log, ["topic_name", "progress_kind"], "lsn"))
        if args.execute:
            last = log.agg(F.max("msg_offset")).first()[0]
            resets = progress.with_resets(log.limit(0), plan, (last if last is not None else -1) + 1)
            resets.write.mode("append").parquet(args.log)
        return _rows(plan, ["topic_name", "progress_kind"]), 0
    log, marks = _of(read(args.log), args.topics), read(args.watermarks)
    if args.command == "history":
        return _rows(ops.history(log, marks), ["topic_name"]), 0
    report = _rows(ops.truncation(log, marks), ["needs_truncation", "topic_name", "partition_id"])
    if args.bootstrap:
        return ops.truncation_commands([(r["topic_name"], r["partition_id"], r["start_mark"]) for r in report if r["needs_truncation"] == "Yes"], args.bootstrap), 0
    return report, 0


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    found, code = run(SparkSession.builder.appName(f"changeloom {args.command}").getOrCreate(), args)
    if isinstance(found, str):
        print(found)
    for row in found if isinstance(found, list) else []:
        print(json.dumps(row, default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
