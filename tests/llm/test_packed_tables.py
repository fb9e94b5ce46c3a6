"""Tables of large binaries are written in small row groups, so no task holds a whole file of them, and in few files."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow.parquet as pq

from changeloom.llm import common, lm_scoring


def test_row_groups_of_lm_tables_are_small(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"{w:x}" for w in rng.integers(0, 1 << 24, 60_000)) for _ in range(28)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(common.Workspace, "remove", lambda ws, path: None)
    made = []
    table = common.Workspace.table
    monkeypatch.setattr(common.Workspace, "table", lambda ws, *a, **k: made.append(table(ws, *a, **k)) or made[-1])
    got = lm_scoring.lm_scores(spark.read.parquet(f"{tmp_path}/docs"), block_bytes=1 << 20)
    assert got.count() == len(texts)

    files = [f for df in made[:-1] for f in Path(df._work_path.removeprefix("file://")).glob("*.parquet")]
    groups = [g.row_group(i).total_byte_size for g in (pq.ParquetFile(f).metadata for f in files) for i in range(g.num_row_groups)]
    assert sum(groups) > 3 * common.GROUP_BYTES  # so one row group a file would be larger
    assert max(groups) <= 2 * common.GROUP_BYTES


def test_many_small_parts_make_few_files_without_checksums(spark, tmp_path, monkeypatch):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('one two ', id) AS text").repartition(100)
    docs.write.parquet(f"{tmp_path}/docs")
    made = []
    table = common.Workspace.table
    monkeypatch.setattr(common.Workspace, "table", lambda ws, *a, **k: made.append((table(ws, *a, **k), a[1])) or made[-1][0])
    monkeypatch.setattr(common.Workspace, "remove", lambda ws, path: None)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))  # so each file is a partition
    try:
        assert lm_scoring.lm_scores(spark.read.parquet(f"{tmp_path}/docs")).count() == 400
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    most = 2 * spark.sparkContext.defaultParallelism
    assert {name: n for df, name in made if (n := len(df.inputFiles())) > most} == {}
    assert not [f for df, _ in made for f in Path(df._work_path.removeprefix("file://")).glob("*part*.crc")]
