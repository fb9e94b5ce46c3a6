"""Every registered query of the change-data engine gives the rows of its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from changeloom.plans.registry import ORACLES, QUERIES
from changeloom.sources.fixtures import BASE_TABLES

SF = Path("/root/testdata/sf0.01")


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_each_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=str)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in cur.fetchall()), key=str)
    assert got == want
    assert got
