"""Members of a bucket in different components meet once, and rows of linked members aren't dealt over each other's tiles."""

from __future__ import annotations

from collections import Counter

import pytest

from changeloom.llm import minhash_dedup

SIZE = 64
ROOTS = {1: [0] * 600 + list(range(1, 31)), 2: [0] * 20 + [1] * 9 + [2], 3: list(range(300)), 4: [7] * 200 + [8] * 200, 5: [3] * 150, 6: [1, 1]}


@pytest.fixture(scope="module")
def dealt(spark):
    rows = [(b, b * 10_000 + k, b * 10_000 + root) for b, roots in ROOTS.items() for k, root in enumerate(roots)]
    members = spark.createDataFrame(rows, "bucket long, rep long, root long")
    return minhash_dedup._dealt(members, [], SIZE, len(rows)).collect()


def test_each_pair_of_components_meets_once(dealt):
    met, tiles = Counter(), {}
    for r in dealt:
        tiles.setdefault((r.group, r.bucket, r.t1, r.t2), []).append(r)
    for tile in tiles.values():
        left, right = [r for r in tile if r.side <= 0], [r for r in tile if r.side >= 0]
        met.update((min(a.rep, b.rep), max(a.rep, b.rep)) for a in left for b in right if a.root != b.root and (a.side != b.side or b.rep > a.rep))
    want = {(b * 10_000 + i, b * 10_000 + k) for b, roots in ROOTS.items() for k in range(len(roots)) for i in range(k) if roots[i] != roots[k]}
    assert set(met) == want and set(met.values()) == {1}


def test_rows_of_the_largest_component_follow_the_others(dealt):
    rows = Counter(r.bucket for r in dealt)
    assert rows[1] <= 600 + 30 * (10 + 1)  # 10 tiles of linked members, one of others; all with all would be 6300 rows
    assert rows[2] == 30
    assert rows[3] <= 300 * 6
    assert rows[4] <= 400 * (4 + 4)
    assert rows[5] == rows[6] == 0


def test_many_tiles_grow(spark):
    members = spark.range(4096).selectExpr("1L AS bucket", "id AS rep", "id AS root")
    assert minhash_dedup._dealt(members, [], SIZE, 4096, 16).count() <= 4096 * 33  # 64 tiles without the bound
