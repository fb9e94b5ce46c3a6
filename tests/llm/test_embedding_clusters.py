"""Near-duplicate vectors where signs of projections split badly: dense clusters without links, and tiles."""

from __future__ import annotations

import numpy as np

from changeloom.llm import embedding_dedup
from changeloom.llm.common import Workspace


def unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def partner(x, cosine, rng):
    """A vector at this cosine from x, in a random direction."""
    side = rng.standard_normal(x.shape)
    side = unit(side - (side * x).sum(1, keepdims=True) * x)
    return cosine * x + (1 - cosine**2) ** 0.5 * side


def frame(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")


def test_pairs_inside_a_cluster_without_links(spark):
    rng = np.random.default_rng(5)
    middle = unit(rng.standard_normal(64))
    own = rng.standard_normal((4000, 64))
    cluster = 0.8**0.5 * middle + 0.2**0.5 * unit(own - (own @ middle)[:, None] * middle)
    x = np.concatenate([unit(rng.standard_normal((7400, 64))), cluster])
    # Partners that lie in the cluster too: what is not the middle has cosine (0.905 - 0.8) / 0.2 to the other's.
    rest = unit(cluster[:300] - (cluster[:300] @ middle)[:, None] * middle)
    other = partner(rest, 0.105 / 0.2, rng)
    other = unit(other - (other @ middle)[:, None] * middle)
    x = np.concatenate([x, 0.8**0.5 * middle + 0.2**0.5 * other, partner(x[:300], 0.905, rng)])
    link = unit(x) @ unit(x).T >= 0.9
    np.fill_diagonal(link, False)
    got = embedding_dedup.near_vectors(frame(spark, x), window=32).toPandas().sort_values("vec_id")
    crowd = np.r_[np.zeros(7400, bool), np.ones(4300, bool), np.zeros(300, bool)]
    assert link[crowd].sum() > 400 and link[~crowd].sum() >= 500
    assert (got.n_links.to_numpy() == link.sum(1))[crowd].all()
    assert got.n_links[~crowd].sum() >= 0.99 * link[~crowd].sum()


def exact(x):
    """(links of each vector, smallest vector reachable), by all pairs."""
    link = unit(x) @ unit(x).T >= 0.9
    np.fill_diagonal(link, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(link, root[None, :], len(x)).min(1))
        if (new == root).all():
            return link.sum(1), root
        root = new


def test_vectors_that_share_a_component(spark):
    """Random pairs at cosine 0.8, as of texts' embeddings, and partners just over the threshold."""
    rng = np.random.default_rng(11)
    middle = unit(rng.standard_normal(96))
    own = rng.standard_normal((6000, 96))
    own = unit(own - (own @ middle)[:, None] * middle)
    other = partner(own[:600], 0.51, rng)
    other = unit(other - (other @ middle)[:, None] * middle)
    x = 0.8**0.5 * middle + 0.2**0.5 * np.concatenate([own, other])
    n, root = exact(x)
    got = embedding_dedup.near_vectors(frame(spark, x), window=64).toPandas().sort_values("vec_id")
    assert n.sum() > 900 and got.n_links.sum() >= 0.99 * n.sum() and (got.component_id.to_numpy() == root).mean() > 0.99


def test_border_of_a_dense_group(spark):
    """A clump whose members mostly link, and vectors that reach only its border; single precision is kept."""
    rng = np.random.default_rng(12)
    middle = unit(rng.standard_normal(32))
    clump = unit(middle + 0.045 * rng.standard_normal((900, 32)))
    border = partner(clump[:200], 0.901, rng)
    x = np.concatenate([unit(rng.standard_normal((1500, 32))), clump, border]).astype(np.float32).astype(np.float64)
    n, root = exact(x)
    rows = frame(spark, x).selectExpr("vec_id", "cast(embedding AS array<float>) embedding", "1 AS node", "2 AS KEY", "3 AS pass")
    got = embedding_dedup.near_vectors(rows, window=64).toPandas().sort_values("vec_id")
    assert got.n_links.sum() >= 0.99 * n.sum() and (got.component_id.to_numpy() == root).mean() > 0.99


def test_one_pass_compares_a_small_table_whole(spark):
    rng = np.random.default_rng(13)
    x = unit(rng.standard_normal((300, 4)))
    x[:2] = [[1, 0, 0, 0], [9, 3, 3, 1]]  # a tie at the threshold
    n, root = exact(x)
    assert unit(x)[0] @ unit(x)[1] == 0.9
    got = embedding_dedup.near_vectors(frame(spark, x)).toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() == n).all() and (got.component_id.to_numpy() == root).all()


def test_tiles_meet_all_links(spark):
    rng = np.random.default_rng(6)
    middles = unit(rng.standard_normal((6, 16)))
    x = unit(np.repeat(middles, 200, 0) + 0.12 * rng.standard_normal((1200, 16)))
    vectors = spark.createDataFrame([(i.to_bytes(4, "big"), r.tobytes()) for i, r in enumerate(x)], "node binary, vec binary")
    found = embedding_dedup._all_links(Workspace(spark, "test"), vectors, "<f8", 0.9, size=100).collect()

    def groups(pairs):
        up = list(range(len(x)))

        def find(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for a, b in pairs:
            up[max(find(a), find(b))] = min(find(a), find(b))
        return [find(i) for i in range(len(x))]

    true = np.argwhere(np.triu(x @ x.T >= 0.9, 1))
    assert 6 <= len(set(groups(true))) < 1100
    assert groups((int.from_bytes(r.a, "big"), int.from_bytes(r.b, "big")) for r in found) == groups(true)
