"""Lattice hashing: nearest lattice points, recall against brute force, large groups."""

import numpy as np
import pytest

from corvid.llm import lattice


def brute(ids, x, cosine=0.95):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= cosine
    np.fill_diagonal(near, False)
    comp = list(range(len(x)))
    for i in range(len(x)):
        todo = [i] if comp[i] == i else []
        while todo:
            for k in np.flatnonzero(near[todo.pop()]).tolist():
                if comp[k] > i:
                    comp[k] = i
                    todo.append(k)
    return {ids[i]: (int(near[i].sum()), ids[comp[i]]) for i in range(len(x))}


def test_minimal_vectors_and_nearest_points():
    assert lattice.MINIMAL.shape == (240, 8) and np.allclose((lattice.MINIMAL ** 2).sum(axis=1), 2)
    x = np.random.default_rng(2).normal(scale=3, size=(500, 8))
    point = lattice.nearest_e8(x)
    own = ((x - point) ** 2).sum(axis=1)
    for v in lattice.MINIMAL:  # no neighbour is nearer
        assert (own <= ((x - point - v) ** 2).sum(axis=1) + 1e-9).all()
    assert (own <= 1 + 1e-9).all()  # the covering radius


def test_embeddings(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.toPandas().sort_values("vec_id")
    want = brute(rows.vec_id.tolist(), np.stack(rows.embedding).astype(float))
    got = {r.vec_id: r for r in lattice.near_duplicates(df).collect()}
    links = sum(n for n, _ in want.values())
    assert sum(r.n_links for r in got.values()) >= 0.99 * links
    assert all(r.n_links <= want[i][0] and r.kept == (r.component_id == i) for i, r in got.items())


@pytest.mark.parametrize("block_rows", [16, 512])
def test_recall_at_the_threshold_and_hot_groups(spark, block_rows):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 64))
    shift = rng.normal(size=x.shape)
    shift -= (shift * x).sum(axis=1, keepdims=True) * x / (x * x).sum(axis=1, keepdims=True)
    shift *= np.linalg.norm(x, axis=1, keepdims=True) / np.linalg.norm(shift, axis=1, keepdims=True)
    y = 0.955 * x + np.sqrt(1 - 0.955 ** 2) * shift
    hot = x[0] + 0.01 * rng.normal(size=(200, 64))
    same = np.repeat(x[1:2], 100, axis=0)
    every = np.concatenate([x, y, hot, same, 3 * x[2:3]])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    want = brute(list(range(len(every))), every)
    got = {r.vec_id: r for r in lattice.near_duplicates(df, block_rows=block_rows).collect()}
    planted = [i for i in range(3, 300) if want[i + 300][0] == 1]
    assert len(planted) > 250 and np.mean([got[i + 300].n_links for i in planted]) >= 0.9
    for i in list(range(600, 900)):
        assert got[i].component_id == want[i][1]
        assert got[i].n_links >= want[i][0] - 1


def _pairs_at(cosine, n, dims, seed):
    """n random vectors and for each another one at exactly (to 1e-12 above) that cosine."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shift = rng.normal(size=x.shape)
    shift -= (shift * x).sum(axis=1, keepdims=True) * x
    shift /= np.linalg.norm(shift, axis=1, keepdims=True)
    cosine += 1e-12
    return np.concatenate([x, cosine * x + np.sqrt(1 - cosine ** 2) * shift])


def test_planted_pairs_of_several_lengths(spark):
    """Pairs at cosine 0.95 and nothing else, in three lengths at once; links stay within a length."""
    sets = {dims: _pairs_at(0.95, 400, dims, dims) for dims in (16, 64, 200)}
    rows = [(1000 * k + i, v.tolist()) for k, x in enumerate(sets.values()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    got = {r.vec_id: r for r in lattice.near_duplicates(df).collect()}
    for k, x in enumerate(sets.values()):
        want = brute([1000 * k + i for i in range(len(x))], x)
        pairs = [(1000 * k + i, 1000 * k + i + 400) for i in range(400)]
        found = [got[a].component_id == got[b].component_id for a, b in pairs]
        assert np.mean(found) >= 0.95
        assert all(got[i].n_links <= n for i, (n, _) in want.items())
        assert all(got[i].component_id // 1000 == k for i in want)


def test_odd_vectors(spark):
    v, nan, inf = [1.0] + [0.0] * 7, float("nan"), float("inf")
    rows = [(1, v, 9), (2, [2.0] + [0.0] * 7, 9), (2, v, 9), (3, None, 9), (4, [0.0] * 8, 9), (5, [nan] + v[1:], 9), (6, [inf] + v[1:], 9),
            (7, [None] + v[1:], 9), (8, [], 9), (9, [1.0, 2.0], 9), (None, [-0.0, 1.0] + v[2:], 9), (11, [1e200] + v[1:], 9),
            (12, [2.0, 4.0], 9), (13, [1.0, 2.1], 9), (14, [-1.0, -2.0], 9), (15, [3.0], 9), (16, [1e-300], 9), (17, [-1.0], 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int")
    got = sorted(map(tuple, lattice.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 3, 1, True), (2, 3, 1, False), (2, 3, 1, False), (11, 3, 1, False), (None, 0, None, True),
                          (9, 2, 9, True), (12, 2, 9, False), (13, 2, 9, False), (14, 0, 14, True),
                          (15, 1, 15, True), (16, 1, 15, False), (17, 0, 17, True)]
                         + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8)], key=str)
    assert lattice.near_duplicates(df.limit(0)).count() == 0
