"""k-means goldens and properties."""

import numpy as np
import pytest

from tessera.operators import cluster as cl


def _pts(spark, x):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], "x double, y double")


def test_find_closest_golden(spark):
    x = [[-1, -1], [-1.5, -1.5], [-1.5, -1], [2, 2], [2.5, 2.5], [2, 2.5]]
    got = [r.cluster for r in cl.assign(_pts(spark, x), ["x", "y"], [[-1, -1], [2, 2]]).collect()]
    assert got == [0, 0, 0, 1, 1, 1]


def test_ties_go_to_lowest_index(spark):
    got = cl.assign(_pts(spark, [[0, 0]]), ["x", "y"], [[1, 0], [-1, 0], [0, 1]]).first().cluster
    assert got == 0


@pytest.mark.parametrize("x,idx,k,want", [
    ([[-1, -1], [-1.5, -1.5], [-1.5, 1], [-1, 1.5], [2.5, 1.5], [-1.1, -1.7], [-1.6, 1.2]], [1, 1, 1, 0, 0, 0, 2], 3,
     [[0.13333333, 0.43333333], [-1.33333333, -0.5], [-1.6, 1.2]]),
    ([[2, 2.5], [2.5, 2.5], [-1.5, -1.5], [2, 2], [-1.5, -1], [-1, -1]], [0, 0, 1, 0, 1, 1], 2,
     [[2.16666667, 2.33333333], [-1.33333333, -1.16666667]]),
])
def test_compute_centroids_golden(spark, x, idx, k, want):
    df = spark.createDataFrame([(float(a), float(b), int(c)) for (a, b), c in zip(x, idx)], "x double, y double, cluster int")
    assert np.allclose(cl.compute_centroids(df, ["x", "y"], k), want)


def test_empty_cluster_keeps_previous(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0)], "x double, y double, cluster int")
    out = cl.compute_centroids(df, ["x", "y"], 2, previous=[[9.0, 9.0], [5.0, 5.0]])
    assert np.allclose(out, [[0.0, 0.0], [5.0, 5.0]])


def _lloyd(x, c, iters):
    c = np.array(c, dtype=float)
    for _ in range(iters):
        d = ((x[:, None, :] - c[None]) ** 2).sum(-1)
        a = d.argmin(1)
        for k in range(len(c)):
            if np.any(a == k):
                c[k] = x[a == k].mean(0)
    return c


def test_lloyd_equals_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(m, 0.3, (100, 2)) for m in ([0, 0], [3, 3], [0, 3])])
    df = _pts(spark, x).repartition(3)
    init = x[[0, 1, 2]]
    got, hist = cl.run_kmeans(df, ["x", "y"], init, 10)
    assert len(hist) == 10 and np.allclose(got, _lloyd(x, init, 10))


def test_vectorised_assignment_matches_expression(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 40))
    cols = [f"c{i}" for i in range(40)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], cols)
    cents = rng.normal(size=(8, 40))  # 320 terms: the pandas UDF path
    got = [r.cluster for r in cl.assign(df, cols, cents).collect()]
    want = ((x[:, None, :] - cents[None]) ** 2).sum(-1).argmin(1)
    assert got == list(want)


def test_init_is_deterministic_and_distinct(spark):
    df = spark.range(100).selectExpr("id", "cast(id as double) as x", "cast(id * 2 as double) as y")
    a = cl.init_centroids(df, ["x", "y"], 5, "id", seed=3)
    b = cl.init_centroids(df.repartition(4), ["x", "y"], 5, "id", seed=3)
    assert np.array_equal(a, b) and len({tuple(r) for r in a}) == 5


def test_nearest_of_a_missing_coordinate_is_null_in_both_forms(spark, monkeypatch):
    from tessera.operators import cluster as cl
    df = spark.createDataFrame([(1, 0.9, 1.0), (2, None, 1.0)], "id int, x double, y double")
    for terms in (256, 0):
        monkeypatch.setattr(cl, "MAX_EXPR_TERMS", terms)
        got = {r.id: r.cluster for r in cl.assign(df, ["x", "y"], [[0.0, 0.0], [1.0, 1.0]]).collect()}
        assert got == {1: 1, 2: None}
