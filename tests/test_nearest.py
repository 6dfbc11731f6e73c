"""Exact nearest items: equal to brute force, with ties, copies and hot groups; far blocks are skipped."""

import numpy as np
import pytest

from tessera.operators import nearest
from tessera.operators.nearest import nearest_items


def brute(ids, x):
    out = {}
    for i, a in zip(ids, x):
        d = np.zeros(len(x))
        for j in range(x.shape[1]):
            d += (a[j] - x[:, j]) ** 2
        best = min(((dist, o) for dist, o in zip(d, ids) if o != i), default=None)
        if best:
            out[i] = (best[1], best[0])
    return out


def run(spark, ids, x, **kw):
    names = [f"c{j}" for j in range(x.shape[1])]
    df = spark.createDataFrame([(int(i), *map(float, v)) for i, v in zip(ids, x)], "id long, " + ", ".join(f"{c} double" for c in names))
    got = nearest_items(df.repartition(3), "id", names, **kw).collect()
    assert len(got) == len({r.id for r in got})
    return {r.id: (r.nearest_id, r.sq_dist) for r in got}


@pytest.mark.parametrize("block", [8, 64, 1000])
def test_equals_brute_force_with_ties_and_copies(spark, block):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(0, 6, (150, 3)), np.tile([[2, 2, 2]], (90, 1)), rng.normal(size=(60, 3))]).astype(float)
    ids = rng.permutation(len(x)) * 7
    assert run(spark, ids, x, block_rows=block, pivots=5) == brute(ids, x)


def test_far_blocks_are_skipped(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 4)) * 100
    x = np.concatenate([c + rng.normal(size=(60, 4)) for c in centres])
    visits = []
    assert run(spark, range(len(x)), x, block_rows=20, pivots=12, visits=visits) == brute(range(len(x)), x)
    assert visits[0][0] < 0.25 * visits[0][1]  # rows sent abroad, of those that visiting every block would send


def test_small_inputs(spark):
    one = np.array([[1.0, 2.0]])
    assert run(spark, [5], one) == {}
    assert run(spark, [5, 9, 7], np.repeat(one, 3, axis=0)) == {5: (7, 0.0), 7: (5, 0.0), 9: (5, 0.0)}
    df = spark.createDataFrame([(1, 0.0), (2, None), (3, 4.0)], "id long, c0 double")
    assert {r.id: r.nearest_id for r in nearest_items(df, "id", ["c0"]).collect()} == {1: 3, 3: 1}
    assert nearest_items(df.where("id > 9"), "id", ["c0"]).count() == 0


def test_best_is_exact_where_a_product_rounds(monkeypatch):
    """Vectors far from the origin: the product form loses the small distances, the result must not; and distances
    of all pairs are not summed coordinate by coordinate."""
    rng = np.random.default_rng(9)
    for shift, dims in ((0.0, 64), (1e8, 3), (1e200, 2)):
        vecs = shift + rng.integers(0, 6, (300, dims)).astype(float) * (0.25 if shift < 1e100 else 1e190)
        ids = rng.permutation(300).astype(np.int64)
        d = nearest.squared(vecs, vecs)
        np.fill_diagonal(d, np.inf)
        want = [(ids[d[i] == d[i].min()].min() if np.isfinite(d[i]).any() else None, d[i].min()) for i in range(300)]
        if shift < 1e100:
            monkeypatch.setattr(nearest, "squared", None)
        nn, dist = nearest._best(ids, vecs, ids, vecs)
        monkeypatch.undo()
        assert all((n, x) == w for (n, x), w in zip(zip(nn, dist), want) if w[0] is not None)
