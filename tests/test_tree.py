"""Decision-tree goldens (mushroom example) and a brute-force comparison."""

import math

import numpy as np
import pytest

from tessera.operators import tree as tr

# The mushroom example (brown cap, tapering stalk, solitary -> edible).
MUSH_X = [[1, 1, 1], [1, 0, 1], [1, 0, 0], [1, 0, 0], [1, 1, 1], [0, 1, 1], [0, 0, 0], [1, 0, 1], [0, 1, 0], [1, 0, 0]]
MUSH_Y = [1, 1, 0, 0, 1, 0, 0, 1, 1, 0]
FEATS = ["brown_cap", "tapering_stalk", "solitary"]


@pytest.fixture(scope="module")
def mush(spark):
    return spark.createDataFrame([tuple(r) + (y,) for r, y in zip(MUSH_X, MUSH_Y)], FEATS + ["y"])


def test_entropy_golden():
    assert tr.entropy(6 / 9) == pytest.approx(0.918295, abs=1e-6)
    assert tr.entropy(0.5) == 1.0 and tr.entropy(0.0) == 0.0 and tr.entropy(1.0) == 0.0


def test_root_gains_golden(mush):
    g = tr.root_gains(mush, FEATS, "y")
    assert g == pytest.approx([0.03485155, 0.12451125, 0.27807191], abs=1e-8)
    assert tr.best_split(g) == 2


def test_pure_node_has_no_split():
    assert tr.best_split([0.0, 0.0]) == -1
    assert tr.information_gain(4, 4, 2, 2) == 0.0


def _brute(x, y, idx, depth, max_depth, node, out):
    n, n1 = len(idx), int(sum(y[i] for i in idx))
    if depth == max_depth:
        out.append((node, depth, -1, n, n1))
        return
    gains = []
    for f in range(x.shape[1]):
        left = [i for i in idx if x[i, f] == 1]
        gains.append(tr.information_gain(n, n1, len(left), int(sum(y[i] for i in left))))
    b = tr.best_split(gains)
    out.append((node, depth, b, n, n1))
    if b < 0:
        return
    _brute(x, y, [i for i in idx if x[i, b] == 1], depth + 1, max_depth, 2 * node, out)
    _brute(x, y, [i for i in idx if x[i, b] != 1], depth + 1, max_depth, 2 * node + 1, out)


def test_levelwise_equals_recursive(spark, mush):
    got = sorted((r.node_id, r.depth, r.feature, r.n, r.n_pos) for r in tr.build_tree(mush, FEATS, "y", 2).collect())
    want = []
    _brute(np.array(MUSH_X), MUSH_Y, list(range(10)), 0, 2, 1, want)
    assert got == sorted(want)


def test_levelwise_random(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2, size=(300, 4))
    y = ((x[:, 0] ^ x[:, 2]) | (rng.random(300) < 0.1)).astype(int)
    cols = [f"f{i}" for i in range(4)]
    df = spark.createDataFrame([tuple(map(int, r)) + (int(t),) for r, t in zip(x, y)], cols + ["y"])
    got = sorted((r.node_id, r.depth, r.feature, r.n, r.n_pos) for r in tr.build_tree(df.repartition(3), cols, "y", 3).collect())
    want = []
    _brute(x, list(y), list(range(300)), 0, 3, 1, want)
    assert got == sorted(want)
    assert not math.isnan(sum(r[3] for r in got))


def test_many_features_and_missing_values(spark):
    """Two hundred features, of which a hidden one decides; a NULL feature counts as 0."""
    rng = np.random.default_rng(8)
    x = rng.integers(0, 2, size=(150, 200))
    cols = [f"f{i}" for i in range(200)]
    rows = [tuple(None if v == 0 and i % 3 == 0 else int(v) for v in r) + (int(r[123]),) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in [*cols, "y"]))
    got = {r.node_id: r for r in tr.build_tree(df, cols, "y", 4).collect()}
    assert got[1].feature == 123 and set(got) == {1, 2, 3} and got[2].n_pos == got[2].n and got[3].n_pos == 0
    assert tr.build_tree(df.where("f0 > 5"), cols, "y", 2).count() == 0


def _plain_boost(x, y, vx, vy, rounds, step, depth, patience, lam=1.0, min_child=1.0):
    score, vscore, out, best = np.zeros(len(y)), np.zeros(len(vy)), [], (math.inf, 0)

    def loss(s, t):
        return float(np.mean(np.maximum(s, 0) - s * t + np.log1p(np.exp(-np.abs(s)))))

    for r in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)

        def grow(idx, vidx, d):
            G, H = g[idx].sum(), h[idx].sum()
            top, pick = 0.0, None
            if d < depth:
                for j in range(x.shape[1]):
                    l = idx[x[idx, j] == 1]
                    gl, hl = g[l].sum(), h[l].sum()
                    if hl < min_child or H - hl < min_child:
                        continue
                    v = 0.5 * (gl ** 2 / (hl + lam) + (G - gl) ** 2 / (H - hl + lam) - G ** 2 / (H + lam))
                    if v > top + 1e-12:
                        top, pick = v, j
            if pick is None:
                score[idx] += -step * G / (H + lam)
                vscore[vidx] += -step * G / (H + lam)
                return
            for side in (1, 0):
                grow(idx[x[idx, pick] == side], vidx[vx[vidx, pick] == side], d + 1)

        grow(np.arange(len(y)), np.arange(len(vy)), 0)
        out.append((r, loss(score, y), loss(vscore, vy)))
        if out[-1][2] < best[0]:
            best = (out[-1][2], r)
        if r - best[1] >= patience:
            break
    return out, vscore


def test_boosting_equals_plain_booster(spark):
    rng = np.random.default_rng(9)
    x = rng.integers(0, 2, size=(400, 5))
    y = ((x[:, 0] & x[:, 2]) ^ (rng.random(400) < 0.25)).astype(int)
    cols = [f"f{i}" for i in range(5)]
    df = spark.createDataFrame([(*map(int, r), int(t), i) for i, (r, t) in enumerate(zip(x, y))], [*cols, "y", "id"])
    train, valid = df.where("id < 280"), df.where("id >= 280")
    history, trees = tr.boost(train, valid, cols, "y", rounds=12, step=0.5, max_depth=2, patience=2)
    want, _ = _plain_boost(x[:280], y[:280], x[280:], y[280:], 12, 0.5, 2, 2)
    assert len(history) == len(want) < 12  # stopped early
    assert np.allclose(history, want, rtol=1e-10)
    best = min(history, key=lambda h: (h[2], h[0]))[0]
    got = tr.boost_scores(valid, cols, trees, best, 2).orderBy("id").toPandas()["score"]
    _, vscore = _plain_boost(x[:280], y[:280], x[280:], y[280:], best, 0.5, 2, 99)
    assert np.allclose(got, vscore, rtol=1e-10)


def test_depth_split_grid_matches_plain_trees(spark):
    rng = np.random.default_rng(12)
    x = rng.integers(0, 2, size=(300, 4))
    y = ((x[:, 1] | x[:, 3]) ^ (rng.random(300) < 0.2)).astype(int)
    cols = [f"f{i}" for i in range(4)]
    df = spark.createDataFrame([(*map(int, r), int(t), i) for i, (r, t) in enumerate(zip(x, y))], [*cols, "y", "id"])
    got = tr.depth_split_grid(df.where("id < 200"), df.where("id >= 200"), cols, "y", [1, 2, 3], [2, 60])

    def right(idx, vidx, d, least):
        n1 = int(y[idx].sum())
        gains = [tr.information_gain(len(idx), n1, int((x[idx, f] == 1).sum()), int(y[idx][x[idx, f] == 1].sum())) for f in range(4)]
        b = tr.best_split([g if len(idx) >= least else 0.0 for g in gains])
        if d == 0 or b < 0:
            yes = int(2 * n1 > len(idx))
            return (y[idx] == yes).sum(), (y[vidx] == yes).sum()
        parts = [right(idx[x[idx, b] == s], vidx[x[vidx, b] == s], d - 1, least) for s in (1, 0)]
        return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]

    for depth, least, a, b in got:
        want = right(np.arange(200), np.arange(200, 300), depth, least)
        assert (a, b) == pytest.approx((want[0] / 200, want[1] / 100))


def test_param_sweep_fits_binned_patterns_like_all_rows(spark, monkeypatch):
    """every setting is fitted on distinct bins, not on rows, with the trees of all rows; a child needs its least rows."""
    from pyspark.ml.classification import DecisionTreeClassifier
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.integers(0, 6, 4000), np.exp(rng.normal(size=4000)), rng.integers(-2, 1, 4000)])
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 1.3) ^ (rng.random(4000) < 0.1)).astype(int)
    df = spark.createDataFrame([(*map(float, r), int(t), i) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, c double, y int, i int")
    train, test, feats = df.where("i % 4 > 0"), df.where("i % 4 = 0"), ["a", "b", "c"]
    want = []
    for depth in (1, 5):
        for least in (1, 40, 1600):
            model = DecisionTreeClassifier(featuresCol="_features", labelCol="y", maxDepth=depth, minInstancesPerNode=least,
                                           seed=55).fit(tr._assemble(train, feats, "y"))
            want.append((depth, least, tr.accuracy(model, train, feats, "y"), tr.accuracy(model, test, feats, "y")))
    sizes, fit = [], DecisionTreeClassifier._fit
    monkeypatch.setattr(DecisionTreeClassifier, "_fit", lambda self, data: (sizes.append(data.count()), fit(self, data))[1])
    got = tr.param_sweep(train, test, feats, "y", (1, 5), (1, 40, 1600))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [v for g in got for v in g[2:]] == pytest.approx([v for w in want for v in w[2:]], abs=1e-12)
    assert len(sizes) == 6 and max(sizes) <= 6 * 32 * 3 * 2
    with pytest.raises(Exception, match="null"):
        tr.param_sweep(train.union(spark.createDataFrame([(None, 1.0, 1.0, 1, 1)], df.schema)), test, feats, "y", (1,), (1,))
