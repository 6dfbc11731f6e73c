"""Dense layers: goldens, expression vs vectorised path, backprop vs finite differences."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import core as fn
from tessera.operators import dense as dn


def test_softmax_goldens(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0],), ([5.0] * 10,)], "z array<double>")
    rows = df.select(fn.softmax("z").alias("s"), fn.argmax("z").alias("a")).collect()
    assert rows[0].s == pytest.approx([0.0320586, 0.08714432, 0.23688282, 0.64391426], abs=1e-7)
    assert rows[1].s == pytest.approx([0.1] * 10) and rows[1].a == 0 and rows[0].a == 3


def test_dense_layer_expression_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(20, 4))
    layers = [(rng.normal(size=(4, 3)), rng.normal(size=3), "relu"), (rng.normal(size=(3, 2)), rng.normal(size=2), "sigmoid")]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ["a", "b", "c", "d"])
    got = np.array([[r.o0, r.o1] for r in dn.forward(df, ["a", "b", "c", "d"], layers, "o").collect()])
    a = x
    for w, b, act in layers:
        a = dn._np_act(act, a @ w + b)
    assert np.allclose(got, a, rtol=1e-12)


def test_wide_path_matches_expression_path(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(30, 20))
    cols = [f"x{i}" for i in range(20)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], cols)
    layers = [(rng.normal(size=(20, 16)), rng.normal(size=16), "relu"), (rng.normal(size=(16, 3)), np.zeros(3), "linear")]
    wide = np.array([[r.o0, r.o1, r.o2] for r in dn.forward(df, cols, layers, "o").collect()])
    a = np.maximum(x @ layers[0][0] + layers[0][1], 0) @ layers[1][0]
    assert np.allclose(wide, a, rtol=1e-10)


@pytest.mark.parametrize("loss,acts,n_out", [("mse", ["relu", "linear"], 1), ("logits_bce", ["sigmoid", "linear"], 1),
                                             ("sparse_ce", ["relu", "linear"], 3)])
def test_backprop_matches_finite_differences(loss, acts, n_out):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(15, 3))
    y = rng.integers(0, n_out if loss == "sparse_ce" else 2, size=15).astype(float)
    layers = dn.init_layers([3, 4, n_out], acts, seed=3)
    layers = [(w, rng.normal(size=b.shape) * 0.1, a) for w, b, a in layers]
    _, g = dn.batch_loss_grad(x, y, layers, loss)
    theta = dn._flatten(layers)
    num = np.zeros_like(theta)
    for k in range(len(theta)):
        e = np.zeros_like(theta)
        e[k] = 1e-6
        lp, _ = dn.batch_loss_grad(x, y, dn._unflatten(theta + e, layers), loss)
        lm, _ = dn.batch_loss_grad(x, y, dn._unflatten(theta - e, layers), loss)
        num[k] = (lp - lm) / 2e-6
    assert np.allclose(g, num, atol=1e-5)


def test_full_batch_training_reduces_objective(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 2))
    y = x[:, 0] * 2 - x[:, 1] + 0.1 * rng.normal(size=300)
    df = spark.createDataFrame([(float(a), float(b), float(t)) for (a, b), t in zip(x, y)], "a double, b double, y double")
    layers = dn.init_layers([2, 6, 1], ["relu", "linear"], seed=0)
    _, hist = dn.train_full_batch(df.repartition(4), ["a", "b"], "y", layers, "mse", lr=0.05, steps=30)
    assert hist[-1][1] < 0.5 * hist[0][1]
    assert F is not None


def test_forward_has_one_meaning_at_every_size(spark, monkeypatch):
    """Softmax, null and NaN inputs and unknown activations: generated expressions equal the batched form."""
    from tessera.operators import dense as dn
    rng = np.random.default_rng(3)
    layers = [(rng.normal(size=(2, 4)), rng.normal(size=4), "relu"), (rng.normal(size=(4, 3)), rng.normal(size=3), "sigmoid"),
              (rng.normal(size=(3, 3)), rng.normal(size=3), "softmax")]
    df = spark.createDataFrame([(1, 0.5, -1.0), (2, None, 1.0), (3, float("nan"), 1.0), (4, 2.0, 3.0)], "id int, a double, b double")
    small = {r.id: (r.out0, r.out1, r.out2) for r in dn.forward(df, ["a", "b"], layers).collect()}
    monkeypatch.setattr(dn, "MAX_EXPR_TERMS", 0)
    large = {r.id: (r.out0, r.out1, r.out2) for r in dn.forward(df, ["a", "b"], layers).collect()}
    for i in (1, 4):
        np.testing.assert_allclose(small[i], large[i], rtol=1e-12)
        assert abs(sum(small[i]) - 1.0) < 1e-12
    assert small[2] == large[2] == (None, None, None)
    assert all(np.isnan(x) for x in (*small[3], *large[3]))
    for terms in (0, 256):
        monkeypatch.setattr(dn, "MAX_EXPR_TERMS", terms)
        with pytest.raises(ValueError):
            dn.forward(df, ["a", "b"], [(np.ones((2, 1)), np.zeros(1), "tanh")])
