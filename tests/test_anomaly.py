"""Threshold sweep goldens and brute-force equivalence; Gaussian fit and density."""

import random

import numpy as np
import pytest

from tessera.operators import anomaly as an


def _frame(spark, p, y):
    return spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "p double, y int")


def brute_force(p, y, steps=1000):
    """The reference's loop: arange(min, max, step), predictions p < eps, strict > on F1."""
    p, y = np.asarray(p, dtype=float), np.asarray(y)
    best_eps, best_f1 = 0.0, 0.0
    step = (p.max() - p.min()) / steps
    for eps in np.arange(p.min(), p.max(), step):
        pred = p < eps
        tp = np.sum(pred & (y == 1))
        fp = np.sum(pred & (y == 0))
        fn = np.sum(~pred & (y == 1))
        with np.errstate(invalid="ignore", divide="ignore"):
            prec, rec = tp / (tp + fp), tp / (tp + fn)
            f1 = 2 * prec * rec / (prec + rec)
        if f1 > best_f1:
            best_f1, best_eps = f1, eps
    return best_eps, best_f1


def test_threshold_goldens(spark):
    p = [i / 100 for i in range(30)]
    y = [1] * 5 + [0] * 25
    r = an.select_threshold(_frame(spark, p, y), "p", "y").first()
    assert r.epsilon == pytest.approx(0.04, abs=0.3 / 1000) and r.f1 == 1.0
    y[2] = 0
    r = an.select_threshold(_frame(spark, p, y), "p", "y").first()
    assert r.epsilon == pytest.approx(0.04, abs=0.3 / 1000) and r.f1 == pytest.approx(0.8888888)
    p = [i / 1000 for i in range(50)]
    y = [1] * 8 + [0] * 42
    y[5] = 0
    idx = list(range(50))
    random.Random(3).shuffle(idx)
    r = an.select_threshold(_frame(spark, [p[i] for i in idx], [y[i] for i in idx]), "p", "y").first()
    assert r.epsilon == pytest.approx(0.007, abs=0.05 / 1000) and r.f1 == pytest.approx(0.933333333)


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_histogram_sweep_equals_direct_sweep(spark, seed):
    rng = np.random.default_rng(seed)
    p = rng.lognormal(-3, 2, 2000)
    y = (rng.random(2000) < np.where(p < np.quantile(p, 0.1), 0.7, 0.05)).astype(int)
    eps, f1 = brute_force(p, y)
    r = an.select_threshold(_frame(spark, p, y).repartition(5), "p", "y").first()
    assert r.f1 == pytest.approx(f1, rel=1e-12)
    assert r.epsilon == pytest.approx(eps, rel=1e-12)


def test_gaussian_fit_and_density(spark):
    rng = np.random.default_rng(7)
    x = rng.normal([1.0, -2.0], [0.5, 2.0], size=(500, 2))
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double")
    mu, var = an.estimate_gaussian(df, ["a", "b"])
    assert np.allclose(mu, x.mean(0)) and np.allclose(var, x.var(0))
    z = np.random.default_rng(8).standard_normal((500, 3))  # the reference's loose property
    zm, zv = an.estimate_gaussian(spark.createDataFrame([tuple(map(float, r)) for r in z], "a double, b double, c double"),
                                  ["a", "b", "c"])
    assert np.all(np.abs(zm) < 0.2) and np.all(np.abs(zv - 1.0) < 0.2)
    got = np.array([r[0] for r in df.select(an.density(["a", "b"], mu, var)).collect()])
    d = x - mu
    want = (2 * np.pi) ** -1 * np.prod(var) ** -0.5 * np.exp(-0.5 * np.sum(d * d / var, axis=1))
    assert np.allclose(got, want, rtol=1e-10)
    _, cov = an.covariance_matrix(df, ["a", "b"])
    full = np.array([r[0] for r in df.select(an.density(["a", "b"], mu, cov)).collect()])
    want_full = (2 * np.pi) ** -1 * np.linalg.det(cov) ** -0.5 * np.exp(
        -0.5 * np.sum((d @ np.linalg.pinv(cov)) * d, axis=1))
    assert np.allclose(full, want_full, rtol=1e-9)


def test_zero_variance_is_rejected():
    with pytest.raises(ValueError):
        an.log_density(["a"], [0.0], [0.0])
