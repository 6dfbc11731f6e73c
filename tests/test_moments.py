"""Wide moments, residual costs and exact splits against numpy."""

import math

import numpy as np
import pytest

from tessera.operators import linear as lin
from tessera.operators import moments as mo
from tessera.operators import prepare as pr
from tessera.operators import selection as se


def frame(spark, x, names, parts=5):
    return spark.createDataFrame([tuple(float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names)).repartition(parts)


def test_wide_moments_match_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 40)) * 10.0 ** rng.integers(-3, 4, 40) + 1e6
    names = [f"c{i}" for i in range(40)]
    df = frame(spark, x, names)
    m = mo.compute_moments(df, names[:-1], names[-1])
    xd = x - x.mean(axis=0)
    assert m.n == 400 and m.has_label and m.d == 39
    assert np.allclose(m.mean, x.mean(axis=0), rtol=1e-14)
    scale = np.outer(x.std(axis=0), x.std(axis=0))  # columns of size 1e-3 sit on 1e6: ten digits are left of them
    assert np.allclose(m.cov / scale, xd.T @ xd / 400 / scale, atol=1e-6)
    few = mo.compute_moments(df, names[:5])
    wide = mo.compute_moments(df, names[:5], wide=1)
    assert np.allclose(few.cov / scale[:5, :5], wide.cov / scale[:5, :5], atol=1e-6) and few.n == wide.n and not wide.has_label


def test_wide_moments_of_512_columns(spark):
    df = spark.range(2000).selectExpr(*[f"sin(id * {i + 1}) + {i} AS c{i}" for i in range(512)])
    m = mo.compute_moments(df, [f"c{i}" for i in range(512)])
    x = np.sin(np.arange(2000)[:, None] * (np.arange(512) + 1)) + np.arange(512)
    assert np.allclose(m.cov, np.cov(x.T, bias=True), atol=1e-10)


def test_rows_with_a_missing_value_are_left_out_either_way(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 1.0), (4.0, 4.0)], "a double, b double")
    for wide in (1, 12):
        m = mo.compute_moments(df, ["a", "b"], wide=wide)
        x = np.array([[1, 2], [3, 5], [4, 4]], float)
        assert m.n == 3 and np.allclose(m.mean, x.mean(0)) and np.allclose(m.cov, np.cov(x.T, bias=True))
        with pytest.raises(ValueError):
            mo.compute_moments(df.where("a > 9"), ["a", "b"], wide=wide)


def test_wide_moments_by_group(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 3))
    df = spark.createDataFrame([(i % 4, *map(float, r)) for i, r in enumerate(x)], "g int, a double, b double, c double")
    for wide in (1, 12):
        got = mo.compute_moments_by(df, "g", ["a", "b"], "c", wide=wide)
        assert sorted(got) == [0, 1, 2, 3]
        assert np.allclose(got[2].cov, np.cov(x[2::4].T, bias=True)) and got[2].n == 75
        with pytest.raises(ValueError):
            mo.compute_moments_by(df, "g", ["a"], "c", max_groups=3, wide=wide)


# Fixed values of the regression check: three houses, the optimum's weights and bias.
HOUSES = [(2104, 5, 1, 45, 460), (1416, 3, 2, 40, 232), (852, 2, 1, 35, 178)]
OPTIMUM = ([0.39133535, 18.75376741, -53.36032453, -26.42131618], 785.1811367994083)


@pytest.mark.parametrize("max_terms", [256, 0])
def test_cost_at_the_optimum_golden(spark, max_terms):
    names = ["size", "bedrooms", "floors", "age"]
    df = frame(spark, HOUSES, [*names, "price"])
    assert lin.linear_cost(df, names, "price", *OPTIMUM) == pytest.approx(1.5578904e-12, rel=1e-4)
    cost = mo.residual_costs(df, names, "price", [OPTIMUM], max_terms=max_terms)[None][0]
    assert cost == pytest.approx(1.5578904e-12, rel=1e-4)


@pytest.mark.parametrize("max_terms", [256, 0])
def test_residual_costs_of_many_models_by_group(spark, max_terms):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 4))
    df = spark.createDataFrame([(["train", "cv", None][i % 3], *map(float, r)) for i, r in enumerate(x)],
                               "g string, a double, b double, c double, y double")
    models = [(rng.normal(size=k), float(rng.normal())) for k in (1, 2, 3)]
    got = mo.residual_costs(df, ["a", "b", "c"], "y", models, "g", max_terms)
    assert set(got) == {"train", "cv", None}
    for i, g in enumerate(["train", "cv", None]):
        part = x[i::3]
        want = [0.5 * np.mean((part[:, : len(w)] @ w + b - part[:, 3]) ** 2) for w, b in models]
        assert np.allclose(got[g], want, rtol=1e-12)


def test_exact_fit_has_no_negative_error_at_high_degree(spark):
    rows = [("train" if i % 2 else "cv", float(i), 3.0 + 2 * i - 0.5 * i * i) for i in range(60)]
    df = spark.createDataFrame(rows, "split string, x double, y double")
    got = se.degree_sweep(df, "x", "y", range(1, 13), baseline=1.0).collect()
    assert all(r.train_mse_half >= 0 and r.cv_mse_half >= 0 and r.test_mse_half is None for r in got)
    assert all(r.train_mse_half < 1e-15 for r in got[1:]) and got[0].train_mse_half > 1
    assert got[0].train_minus_baseline == got[0].train_mse_half - 1.0
    ridge = se.lambda_sweep(df, "x", "y", 2, [0.0, 10.0]).collect()
    assert 0 <= ridge[0].train_mse_half < 1e-12 < ridge[1].train_mse_half


def test_degree_sweep_matches_numpy_polyfit(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 50, 300)
    y = np.sin(x / 8) * 20 + rng.normal(size=300)
    split = np.array(["train", "train", "cv", "test"])[np.arange(300) % 4]
    df = spark.createDataFrame(list(zip(split.tolist(), x.tolist(), y.tolist())), "split string, x double, y double")
    for r in se.degree_sweep(df, "x", "y", [1, 3, 8]).collect():
        p = np.polynomial.Polynomial.fit(x[split == "train"], y[split == "train"], r.degree)
        for name in ("train", "cv", "test"):
            want = 0.5 * np.mean((p(x[split == name]) - y[split == name]) ** 2)
            assert r[f"{name}_mse_half"] == pytest.approx(want, rel=1e-6)


@pytest.mark.parametrize("n", [1, 2, 10, 997])
def test_exact_split_sizes(spark, n):
    df = spark.range(n).selectExpr("id", "id % 5 AS k")  # the key repeats: ties are told apart
    got = {r.split: r["count"] for r in pr.exact_split(df, ["k"], [("train", .6), ("cv", .2), ("test", .2)]).groupBy("split").count().collect()}
    train = n - math.ceil(round(n * 0.4, 9))
    test = math.ceil(round(n * 0.2, 9))
    want = {"train": train, "cv": n - train - test, "test": test}
    assert got == {k: v for k, v in want.items() if v}
    assert pr.prefix_split(df, ["k"], 0.8).where("split = 'train'").count() == int(0.8 * n)


def test_step_decay_lowers_alpha_only_on_a_plateau():
    m = mo.Moments(["x", "y"], 10, np.array([0.0, 0.0]), np.array([[1.0, 0.5], [0.5, 1.0]]))
    _, _, hist = mo.gradient_descent_on_moments(m, [0.0], 0.0, 0.9, 25, decay_points=10, decay_digits=3, floor=0.375)
    alphas = [h[4] for h in hist]
    costs = {i: round(hist[i][1], 3) for i in range(0, 25, 3)}  # every ceil(25 / 10) iterations
    want, alpha, last = [], 0.9, None
    for i in range(25):
        want.append(alpha)
        if i % 3 == 0:
            alpha, last = (alpha / 10 if costs[i] == last else alpha), costs[i]
    assert alphas == want and alphas[-1] < alphas[0]


def test_moments_and_costs_of_terms_made_in_the_tasks(spark):
    """Polynomial terms of a sweep are made where they are used: the plan does not grow with the degree."""
    rng = np.random.default_rng(6)
    x = rng.uniform(2.0, 9.0, 300)
    df = spark.createDataFrame([(["train", "cv", "test"][i % 3], float(v), float(np.sin(v)), None if i else 1.0) for i, v in enumerate(x)],
                               "split string, x double, y double, z double")
    make = se.chebyshev(4, 2.0, 9.0)
    m = mo.compute_moments(df, ["x"], "y", terms=(["a", "b", "c", "d"], make))
    t = np.polynomial.chebyshev.chebvander((x * 2 - 11.0) / 7.0, 4)[:, 1:]
    full = np.column_stack([t, np.sin(x)])
    assert m.d == 4 and m.n == 300 and np.allclose(m.mean, full.mean(axis=0)) and np.allclose(m.cov, np.cov(full.T, bias=True))
    got = {r.degree: r.train_mse_half for r in se.degree_sweep(df, "x", "y", [3, 6, 14]).collect()}
    for d, err in got.items():
        xs = x[::3]
        fit = np.polynomial.Chebyshev.fit(xs, np.sin(xs), d)
        assert err == pytest.approx(np.mean((fit(xs) - np.sin(xs)) ** 2) / 2, rel=1e-5, abs=1e-20)
