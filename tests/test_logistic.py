"""Logistic models: goldens of the classification labs and assignment."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SUP, ref_file
from tessera.functions.core import log_1pexp, sigmoid
from tessera.operators import linear as lin
from tessera.operators import logistic as lg
from tessera.sources.readers import read_numeric_csv

# The six-point example of the classification labs.
SIX_X = [[0.5, 1.5], [1, 1], [1.5, 0.5], [3, 0.5], [2, 2], [1, 2.5]]
SIX_Y = [0, 0, 0, 1, 1, 1]


@pytest.fixture(scope="module")
def six(spark):
    return spark.createDataFrame([(float(a), float(b), float(y)) for (a, b), y in zip(SIX_X, SIX_Y)], "x1 double, x2 double, y double")


def test_six_point_costs(six):
    assert lg.logistic_cost(six, ["x1", "x2"], "y", [1.0, 1.0], -3.0) == pytest.approx(0.36686679, abs=1e-8)
    assert lg.logistic_cost(six, ["x1", "x2"], "y", [1.0, 1.0], -4.0) == pytest.approx(0.50368086, abs=1e-8)


def test_six_point_gradient(six):
    dw, db, _ = lg.logistic_gradient(six, ["x1", "x2"], "y", [2.0, 3.0], 1.0)
    assert db == pytest.approx(0.49861807, abs=1e-8)
    assert dw == pytest.approx([0.498333393278696, 0.49883942983996693], abs=1e-12)


def _seeded(spark, n_feat):
    rng = np.random.RandomState(1)  # generator kept on the test side
    x = rng.rand(5, n_feat)
    y = np.array([0, 1, 0, 1, 0])
    w = rng.rand(n_feat).reshape(-1,) - (0.5 if n_feat == 6 else 0.0)
    cols = [f"x{i}" for i in range(n_feat)]
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(x, y)], cols + ["y"])
    return df, cols, w


def test_regularised_costs(spark):
    df, cols, w = _seeded(spark, 6)
    assert lin.linear_cost(df, cols, "y", w, 0.5, 0.7) == pytest.approx(0.07917239, abs=1e-8)
    assert lg.logistic_cost(df, cols, "y", w, 0.5, 0.7) == pytest.approx(0.68508491, abs=1e-8)


def test_regularised_gradients(spark):
    df, cols, w = _seeded(spark, 3)
    _, db = lin.linear_gradient(df, cols, "y", w, 0.5, 0.7)
    assert db == pytest.approx(0.66487746, abs=1e-8)
    _, db, _ = lg.logistic_gradient(df, cols, "y", w, 0.5, 0.7)
    assert db == pytest.approx(0.34179899, abs=1e-8)


@pytest.fixture(scope="module")
def exams(spark):
    path = ref_file(SUP, "FilesC1W3-final", "data", "ex2data1.txt")
    return read_numeric_csv(spark, path, ["exam1", "exam2", "admitted"]).cache()


def test_exam_costs_and_gradients(exams):
    cols = ["exam1", "exam2"]
    assert lg.logistic_cost(exams, cols, "admitted", [0.0, 0.0], 0.0) == pytest.approx(0.693, abs=1e-3)
    assert lg.logistic_cost(exams, cols, "admitted", [0.2, 0.2], -24.0) == pytest.approx(0.218, abs=1e-3)
    dw, db, _ = lg.logistic_gradient(exams, cols, "admitted", [0.0, 0.0], 0.0)
    assert db == pytest.approx(-0.1, abs=1e-8) and dw == pytest.approx([-12.00921659, -11.26284221], abs=1e-7)
    dw, db, _ = lg.logistic_gradient(exams, cols, "admitted", [0.2, -0.5], -24.0)
    assert db == pytest.approx(-0.6, abs=1e-7) and dw == pytest.approx([-44.83135362, -44.37384125], abs=1e-6)


def test_ml_logistic_reaches_gd_optimum(six):
    w, b, _ = lg.fit_ml_logistic(six, ["x1", "x2"], "y", lam=1.0)
    # the gradient of the reference's L2 objective (C = 1/lambda) vanishes at the ml optimum
    dw, db, _ = lg.logistic_gradient(six, ["x1", "x2"], "y", w, b, 1.0)
    assert np.max(np.abs(dw)) < 1e-6 and abs(db) < 1e-6


def test_sigmoid_and_log1pexp_are_safe(spark):
    df = spark.createDataFrame([(-1000.0,), (-30.0,), (0.0,), (25.0,), (1000.0,)], "z double")
    rows = df.select(sigmoid("z").alias("s"), log_1pexp("z").alias("l")).collect()
    assert rows[2].s == 0.5 and rows[0].s >= 0 and rows[-1].s == 1.0
    assert rows[3].l == 25.0 and rows[-1].l == 1000.0
    assert rows[1].l == pytest.approx(np.log1p(np.exp(-30.0)))


def test_predict_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    assert lg.predict_class(df, ["x"], [1.0], 0.0).first().prediction == 1
