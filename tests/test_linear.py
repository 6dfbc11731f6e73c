"""Linear models: goldens of the reference's first regression assignment plus properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SUP, ref_file
from tessera.operators import linear as lin
from tessera.operators import moments as mo
from tessera.sources.readers import read_numeric_csv


@pytest.fixture(scope="module")
def profit(spark):
    path = ref_file(SUP, "FilesC1W2-final", "data", "ex1data1.txt")
    return read_numeric_csv(spark, path, ["population", "profit"]).cache()


def test_reader_keeps_every_row_and_positions(profit):
    assert profit.count() == 97
    ids = sorted(r.id for r in profit.select("id").collect())
    assert ids == list(range(97))


def test_cost_golden(profit):
    assert lin.linear_cost(profit, ["population"], "profit", [2.0], 1.0) == pytest.approx(75.203, abs=1e-3)
    m = mo.compute_moments(profit, ["population"], "profit")
    assert mo.linear_cost(m, [2.0], 1.0) == pytest.approx(75.203, abs=1e-3)


@pytest.mark.parametrize("w,b,dw,db", [(0.0, 0.0, -65.32884975, -5.83913505), (0.2, 0.2, -47.41610118, -4.00717505)])
def test_gradient_golden(profit, w, b, dw, db):
    g_w, g_b = lin.linear_gradient(profit, ["population"], "profit", [w], b)
    assert g_w[0] == pytest.approx(dw, abs=1e-7) and g_b == pytest.approx(db, abs=1e-7)
    m = mo.compute_moments(profit, ["population"], "profit")
    g_w, g_b = mo.linear_gradient(m, [w], b)
    assert g_w[0] == pytest.approx(dw, abs=1e-7) and g_b == pytest.approx(db, abs=1e-7)


def test_gradient_descent_golden(profit):
    w, b, _, hist = lin.fit_gradient_descent(profit, ["population"], "profit", [0.0], 0.0, 0.01, 1500)
    assert w[0] == pytest.approx(1.16636235, abs=1e-7)
    assert b == pytest.approx(-3.63029144, abs=1e-7)
    assert len(hist) == 1500 and hist[-1][1] < hist[0][1]
    assert (3.5 * w[0] + b) * 10000 == pytest.approx(4519.77, abs=0.01)
    assert (7.0 * w[0] + b) * 10000 == pytest.approx(45342.45, abs=0.01)


def _lineitem(spark, sf="sf0.001"):
    return spark.read.parquet(f"/root/testdata/{sf}/lineitem.parquet").select(
        "l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 1000).alias("y"))


def test_least_squares_matches_numpy_and_ml(spark):
    li = _lineitem(spark)
    pdf = li.toPandas()
    x = np.column_stack([np.ones(len(pdf)), pdf[["l_quantity", "l_discount", "l_tax"]].to_numpy()])
    ref = np.linalg.lstsq(x, pdf["y"].to_numpy(), rcond=None)[0]
    w, b, _ = lin.fit_least_squares(li, ["l_quantity", "l_discount", "l_tax"], "y")
    assert np.allclose(np.r_[b, w], ref, rtol=1e-8, atol=1e-8)
    w2, b2 = lin.fit_ml_linear(li, ["l_quantity", "l_discount", "l_tax"], "y")
    assert np.allclose(np.r_[b2, w2], ref, rtol=1e-6, atol=1e-6)


def test_ridge_matches_closed_form(spark):
    li = _lineitem(spark)
    pdf = li.toPandas()
    x = pdf[["l_quantity", "l_discount", "l_tax"]].to_numpy()
    y = pdf["y"].to_numpy()
    xc, yc = x - x.mean(0), y - y.mean()
    ref = np.linalg.solve(xc.T @ xc + 5.0 * np.eye(3), xc.T @ yc)
    w, b, _ = lin.fit_ridge(li, ["l_quantity", "l_discount", "l_tax"], "y", 5.0)
    assert np.allclose(w, ref, rtol=1e-8)
    assert b == pytest.approx(y.mean() - x.mean(0) @ ref, rel=1e-8)


def test_gd_approaches_least_squares(spark):
    from tessera.operators.prepare import zscore
    z, _ = zscore(_lineitem(spark), ["l_quantity", "l_discount", "l_tax"])
    w_ls, b_ls, m = lin.fit_least_squares(z, ["l_quantity", "l_discount", "l_tax"], "y")
    w, b, _ = mo.gradient_descent_on_moments(m, [0, 0, 0], 0, 0.3, 3000)[:2] + (None,)
    assert np.allclose(w, w_ls, atol=1e-6) and b == pytest.approx(b_ls, abs=1e-6)


def test_moment_merge_equals_union(spark):
    li = _lineitem(spark)
    a = mo.compute_moments(li.where("l_quantity < 20"), ["l_quantity", "l_tax"], "y")
    b = mo.compute_moments(li.where("l_quantity >= 20"), ["l_quantity", "l_tax"], "y")
    whole = mo.compute_moments(li, ["l_quantity", "l_tax"], "y")
    m = mo.merge(a, b)
    assert m.n == whole.n
    assert np.allclose(m.mean, whole.mean) and np.allclose(m.cov, whole.cov, rtol=1e-9)


def test_moments_partition_invariant(spark):
    li = _lineitem(spark)
    a = mo.compute_moments(li, ["l_quantity", "l_discount"], "y")
    b = mo.compute_moments(li.repartition(7), ["l_quantity", "l_discount"], "y")
    assert np.allclose(a.cov, b.cov, rtol=1e-10) and np.allclose(a.mean, b.mean, rtol=1e-12)


def test_step_decay_rule_divides_alpha_on_plateau():
    m = mo.Moments(["x", "y"], 10, np.array([0.0, 0.0]), np.array([[1.0, 0.0], [0.0, 1.0]]))
    # with w, b already optimal the cost never changes, so alpha shrinks and w stays put
    w, b, hist = mo.gradient_descent_on_moments(m, [0.0], 0.0, 0.5, 20, decay_points=10)
    assert w[0] == 0.0 and b == 0.0 and all(h[1] == hist[0][1] for h in hist)
