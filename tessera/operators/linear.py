"""Linear models as Spark jobs.

Fitting reads the data once (the A7 moment aggregate); scoring is a
projection with the weights inlined as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import dot
from . import moments as mo


def predict_linear(df: DataFrame, cols: Sequence[str], w: Sequence[float], b: float,
                   out: str = "prediction") -> DataFrame:
    """M1: w.x + b as a generated column sum."""
    return df.withColumn(out, dot(cols, w, b))


def linear_cost(df: DataFrame, cols: Sequence[str], label: str, w: Sequence[float], b: float,
                lam: float = 0.0) -> float:
    """M3 evaluated directly on rows: 1/(2m) sum (f-y)^2 + lam/(2m) sum w^2."""
    e = dot(cols, w, b) - F.col(label)
    row = df.agg(F.avg(e * e).alias("mse"), F.count(F.lit(1)).alias("m")).first()
    return 0.5 * row["mse"] + lam / (2.0 * row["m"]) * float(np.dot(w, w))


def linear_gradient(df: DataFrame, cols: Sequence[str], label: str, w: Sequence[float], b: float,
                    lam: float = 0.0) -> tuple[np.ndarray, float]:
    """M6 evaluated directly on rows (one aggregate)."""
    e = dot(cols, w, b) - F.col(label)
    row = df.agg(F.count(F.lit(1)).alias("m"), F.avg(e).alias("db"),
                 *[F.avg(e * F.col(c)).alias(f"dw{j}") for j, c in enumerate(cols)]).first()
    dw = np.array([row[f"dw{j}"] for j in range(len(cols))]) + lam / row["m"] * np.asarray(w, dtype=float)
    return dw, float(row["db"])


def fit_gradient_descent(df: DataFrame, cols: Sequence[str], label: str, w0: Sequence[float], b0: float,
                         alpha: float, iters: int, lam: float = 0.0, decay_points: int = 0,
                         decay_digits: int | None = None):
    """M8/M9 (linear): one moment job and one residual scan (the least-squares cost), then the exact update iterated on
    the driver.  Returns (w, b, Moments, history list of (iter, cost, w, b, alpha))."""
    m = mo.compute_moments(df, cols, label)
    floor = None
    if np.linalg.matrix_rank(m.cxx) == m.d:
        floor = mo.residual_costs(df, cols, label, [mo.least_squares(m)])[None][0]
    w, b, hist = mo.gradient_descent_on_moments(m, w0, b0, alpha, iters, lam, decay_points, decay_digits, floor)
    return w, b, m, hist


def fit_least_squares(df: DataFrame, cols: Sequence[str], label: str):
    """M10 (and M13: the SGD regressor converges to this optimum)."""
    m = mo.compute_moments(df, cols, label)
    w, b = mo.least_squares(m)
    return w, b, m


def fit_ridge(df: DataFrame, cols: Sequence[str], label: str, alpha: float):
    """sklearn's Ridge objective SSE + alpha*||w||^2, intercept free."""
    m = mo.compute_moments(df, cols, label)
    w, b = mo.ridge(m, alpha)
    return w, b, m


def fit_ml_linear(df: DataFrame, cols: Sequence[str], label: str, reg: float = 0.0):
    """M10/M13 through pyspark.ml (normal-equation solver)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    va = VectorAssembler(inputCols=list(cols), outputCol="_features")
    model = LinearRegression(featuresCol="_features", labelCol=label, regParam=reg, solver="normal",
                             standardization=False).fit(va.transform(df.select(*cols, label)))
    return np.array(model.coefficients.toArray()), float(model.intercept)
