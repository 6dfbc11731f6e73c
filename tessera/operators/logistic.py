"""Logistic models.

Scoring is a projection; cost and gradient are one aggregate each.
Gradient descent is a driver loop in which every step is one aggregate over
a persisted, column-pruned copy of the input (features + label only).
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import dot, log_1pexp, sigmoid
from ..session import working_set
from .moments import sum_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package


def logit(cols: Sequence[str], w: Sequence[float], b: float) -> Column:
    return dot(cols, w, b)


def predict_logistic(df: DataFrame, cols: Sequence[str], w: Sequence[float], b: float,
                     out: str = "probability") -> DataFrame:
    """M2: sigmoid(w.x + b)."""
    return df.withColumn(out, sigmoid(logit(cols, w, b)))


def predict_class(df: DataFrame, cols: Sequence[str], w: Sequence[float], b: float, t: float = 0.5,
                  out: str = "prediction") -> DataFrame:
    """P5: 1 when sigmoid(w.x+b) >= t."""
    return df.withColumn(out, F.when(sigmoid(logit(cols, w, b)) >= F.lit(t), 1).otherwise(0))


def log_loss_expr(z: Column, y: Column) -> Column:
    """M4 (safe form) per row: -y*z + log(1+e^z)."""
    return -y * z + log_1pexp(z)


def logistic_cost(df: DataFrame, cols: Sequence[str], label: str, w: Sequence[float], b: float,
                  lam: float = 0.0) -> float:
    """M4: mean log loss + lam/(2m) sum w^2 (always the overflow-safe form)."""
    z = logit(cols, w, b)
    row = df.agg(F.avg(log_loss_expr(z, F.col(label))).alias("c"), F.count(F.lit(1)).alias("m")).first()
    return float(row["c"]) + lam / (2.0 * row["m"]) * float(np.dot(w, w))


def logistic_sq_err_cost(df: DataFrame, cols: Sequence[str], label: str, w: Sequence[float], b: float) -> float:
    """M5: 1/(2m) sum (sigmoid(z) - y)^2."""
    e = sigmoid(logit(cols, w, b)) - F.col(label)
    return float(df.agg(F.avg(e * e)).first()[0]) / 2.0


def logistic_gradient(df: DataFrame, cols: Sequence[str], label: str, w: Sequence[float], b: float,
                      lam: float = 0.0) -> tuple[np.ndarray, float, float]:
    """M7: (dw, db) with dw = E[(sigmoid(z)-y) x] + lam/m w; also returns the
    unregularised cost of the same (w, b) from the same pass."""
    z = logit(cols, w, b)
    e = sigmoid(z) - F.col(label)
    row = df.agg(F.count(F.lit(1)).alias("m"), F.avg(e).alias("db"),
                 F.avg(log_loss_expr(z, F.col(label))).alias("cost"),
                 *[F.avg(e * F.col(c)).alias(f"g{j}") for j, c in enumerate(cols)]).first()
    dw = np.array([row[f"g{j}"] for j in range(len(cols))]) + lam / row["m"] * np.asarray(w, dtype=float)
    return dw, float(row["db"]), float(row["cost"])


def fit_gradient_descent(df: DataFrame, cols: Sequence[str], label: str, w0: Sequence[float], b0: float,
                         alpha: float, iters: int, lam: float = 0.0):
    """M8 (logistic): one aggregate job per step on a persisted projection.

    Returns (w, b, history) where history rows are (iter, cost_before_step, w, b)
    after the update of that step."""
    data = working_set(df.select(*cols, F.col(label).cast("double").alias(label)))
    w = np.asarray(w0, dtype=float).copy()
    b = float(b0)
    hist = []
    try:
        for i in range(iters):
            dw, db, cost = logistic_gradient(data, cols, label, w, b, lam)
            w = w - alpha * dw
            b = b - alpha * db
            hist.append((i, cost, w.tolist(), b))
    finally:
        data.unpersist()
    return w, b, hist


def fit_newton(df: DataFrame, cols: Sequence[str], label: str, lam: float = 0.0, tol: float = 1e-10, max_steps: int = 50):
    """Minimise sum log-loss + lam/2 sum w^2 (intercept free) by Newton steps.

    A step is one aggregate: each task returns the gradient and the weighted Gram matrix of its rows as one array of
    (d+1)(d+2) numbers, added over a tree of tasks; a step that raises the cost is halved.  Ends when no gradient
    component (per row) exceeds ``tol``; raises after ``max_steps``.  Separable data without ``lam`` has no
    optimum and raises.  Returns (w, b, history[(step, mean cost)])."""
    d = len(cols) + 1
    data = working_set(df.select(F.col(label).cast("double").alias("_y"),
                                 *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]).dropna())
    ridge = np.full(d, float(lam))
    ridge[-1] = 0.0

    def sums(theta: np.ndarray):
        def part(it):
            total = None
            for b in it:
                if not b.num_rows:
                    continue
                y, *x = (b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns))
                x = np.column_stack([*x, np.ones(len(y))])
                z = x @ theta
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                cost = np.sum(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z))))
                v = np.concatenate([[float(len(y)), cost], x.T @ (p - y), ((x * (p * (1 - p))[:, None]).T @ x).ravel()])
                total = v if total is None else total + v
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

        v = sum_vectors(data.mapInArrow(part, "v array<double>"), 2 + d + d * d)
        if not v[0]:
            raise ValueError("no rows")
        cost = (v[1] + 0.5 * float(ridge @ (theta * theta))) / v[0]
        return v[0], cost, v[2: 2 + d] + ridge * theta, v[2 + d:].reshape(d, d) + np.diag(ridge)

    theta, history = np.zeros(d), []
    try:
        m, cost, grad, gram = sums(theta)
        for step in range(max_steps):
            history.append((step, cost))
            if np.max(np.abs(grad)) <= tol * m:
                return theta[:-1], float(theta[-1]), history
            move, size = np.linalg.solve(gram, grad), 1.0
            while True:
                m, new_cost, new_grad, new_gram = sums(theta - size * move)
                if new_cost <= cost * (1 + 1e-14) or size < 1e-6:
                    break
                size /= 2
            theta, cost, grad, gram = theta - size * move, new_cost, new_grad, new_gram
    finally:
        data.unpersist()
    raise RuntimeError(f"gradient {np.max(np.abs(grad)) / m} after {max_steps} Newton steps")


def fit_ml_logistic(df: DataFrame, cols: Sequence[str], label: str, lam: float = 0.0):
    """L2 logistic regression through pyspark.ml.  The reference's
    C = 1/lam objective equals regParam = lam/m with standardization off."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=list(cols), outputCol="_features").transform(
        df.select(*cols, F.col(label).cast("double").alias(label)))
    m = data.count()
    model = LogisticRegression(featuresCol="_features", labelCol=label, regParam=lam / m if lam else 0.0,
                               elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-10).fit(data)
    return np.array(model.coefficients.toArray()), float(model.intercept), model


def fit_one_vs_rest(df: DataFrame, cols: Sequence[str], label: str, lam: float = 0.0):
    """One binary logistic model per class (pyspark.ml OneVsRest)."""
    from pyspark.ml.classification import LogisticRegression, OneVsRest
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=list(cols), outputCol="_features").transform(
        df.select(*cols, F.col(label).cast("double").alias(label)))
    ovr = OneVsRest(classifier=LogisticRegression(regParam=lam, standardization=False, maxIter=100),
                    featuresCol="_features", labelCol=label)
    return ovr.fit(data), data


def boundary_grid(df: DataFrame, x1: str, x2: str, score, steps: int = 20, t: float = 0.5) -> DataFrame:
    """M15 re-aimed as grid scoring: a steps x steps grid over the bounding box
    of (x1, x2) (one aggregate for the box), each point scored by ``score``
    (a function of two Columns returning a probability) and thresholded."""
    box = df.agg(F.min(x1).alias("lo1"), F.max(x1).alias("hi1"), F.min(x2).alias("lo2"), F.max(x2).alias("hi2"))
    idx = F.sequence(F.lit(0), F.lit(steps - 1))
    g = box.select("*", F.explode(idx).alias("i")).select("*", F.explode(idx).alias("j"))
    g1 = F.col("lo1") + (F.col("hi1") - F.col("lo1")) * F.col("i") / F.lit(steps - 1)
    g2 = F.col("lo2") + (F.col("hi2") - F.col("lo2")) * F.col("j") / F.lit(steps - 1)
    g = g.select("i", "j", g1.alias("g1"), g2.alias("g2"))
    p = score(F.col("g1"), F.col("g2"))
    return g.withColumn("probability", p).withColumn("prediction", F.when(F.col("probability") >= F.lit(t), 1)
                                                     .otherwise(0))
