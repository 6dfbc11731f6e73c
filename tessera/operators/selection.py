"""Model selection.

A sweep reads the data twice, however many candidates it has.  The first scan returns the train rows' moments at
the largest candidate feature set; each candidate is a sub-block of them, scaled with the train statistics
and solved on the driver.  The second carries the squared residuals of all candidates at once and gives their
halved MSE on every split from the rows themselves, so an error is never negative and keeps its digits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import moments as mo
from .ordering import cuts_before, order_key, order_statistics
from .prepare import poly_one, zscore_transform


def _fit(train: mo.Moments, idx: Sequence[int], alpha: float | None):
    """Weights for the features ``idx`` of ``train``, in their own units."""
    tr = train.select(idx)
    stats = mo.scaler_from(tr)
    trz = mo.standardize(tr, stats)
    w, b = mo.least_squares(trz) if alpha is None else mo.ridge(trz, alpha)
    mu, sd = (np.array([stats[n][i] for n in tr.names[: tr.d]]) for i in (0, 1))
    w = w / sd
    return w, float(b - w @ mu)


def _frame(spark: SparkSession, rows: list[tuple], names: list[str], types: list) -> DataFrame:
    schema = T.StructType([T.StructField(n, t) for n, t in zip(names, types)])
    return spark.createDataFrame(rows, schema)


def _sweep_frame(spark: SparkSession, key: str, key_type, labels: list, errors: dict, baseline: float | None) -> DataFrame:
    """One row per candidate: its errors on train, cv and test (null without such rows), the gaps cv - train (E13
    variance) and train - baseline (E13 bias, null without a baseline), and 1 for the lowest cv error."""
    train, cv = errors["train"], errors["cv"]
    test = errors.get("test", [None] * len(labels))
    best = int(np.argmin(cv))
    rows = [(k, train[i], cv[i], test[i], cv[i] - train[i], None if baseline is None else train[i] - baseline, int(i == best))
            for i, k in enumerate(labels)]
    return _frame(spark, rows, [key, "train_mse_half", "cv_mse_half", "test_mse_half", "cv_minus_train", "train_minus_baseline", "is_best"],
                  [key_type, *[T.DoubleType()] * 5, T.LongType()])


def chebyshev(degree: int, lo: float, hi: float) -> Callable[[np.ndarray], np.ndarray]:
    """The function that makes columns T_1(u) .. T_degree(u) of a column x, u = x moved from [lo, hi] to [-1, 1]: they span
    the same polynomials as the powers of x, without their near dependence at high degrees."""
    def columns(x: np.ndarray) -> np.ndarray:
        u = (x[:, 0] * 2.0 - (lo + hi)) / (hi - lo if hi > lo else 1.0)
        t = [np.ones_like(u), u]
        for _ in range(1, degree):
            t.append(2.0 * u * t[-1] - t[-2])
        return np.column_stack(t[1:])

    return columns


def degree_sweep(df: DataFrame, x: str, y: str, degrees: Sequence[int], split_col: str = "split",
                 alpha: float | None = None, baseline: float | None = None) -> DataFrame:
    """For each degree the polynomial of x fitted on train by least squares (or ridge on the z-scored powers),
    with its halved MSE on train, cv and test, the gaps, and a flag for the degree with the lowest cv error.

    Least squares is fitted in Chebyshev polynomials of x (same predictions, any degree)."""
    dmax = max(degrees)
    names = [f"_p{k}" for k in range(1, dmax + 1)]
    rows = df.select(F.col(split_col).alias("split"), F.col(x).cast("double").alias("_x"), F.col(y).alias("_y"))
    train = rows.where(F.col("split") == "train")
    if alpha is None:  # the terms are made where they are multiplied: as columns, each would hold those before it
        ends = train.agg(F.min("_x"), F.max("_x")).first()
        feats, cols, terms = (lambda d: d), ["_x"], (names, chebyshev(dmax, ends[0], ends[1]))
    else:
        feats, cols, terms = (lambda d: poly_one(d, "_x", dmax, prefix="_p")), names, None
    m = mo.compute_moments(feats(train), cols, "_y", terms=terms)
    models = [_fit(m, range(d), alpha) for d in degrees]
    errors = mo.residual_costs(feats(rows), cols, "_y", models, "split", terms=terms)
    return _sweep_frame(df.sparkSession, "degree", T.LongType(), [int(d) for d in degrees], errors, baseline)


def lambda_sweep(df: DataFrame, x: str, y: str, degree: int, lambdas: Sequence[float],
                 split_col: str = "split", baseline: float | None = None) -> DataFrame:
    """Ridge strength sweep at a fixed degree on the same moments."""
    names = [f"_p{k}" for k in range(1, degree + 1)]
    rows = poly_one(df.select(F.col(split_col).alias("split"), F.col(x).alias("_x"), F.col(y).alias("_y")), "_x", degree, prefix="_p")
    m = mo.compute_moments(rows.where(F.col("split") == "train"), names, "_y")
    stats = mo.scaler_from(m)
    models = [mo.ridge(mo.standardize(m, stats), float(lam)) for lam in lambdas]
    errors = mo.residual_costs(zscore_transform(rows, stats), names, "_y", models, "split")
    return _sweep_frame(df.sparkSession, "reg_lambda", T.DoubleType(), [float(v) for v in lambdas], errors, baseline)


def feature_set_sweep(df: DataFrame, feature_sets: dict[str, Sequence[str]], y: str,
                      split_col: str = "split", baseline: float | None = None) -> DataFrame:
    """Compare feature lists; one moment pass over their union."""
    allf = []
    for fs in feature_sets.values():
        allf += [c for c in fs if c not in allf]
    rows = df.select(F.col(split_col).alias("split"), *allf, F.col(y).alias("_y"))
    m = mo.compute_moments(rows.where(F.col("split") == "train"), allf, "_y")
    models = []
    for fs in feature_sets.values():
        w = np.zeros(len(allf))
        at = [allf.index(c) for c in fs]
        w[at], b = _fit(m, at, None)
        models.append((w, b))
    errors = mo.residual_costs(rows, allf, "_y", models, "split")
    return _sweep_frame(df.sparkSession, "feature_set", T.StringType(), list(feature_sets), errors, baseline)


def learning_curve(df: DataFrame, features: Sequence[str], y: str, order_cols: Sequence[str], steps: int = 10,
                   split_col: str = "split") -> DataFrame:
    """E9 (+T11): fit on the first k/steps of the train rows (in order_cols order), k = 1..steps; train error on that
    prefix, cv error on all cv rows.

    The rows at the cuts are found as order statistics, without a full sort; rows then know their step by
    comparison with the cut keys.  Rows that tie in all order columns are told apart by their place in the scan."""
    cols = list(features)
    keep = list(dict.fromkeys([*order_cols, *cols, y]))
    rows = df.where(F.col(split_col).isin("train", "cv")).select(F.col(split_col).alias("_split"), *keep, F.monotonically_increasing_id().alias("_tie"))
    order = [*order_cols, "_tie"]
    train = rows.where(F.col("_split") == "train")
    n = train.count()
    ranks = [-(-k * n // steps) for k in range(1, steps)]
    cuts = order_statistics(train, order, ranks)
    reached = [r for r in ranks if r in cuts]
    rows = rows.withColumn("_key", order_key(order))
    before = cuts_before("_key", rows.schema["_key"].dataType, [cuts[r] for r in reached])
    step = F.when(F.col("_split") == "cv", F.lit(-1)).otherwise(
        F.element_at(F.array(*[F.lit(k) for k in [*[ranks.index(r) for r in reached], steps - 1]]), before + 1))
    parted = rows.select(step.alias("_step"), *dict.fromkeys([*cols, y]))
    parts = mo.compute_moments_by(parted.where("_step >= 0"), "_step", cols, y)
    models, sizes, acc = [], [], None
    for k in range(steps):
        if k in parts:
            acc = parts[k] if acc is None else mo.merge(acc, parts[k])
        models.append(_fit(acc, range(len(cols)), None))
        sizes.append(int(acc.n))
    errors = mo.residual_costs(parted, cols, y, models, "_step")
    out = []
    for k in range(steps):
        train_sse = sum(parts[s].n * errors[s][k] for s in range(k + 1) if s in parts)
        out.append((sizes[k], train_sse / sizes[k], errors[-1][k]))
    return _frame(df.sparkSession, out, ["train_rows", "train_mse_half", "cv_mse_half"],
                  [T.LongType(), T.DoubleType(), T.DoubleType()])


def cost_surface(df: DataFrame, x: str, y: str, ws: Sequence[float], bs: Sequence[float]) -> DataFrame:
    """Halved-MSE cost of y ~ w*x + b at every grid point (w, b).

    The data are read once into a one-row moment frame; the grid is a
    literal array exploded next to it, so the cost of each point is a
    projection (no join against the data)."""
    one = df.agg(F.avg(x).alias("mx"), F.avg(y).alias("my"), F.var_pop(x).alias("vx"),
                 F.covar_pop(x, y).alias("cxy"), F.var_pop(y).alias("vy"))
    grid = F.array(*[F.struct(F.lit(float(w)).alias("w"), F.lit(float(b)).alias("b")) for w in ws for b in bs])
    g = one.select("*", F.inline(grid))
    w, b = F.col("w"), F.col("b")
    bias = w * F.col("mx") + b - F.col("my")
    cost = F.lit(0.5) * (w * w * F.col("vx") - F.lit(2.0) * w * F.col("cxy") + F.col("vy") + bias * bias)
    dw = w * F.col("vx") - F.col("cxy") + F.col("mx") * bias
    return g.select("w", "b", cost.alias("cost"), dw.alias("dj_dw"), bias.alias("dj_db"))


def split_column(key: Column, fractions=(("train", 0.6), ("cv", 0.2), ("test", 0.2))) -> Column:
    from .prepare import split_label
    return split_label(key, list(fractions))
