"""Gaussian anomaly detection.

Fitting is one aggregate (means, population variances, optionally the full
population covariance); the density is a projection with the parameters as
literals, computed in log space.  The F1-tuned threshold sweep reads the
validation scores once: each score falls into the first sweep step whose
epsilon exceeds it, a grouped count per step (at most steps+1 groups, map-side
combined) and a running sum over those few rows give tp/fp/fn for every
epsilon at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .moments import compute_moments


def estimate_gaussian(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per-feature mean and population variance in one job."""
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(cols)]).first()
    k = len(cols)
    return (np.array([row[f"m{i}"] for i in range(k)], dtype=float),
            np.array([row[f"v{i}"] for i in range(k)], dtype=float))


def covariance_matrix(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """A10: means and the full population covariance, over the rows that have every column."""
    m = compute_moments(df, cols)
    return m.mean, m.cov


def log_density(cols: Sequence[str], mu: Sequence[float], var) -> Column:
    """N2 in log space.  ``var`` 1-D -> diagonal covariance; 2-D -> full
    covariance (pseudo-inverse and determinant computed on the driver, the
    quadratic form is a generated column sum).  Zero variance is rejected
    (the density would be infinite)."""
    var = np.asarray(var, dtype=float)
    k = len(cols)
    if var.ndim == 1:
        if np.any(var <= 0):
            raise ValueError("zero variance feature")
        terms = [(F.col(c) - F.lit(float(m))) * (F.col(c) - F.lit(float(m))) / F.lit(float(2.0 * v))
                 for c, m, v in zip(cols, mu, var)]
        const = -0.5 * k * math.log(2 * math.pi) - 0.5 * float(np.sum(np.log(var)))
        return F.lit(const) - reduce(lambda a, b: a + b, terms)
    det = float(np.linalg.det(var))
    if det <= 0:
        raise ValueError("singular covariance")
    prec = np.linalg.pinv(var)
    dev = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, mu)]
    quad = reduce(lambda a, b: a + b, [dev[i] * dev[j] * F.lit(float(prec[i, j])) for i in range(k) for j in range(k)])
    const = -0.5 * k * math.log(2 * math.pi) - 0.5 * math.log(det)
    return F.lit(const) - F.lit(0.5) * quad


def density(cols: Sequence[str], mu, var) -> Column:
    """The density itself (exp of the log density)."""
    return F.exp(log_density(cols, mu, var))


def sweep_grid(lo: float, hi: float, steps: int = 1000) -> tuple[int, float, float]:
    """Epsilon grid of the reference's sweep: arange(lo, hi, (hi-lo)/steps),
    i.e. eps_k = lo + k*delta for k < count, the maximum itself excluded."""
    step = (hi - lo) / steps
    count = int(math.ceil((hi - lo) / step))
    delta = (lo + step) - lo
    return count, step, delta


def select_threshold(df: DataFrame, p: str, y: str, steps: int = 1000) -> DataFrame:
    """Best epsilon by F1 over the sweep, smallest epsilon on ties.

    Returns a one-row frame (epsilon, f1); (0.0, 0.0) when no epsilon has a
    positive F1 and NULLs when all scores are equal (no sweep exists)."""
    mm = df.agg(F.min(p).alias("lo"), F.max(p).alias("hi")).first()
    lo, hi = float(mm["lo"]), float(mm["hi"])
    spark = df.sparkSession
    if not hi > lo:
        return spark.createDataFrame([(None, None)], "epsilon double, f1 double")
    count, _, delta = sweep_grid(lo, hi, steps)

    def eps(k: Column) -> Column:
        return F.lit(lo) + k.cast("double") * F.lit(delta)

    # first k with eps_k > p; estimate by division, then fix the float edge by one step either way
    k0 = F.least(F.greatest(F.floor((F.col(p) - F.lit(lo)) / F.lit(delta)) + 1, F.lit(0)), F.lit(count))
    k1 = F.when((k0 > 0) & (eps(k0 - 1) > F.col(p)), k0 - 1).otherwise(k0)
    k2 = F.when((k1 < count) & (eps(k1) <= F.col(p)), k1 + 1).otherwise(k1)
    hist = (df.select(k2.cast("long").alias("k"), F.col(y).cast("long").alias("y"))
            .groupBy("k").agg(F.sum("y").alias("pos"), F.count(F.lit(1)).alias("n")))
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    # the histogram has at most count+1 rows, so these windows run on a tiny table
    cum = (hist.select("k", F.sum("pos").over(run).alias("tp"), F.sum("n").over(run).alias("pred"),
                       F.sum("pos").over(whole).alias("P"))
           .where(F.col("k") < count))
    tp = F.col("tp").cast("double")
    prec = F.try_divide(tp, F.col("pred").cast("double"))
    rec = F.try_divide(tp, F.col("P").cast("double"))
    f1 = F.try_divide(F.lit(2.0) * prec * rec, prec + rec)
    scored = cum.select("k", f1.alias("f1")).where(F.col("f1") > 0)
    best = scored.orderBy(F.col("f1").desc(), F.col("k").asc()).limit(1)
    best = best.select(eps(F.col("k")).alias("epsilon"), "f1")
    fallback = spark.createDataFrame([(0.0, 0.0)], "epsilon double, f1 double")
    return best.unionByName(fallback).orderBy(F.col("f1").desc()).limit(1)


def flag_anomalies(df: DataFrame, p: str, epsilon: float, out: str = "is_anomaly") -> DataFrame:
    """Strictly lower density than epsilon is an anomaly."""
    return df.withColumn(out, F.when(F.col(p) < F.lit(float(epsilon)), 1).otherwise(0))
