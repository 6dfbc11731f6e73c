"""Deterministic generators.

Randomness comes from hashing (row id, seed), never from F.rand, so that a
generated table is the same whatever the partitioning and survives task
retries.  These are *not* bit-equal to NumPy's generator.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_TWO52 = float(2 ** 52)


def uniform(key: Column, seed: int, salt: int = 0) -> Column:
    """U[0,1) from a 64-bit hash of (key, seed, salt)."""
    h = F.xxhash64(key, F.lit(int(seed)), F.lit(int(salt)))
    return F.pmod(h, F.lit(2 ** 52)).cast("double") / F.lit(_TWO52)


def normal(key: Column, seed: int, salt: int = 0) -> Column:
    """N(0,1) by Box-Muller on two hashed uniforms."""
    u1 = F.greatest(uniform(key, seed, 2 * salt + 1), F.lit(1e-300))
    u2 = uniform(key, seed, 2 * salt + 2)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def noisy_quadratic(spark: SparkSession, m: int, seed: int = 1, scale: float = 0.7) -> DataFrame:
    """x = linspace(0, 49, m); y = x^2 + scale*x^2*(u-0.5)."""
    step = 49.0 / (m - 1) if m > 1 else 0.0
    df = spark.range(m).withColumn("x", F.col("id") * F.lit(step))
    y_ideal = F.col("x") * F.col("x")
    return df.withColumn("y", y_ideal + F.lit(scale) * y_ideal * (uniform(F.col("id"), seed) - F.lit(0.5)))


def blobs(spark: SparkSession, m: int, centres: Sequence[Sequence[float]], std: float = 0.4,
          seed: int = 1) -> DataFrame:
    """Gaussian blobs; row i belongs to centre i mod k."""
    k, d = len(centres), len(centres[0])
    df = spark.range(m).withColumn("label", (F.col("id") % k).cast("int"))
    cols = []
    for j in range(d):
        c = F.element_at(F.array(*[F.lit(float(cc[j])) for cc in centres]), F.col("label") + 1)
        cols.append((c + F.lit(std) * normal(F.col("id"), seed, j)).alias(f"x{j}"))
    return df.select("id", *cols, "label")


def roast_label(temp: Column, minutes: Column) -> Column:
    """S10 rule: good roast iff 175<t<260, 12<d<15 and d <= -3/85*t + 21."""
    rule = ((temp > 175) & (temp < 260) & (minutes > 12) & (minutes < 15)
            & (minutes <= F.lit(-3.0 / 85.0) * temp + F.lit(21.0)))
    return F.when(rule, 1).otherwise(0)


def roast_data(spark: SparkSession, m: int = 200, seed: int = 2) -> DataFrame:
    """Temperatures in [150,285), durations in [11.5,15.5) and their rule label."""
    df = spark.range(m)
    t = uniform(F.col("id"), seed, 0) * F.lit(135.0) + F.lit(150.0)
    d = uniform(F.col("id"), seed, 1) * F.lit(4.0) + F.lit(11.5)
    df = df.select("id", t.alias("temp"), d.alias("minutes"))
    return df.withColumn("good", roast_label(F.col("temp"), F.col("minutes")))


def replicate(df: DataFrame, times: int, copy_col: str = "copy") -> DataFrame:
    """Every row ``times`` times (np.tile), as a generator, not a join."""
    return df.withColumn(copy_col, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
