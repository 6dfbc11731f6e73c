"""k-means and vector quantisation.

Centroids are k x d numbers, so they travel as literals inside the plan: the
assignment (K1) is a projection with no join and no shuffle, and an
iteration (K1 + K2) is one aggregate whose output is k rows.  Input rows are
persisted once (features only) for the loop.
"""


from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import sq_dist_sql
from ..session import working_set


# Above this many distance terms (k * d) a generated expression no longer
# fits one compiled method; the Arrow-batched numpy kernel takes over.
MAX_EXPR_TERMS = 256


def nearest(cols: Sequence[str], centroids: np.ndarray) -> Column:
    """K1: index of the nearest centroid by squared L2 distance; the lowest
    index wins ties, a null coordinate gives null.  Small k*d: a generated expression (struct comparison
    orders by distance, then index).  Large k*d: a vectorised pandas UDF over
    Arrow batches with the k x d centroids in its closure."""
    centroids = np.asarray(centroids, dtype=float)
    missing = " OR ".join(f"`{c}` IS NULL" for c in cols)
    if centroids.size > MAX_EXPR_TERMS:
        return F.when(~F.expr(missing), _nearest_udf(centroids)(F.array(*[F.col(c).cast("double") for c in cols])))
    cands = ", ".join(f"named_struct('d', {sq_dist_sql(cols, c)}, 'k', {k})" for k, c in enumerate(centroids))
    return F.expr(f"if({missing}, NULL, array_min(array({cands})).k)")


def _nearest_udf(centroids: np.ndarray):
    import pandas as pd

    cents = np.ascontiguousarray(centroids)

    @F.pandas_udf("int")
    def nearest_batch(vectors: pd.Series) -> pd.Series:
        x = np.stack(vectors.to_numpy()).astype(float)
        d = np.zeros((x.shape[0], cents.shape[0]))
        for j in range(x.shape[1]):  # sum over dimensions in order, like the expression form
            diff = x[:, j:j + 1] - cents[None, :, j]
            d += diff * diff
        return pd.Series(np.argmin(d, axis=1).astype("int32"))  # first index on ties

    return nearest_batch


def assign(df: DataFrame, cols: Sequence[str], centroids, out: str = "cluster") -> DataFrame:
    return df.withColumn(out, nearest(cols, np.asarray(centroids, dtype=float)))


def centroid_means(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> dict[int, np.ndarray]:
    """A2: per-cluster means (k rows to the driver)."""
    rows = df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols]).collect()
    return {int(r[cluster]): np.array([r[c] for c in cols], dtype=float) for r in rows}


def compute_centroids(df: DataFrame, cols: Sequence[str], k: int, previous=None, cluster: str = "cluster") -> np.ndarray:
    """K2: new centroids; an empty cluster keeps its previous centroid (the
    reference would produce NaN)."""
    means = centroid_means(df, cols, cluster)
    out = np.array(previous, dtype=float) if previous is not None else np.full((k, len(cols)), np.nan)
    for j, m in means.items():
        out[j] = m
    return out


def init_centroids(df: DataFrame, cols: Sequence[str], k: int, key: str, seed: int = 0) -> np.ndarray:
    """K4: k distinct rows chosen by a seeded hash order of the key (a
    top-k, not a full sort)."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")))
    rows = df.select(order.alias("_h"), *cols).orderBy("_h").limit(k).collect()
    return np.array([[r[c] for c in cols] for r in rows], dtype=float)


def run_kmeans(df: DataFrame, cols: Sequence[str], initial, max_iters: int = 10):
    """K3: Lloyd iterations from given initial centroids.  Returns the final
    centroids and the list of centroids after each iteration."""
    data = working_set(df.select(*cols))
    cents = np.asarray(initial, dtype=float)
    history = []
    try:
        for _ in range(max_iters):
            cents = compute_centroids(assign(data, cols, cents), cols, len(cents), previous=cents)
            history.append(cents.copy())
    finally:
        data.unpersist()
    return cents, history


def centroid_table(spark, centroids, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    rows = [(int(k), *[float(v) for v in c]) for k, c in enumerate(np.asarray(centroids))]
    return spark.createDataFrame(rows, [cluster, *cols])


def quantize(df: DataFrame, cols: Sequence[str], centroids, cluster: str = "cluster",
             prefix: str = "q_") -> DataFrame:
    """Replace each row's features by its centroid.  The centroid
    table has k rows (bounded by the caller's k), so it is broadcast."""
    cents = np.asarray(centroids, dtype=float)
    assigned = assign(df, cols, cents, cluster)
    ct = centroid_table(df.sparkSession, cents, [f"{prefix}{c}" for c in cols], cluster)
    return assigned.join(F.broadcast(ct), cluster)


def nearest_centre_classifier(df: DataFrame, cols: Sequence[str], label: str, centres: dict,
                              out: str = "prediction") -> DataFrame:
    """K6 building block: predict the label of the nearest labelled centre."""
    labels = sorted(centres)
    cents = np.array([centres[lab] for lab in labels])
    idx = nearest(cols, cents)
    return df.withColumn(out, F.element_at(F.array(*[F.lit(lab) for lab in labels]), idx + 1))
