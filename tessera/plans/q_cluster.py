"""Clustering and anomaly-detection queries.

Anomaly: documents are the training set, labelled documents the validation
set (anomaly = quality 0); features are ln(1 + characters) and
ln(1 + space-separated tokens) of the whole text.
k-means: the 64-dimensional embeddings, k = 10.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.core import array_cols
from ..operators import anomaly as an
from ..operators import cluster as cl
from ..operators.prepare import split_label
from .common import rnd, tbl
from .registry import query

FEATS = ["f_chars", "f_tokens"]
DOC_FEATS_SQL = "ln(1 + n_chars) AS f_chars, ln(1 + len(string_split(text, ' '))) AS f_tokens"
TRAIN_SQL = f"tr AS (SELECT doc_id, {DOC_FEATS_SQL} FROM documents)"
VAL_SQL = (f"va AS (SELECT d.doc_id, {DOC_FEATS_SQL.replace('n_chars', 'd.n_chars').replace('(text', '(d.text')}, "
           "CAST(1 - l.quality AS BIGINT) AS y FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")


def doc_features(df):
    return df.select("doc_id", F.ln(1 + F.col("n_chars")).alias("f_chars"),
                     F.ln(1 + F.size(F.split(F.col("text"), " "))).alias("f_tokens"))


def train_val(spark, sf):
    docs = tbl(spark, sf, "documents")
    tr = doc_features(docs)
    va = doc_features(docs).join(tbl(spark, sf, "labels").select("doc_id", (1 - F.col("quality")).alias("y")),
                                 "doc_id")
    return tr, va


FIT_SQL = f"""
WITH {TRAIN_SQL}
SELECT 'f_chars' AS feature, round(avg(f_chars), 8) AS mean, round(var_pop(f_chars), 8) AS variance FROM tr
UNION ALL SELECT 'f_tokens', round(avg(f_tokens), 8), round(var_pop(f_tokens), 8) FROM tr
"""


@query("gaussian_fit", FIT_SQL)
def gaussian_fit(spark, sf):
    """Per-feature mean and population variance of the document features."""
    tr, _ = train_val(spark, sf)
    mu, var = an.estimate_gaussian(tr, FEATS)
    return spark.createDataFrame([(f, round(float(m), 8), round(float(v), 8)) for f, m, v in zip(FEATS, mu, var)],
                                 "feature string, mean double, variance double")


def _logp_diag_sql() -> str:
    return (f"""{TRAIN_SQL}, {VAL_SQL},
g AS (SELECT avg(f_chars) AS m0, var_pop(f_chars) AS v0, avg(f_tokens) AS m1, var_pop(f_tokens) AS v1 FROM tr),
pv AS (SELECT va.doc_id, va.y, -0.5 * 2 * ln(2 * pi()) - 0.5 * (ln(v0) + ln(v1))
          - (power(f_chars - m0, 2) / (2 * v0) + power(f_tokens - m1, 2) / (2 * v1)) AS logp FROM va, g)""")


DENSITY_SQL = f"WITH {_logp_diag_sql()} SELECT doc_id, round(logp, 6) AS log_p FROM pv"


@query("gaussian_density", DENSITY_SQL)
def gaussian_density(spark, sf):
    """N2 (diagonal variance): log density of every validation document."""
    tr, va = train_val(spark, sf)
    mu, var = an.estimate_gaussian(tr, FEATS)
    return va.select("doc_id", rnd(an.log_density(FEATS, mu, var), 6).alias("log_p"))


FULL_SQL = f"""
WITH {TRAIN_SQL}, {VAL_SQL},
g AS (SELECT avg(f_chars) AS m0, avg(f_tokens) AS m1, covar_pop(f_chars, f_chars) AS a,
             covar_pop(f_chars, f_tokens) AS b, covar_pop(f_tokens, f_tokens) AS c FROM tr),
h AS (SELECT *, a * c - b * b AS det FROM g)
SELECT doc_id, round(-ln(2 * pi()) - 0.5 * ln(det)
       - 0.5 * ((c * power(f_chars - m0, 2) - 2 * b * (f_chars - m0) * (f_tokens - m1) + a * power(f_tokens - m1, 2)) / det),
       6) AS log_p FROM va, h
"""


@query("gaussian_density_full", FULL_SQL)
def gaussian_density_full(spark, sf):
    """N2 (full covariance, A10): log density with the pseudo-inverse and determinant of the covariance."""
    tr, va = train_val(spark, sf)
    mu, cov = an.covariance_matrix(tr, FEATS)
    return va.select("doc_id", rnd(an.log_density(FEATS, mu, cov), 6).alias("log_p"))


COV_SQL = """
SELECT * FROM (
  SELECT 0::BIGINT AS i, 0::BIGINT AS j, round(covar_pop(l_quantity, l_quantity), 8) AS cov FROM lineitem
  UNION ALL SELECT 0, 1, round(covar_pop(l_quantity, l_discount), 8) FROM lineitem
  UNION ALL SELECT 0, 2, round(covar_pop(l_quantity, l_tax), 8) FROM lineitem
  UNION ALL SELECT 1, 0, round(covar_pop(l_discount, l_quantity), 8) FROM lineitem
  UNION ALL SELECT 1, 1, round(covar_pop(l_discount, l_discount), 8) FROM lineitem
  UNION ALL SELECT 1, 2, round(covar_pop(l_discount, l_tax), 8) FROM lineitem
  UNION ALL SELECT 2, 0, round(covar_pop(l_tax, l_quantity), 8) FROM lineitem
  UNION ALL SELECT 2, 1, round(covar_pop(l_tax, l_discount), 8) FROM lineitem
  UNION ALL SELECT 2, 2, round(covar_pop(l_tax, l_tax), 8) FROM lineitem)
"""


@query("covariance_matrix", COV_SQL)
def covariance_matrix_q(spark, sf):
    """A10: full population covariance matrix of quantity, discount, tax in one aggregate."""
    cols = ["l_quantity", "l_discount", "l_tax"]
    _, cov = an.covariance_matrix(tbl(spark, sf, "lineitem"), cols)
    rows = [(i, j, round(float(cov[i, j]), 8)) for i in range(3) for j in range(3)]
    return spark.createDataFrame(rows, "i long, j long, cov double")


EMB_COV_SQL = """
WITH e AS (SELECT vec_id, range AS i, CAST(embedding[range + 1] AS DOUBLE) AS x FROM embeddings, range(64))
SELECT a.i, b.i AS j, round(covar_pop(a.x, b.x), 10) AS cov FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY a.i, b.i
"""


@query("embedding_covariance", EMB_COV_SQL)
def embedding_covariance(spark, sf):
    """A10/A7 with many columns: covariance of all 64 embedding dimensions from batched products of centred rows."""
    names = [f"e{i}" for i in range(64)]
    emb = tbl(spark, sf, "embeddings").select(*array_cols("embedding", 64, "e"))
    _, cov = an.covariance_matrix(emb, names)
    rows = [(i, j, round(float(cov[i, j]), 10)) for i in range(64) for j in range(64)]
    return spark.createDataFrame(rows, "i long, j long, cov double")


THRESH_SQL = f"""
WITH {_logp_diag_sql()},
ptr AS (SELECT exp(-0.5 * 2 * ln(2 * pi()) - 0.5 * (ln(v0) + ln(v1))
          - (power(f_chars - m0, 2) / (2 * v0) + power(f_tokens - m1, 2) / (2 * v1))) AS p FROM tr, g),
pp AS (SELECT y, exp(logp) AS p FROM pv),
mm AS (SELECT min(p) AS lo, max(p) AS hi, (max(p) - min(p)) / 1000 AS step FROM pp),
grid AS (SELECT lo, range AS k, lo + range * ((lo + step) - lo) AS eps FROM mm, range(0, 1001)
         WHERE range < ceil((hi - lo) / step)),
sc AS (SELECT k, eps, count(*) FILTER (WHERE p < eps AND y = 1) AS tp, count(*) FILTER (WHERE p < eps AND y = 0) AS fp,
              count(*) FILTER (WHERE p >= eps AND y = 1) AS fn FROM grid, pp GROUP BY k, eps),
f AS (SELECT k, eps, 2.0 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                     / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) AS f1 FROM sc),
best AS (SELECT eps, f1 FROM f WHERE f1 > 0 ORDER BY f1 DESC, k ASC LIMIT 1)
SELECT round(eps, 12) AS epsilon, round(f1, 8) AS f1,
       (SELECT count(*) FROM ptr WHERE p < best.eps) AS n_anomalies FROM best
"""


@query("anomaly_threshold", THRESH_SQL)
def anomaly_threshold(spark, sf):
    """N3 F1-tuned epsilon (1000-step sweep by histogram + running sums), N4/P6 anomaly count on the training set."""
    tr, va = train_val(spark, sf)
    mu, var = an.estimate_gaussian(tr, FEATS)
    pv = va.select("y", an.density(FEATS, mu, var).alias("p"))
    best = an.select_threshold(pv, "p", "y").first()
    eps = best["epsilon"]
    if eps is None:  # all scores are equal: there is no sweep, and the SQL has no row either
        return spark.createDataFrame([], "epsilon double, f1 double, n_anomalies long")
    flagged = an.flag_anomalies(tr.select(an.density(FEATS, mu, var).alias("p")), "p", eps)
    n = flagged.agg(F.sum("is_anomaly").cast("long").alias("n")).first()["n"]
    return spark.createDataFrame([(round(eps, 12), round(best["f1"], 8), int(n))],
                                 "epsilon double, f1 double, n_anomalies long")


# --- k-means on embeddings ---------------------------------------------------

K, ITERS, SEED = 10, 5, 7
ECOLS = [f"e{i}" for i in range(64)]


def emb_frame(spark, sf):
    return tbl(spark, sf, "embeddings").select("vec_id", "label", *array_cols("embedding", 64, "e"))


def kmeans_fit(spark, sf):
    emb = emb_frame(spark, sf)
    init = cl.init_centroids(emb, ECOLS, K, "vec_id", SEED)
    cents, _ = cl.run_kmeans(emb, ECOLS, init, ITERS)
    return emb, cents


def _kmeans_sql(final: str) -> str:
    parts = [
        "pts AS (SELECT vec_id, j.range AS dim, CAST(embedding[j.range + 1] AS DOUBLE) AS x FROM embeddings, range(64) j)",
        f"init AS (SELECT vec_id, row_number() OVER (ORDER BY md5(concat(CAST(vec_id AS VARCHAR), '-{SEED}'))) - 1 AS k "
        f"FROM embeddings QUALIFY k < {K})",
        "c0 AS (SELECT init.k, pts.dim, pts.x AS c FROM init JOIN pts ON init.vec_id = pts.vec_id)",
    ]
    for t in range(1, ITERS + 1):
        parts += [
            f"d{t} AS (SELECT pts.vec_id, c.k, sum(power(pts.x - c.c, 2)) AS dist FROM pts JOIN c{t - 1} c "
            f"ON pts.dim = c.dim GROUP BY pts.vec_id, c.k)",
            f"a{t} AS (SELECT vec_id, k FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, k) = 1)",
            f"n{t} AS (SELECT a.k, pts.dim, avg(pts.x) AS c FROM a{t} a JOIN pts ON a.vec_id = pts.vec_id "
            f"GROUP BY a.k, pts.dim)",
            f"c{t} AS (SELECT p.k, p.dim, coalesce(n.c, p.c) AS c FROM c{t - 1} p LEFT JOIN n{t} n "
            f"ON p.k = n.k AND p.dim = n.dim)",
        ]
    t = ITERS + 1
    parts += [
        f"d{t} AS (SELECT pts.vec_id, c.k, sum(power(pts.x - c.c, 2)) AS dist FROM pts JOIN c{ITERS} c "
        f"ON pts.dim = c.dim GROUP BY pts.vec_id, c.k)",
        f"a{t} AS (SELECT vec_id, k, dist FROM d{t} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, k) = 1)",
    ]
    return "WITH " + ",\n".join(parts) + "\n" + final.format(c=f"c{ITERS}", a=f"a{t}")


@query("kmeans_centroids", _kmeans_sql(
    "SELECT CAST(k AS BIGINT) AS cluster, CAST(dim AS BIGINT) AS dim, round(c, 6) AS value FROM {c}"))
def kmeans_centroids(spark, sf):
    """K4 hashed initial rows, K3 Lloyd loop (K1 literal-centroid assignment + K2/A2 grouped means), 5 iterations."""
    _, cents = kmeans_fit(spark, sf)
    rows = [(k, d, round(float(cents[k, d]), 6)) for k in range(K) for d in range(64)]
    return spark.createDataFrame(rows, "cluster long, dim long, value double")


@query("kmeans_assign", _kmeans_sql("SELECT vec_id, CAST(k AS BIGINT) AS cluster FROM {a}"))
def kmeans_assign(spark, sf):
    """Nearest-centroid assignment of every embedding after the K3 loop (point x centroid as a projection
    over literal centroids: no join, no shuffle)."""
    emb, cents = kmeans_fit(spark, sf)
    return cl.assign(emb, ECOLS, cents).select("vec_id", F.col("cluster").cast("long"))


@query("vector_quantize", _kmeans_sql(
    "SELECT vec_id, CAST(k AS BIGINT) AS cluster, round(dist, 6) AS sq_error FROM {a}"))
def vector_quantize(spark, sf):
    """Replace each vector by its centroid (broadcast k-row centroid table), squared reconstruction error."""
    emb, cents = kmeans_fit(spark, sf)
    q = cl.quantize(emb, ECOLS, cents)
    err = sum((F.col(c) - F.col(f"q_{c}")) * (F.col(c) - F.col(f"q_{c}")) for c in ECOLS)
    return q.select("vec_id", F.col("cluster").cast("long"), rnd(err, 6).alias("sq_error"))


NC_SQL = """
WITH pts AS (SELECT vec_id, label, j.range AS dim, CAST(embedding[j.range + 1] AS DOUBLE) AS x,
      CASE WHEN ((('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT) % 100) < 60 THEN 'train'
           WHEN ((('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 8))::BIGINT) % 100) < 80 THEN 'cv' ELSE 'test' END AS split
      FROM embeddings, range(64) j),
cen AS (SELECT label AS k, dim, avg(x) AS c FROM pts WHERE split = 'train' GROUP BY label, dim),
d AS (SELECT p.vec_id, p.label, p.split, c.k, sum(power(p.x - c.c, 2)) AS dist FROM pts p JOIN cen c ON p.dim = c.dim
      GROUP BY p.vec_id, p.label, p.split, c.k),
a AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, k) = 1),
u AS (SELECT split, label, k FROM a UNION ALL SELECT 'all', label, k FROM a)
SELECT split, count(*) AS n, round(avg(CASE WHEN label <> k THEN 1.0 ELSE 0.0 END), 8) AS class_error FROM u GROUP BY split
"""


@query("nearest_centre_error", NC_SQL)
def nearest_centre_error(spark, sf):
    """K6: per-label centres (A2) from the train split, nearest-centre labels for every row, error per split and overall (W9 union)."""
    emb = emb_frame(spark, sf).withColumn("split", split_label("vec_id", [("train", .6), ("cv", .2), ("test", .2)]))
    cents = cl.centroid_means(emb.where(F.col("split") == "train"), ECOLS, "label")
    pred = cl.nearest_centre_classifier(emb, ECOLS, "label", cents)
    both = pred.select("split", "label", "prediction").unionByName(
        pred.select(F.lit("all").alias("split"), "label", "prediction"))
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(
        F.avg(F.when(F.col("label") != F.col("prediction"), 1.0).otherwise(0.0)), 8).alias("class_error"))
