"""Logistic-model queries: lineitem, y = (l_returnflag = 'R'), x = z-scored quantity, discount, tax."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.core import sigmoid
from ..operators import logistic as lg
from ..operators.evaluate import (accuracy_expr, binary_cross_entropy_expr, class_error_expr,
                                  precision_recall_f1)
from ..operators.prepare import zscore
from .common import LI_X, rnd, tbl
from .registry import query
from .sqlgen import cramer_sql

W_LOG = [0.3, -0.2, 0.1]
B_LOG = -0.5
LAM = 0.7
ALPHA, ITERS = 1.0, 20

_STATS = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
_ZCOLS = ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in LI_X)
BASE_SQL = (f"s AS (SELECT {_STATS} FROM lineitem), "
            f"z AS (SELECT {_ZCOLS}, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS y FROM lineitem, s)")


def _sig(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-greatest(least({z}, 500.0), -500.0))))"


def _l1pe(z: str) -> str:
    return f"(CASE WHEN {z} <= 20.0 THEN ln(1.0 + exp({z})) ELSE {z} END)"


def _zsql(ws, b) -> str:
    return "(" + " + ".join(f"{w!r} * {c}" for w, c in zip(ws, LI_X)) + f" + {b!r})"


def base(spark, sf):
    li = tbl(spark, sf, "lineitem").select(*LI_X, F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
                                           .alias("y"))
    z, _ = zscore(li, LI_X)
    return z


_Z = _zsql(W_LOG, B_LOG)
COST_SQL = f"""
WITH {BASE_SQL},
a AS (SELECT count(*) AS n, avg(-y * {_Z} + {_l1pe(_Z)}) AS c, avg(power({_sig(_Z)} - y, 2)) / 2 AS sq,
      avg({_sig(_Z)} - y) AS db, {', '.join(f'avg(({_sig(_Z)} - y) * {c}) AS g_{c}' for c in LI_X)} FROM z)
SELECT 'log_loss' AS term, round(c, 8) AS value FROM a
UNION ALL SELECT 'log_loss_reg', round(c + {LAM!r} / (2 * n) * {sum(w * w for w in W_LOG)!r}, 8) FROM a
UNION ALL SELECT 'sq_err_cost', round(sq, 8) FROM a
UNION ALL SELECT 'db', round(db, 8) FROM a
{''.join(f" UNION ALL SELECT 'dw_{c}', round(g_{c} + {LAM!r} / n * {w!r}, 8) FROM a" for c, w in zip(LI_X, W_LOG))}
"""


@query("logistic_cost_gradient", COST_SQL)
def logistic_cost_gradient(spark, sf):
    """M4 safe log loss (plain and L2), M5 squared-error cost on the sigmoid, M7 regularised gradient."""
    z = base(spark, sf).cache()
    c = lg.logistic_cost(z, LI_X, "y", W_LOG, B_LOG)
    creg = lg.logistic_cost(z, LI_X, "y", W_LOG, B_LOG, LAM)
    sq = lg.logistic_sq_err_cost(z, LI_X, "y", W_LOG, B_LOG)
    dw, db, _ = lg.logistic_gradient(z, LI_X, "y", W_LOG, B_LOG, LAM)
    z.unpersist()
    rows = [("log_loss", c), ("log_loss_reg", creg), ("sq_err_cost", sq), ("db", db)]
    rows += [(f"dw_{c}", float(g)) for c, g in zip(LI_X, dw)]
    return spark.createDataFrame([(t, round(v, 8)) for t, v in rows], "term string, value double")


def _gd_sql() -> str:
    d = len(LI_X)
    zz = "(" + " + ".join(f"w_{i} * {c}" for i, c in enumerate(LI_X)) + " + b)"
    upd = [f"w_{i} - {ALPHA!r} * avg(({_sig(zz)} - y) * {c})" for i, c in enumerate(LI_X)]
    upd.append(f"b - {ALPHA!r} * avg({_sig(zz)} - y)")
    upd.append(f"avg(-y * {zz} + {_l1pe(zz)})")
    ws = ", ".join(f"w_{i}" for i in range(d))
    return f"""
WITH RECURSIVE {BASE_SQL},
gd(it, {ws}, b, cost) AS (
  SELECT -1, {', '.join('0.0::DOUBLE' for _ in range(d))}, 0.0::DOUBLE, NULL::DOUBLE
  UNION ALL
  SELECT it + 1, {', '.join(upd)} FROM gd, z WHERE it < {ITERS - 1} GROUP BY it, {ws}, b)
SELECT CAST(it AS BIGINT) AS iter, round(cost, 8) AS cost, {', '.join(f'round(w_{i}, 8) AS w_{c}' for i, c in enumerate(LI_X))},
       round(b, 8) AS b FROM gd WHERE it >= 0
"""


@query("logistic_gradient_descent", _gd_sql())
def logistic_gradient_descent(spark, sf):
    """M8 (logistic): one aggregate job per step over a persisted projection; cost history."""
    w, b, hist = lg.fit_gradient_descent(base(spark, sf), LI_X, "y", [0.0] * 3, 0.0, ALPHA, ITERS)
    rows = [(int(i), round(c, 8), *[round(x, 8) for x in ws], round(bb, 8)) for i, c, ws, bb in hist]
    return spark.createDataFrame(rows, "iter long, cost double, " + ", ".join(f"w_{c} double" for c in LI_X)
                                 + ", b double")


METRICS_SQL = f"""
WITH {BASE_SQL},
p AS (SELECT y, CASE WHEN {_sig(_Z)} >= 0.5 THEN 1 ELSE 0 END AS yhat FROM z),
c AS (SELECT count(*) FILTER (WHERE yhat = 1 AND y = 1) AS tp, count(*) FILTER (WHERE yhat = 1 AND y = 0) AS fp,
             count(*) FILTER (WHERE yhat = 0 AND y = 1) AS fn, count(*) FILTER (WHERE yhat = 0 AND y = 0) AS tn,
             avg(CASE WHEN y <> yhat THEN 1.0 ELSE 0.0 END) AS err, avg(CASE WHEN y = yhat THEN 1.0 ELSE 0.0 END) AS acc
      FROM p)
SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 8) AS precision, round(tp / nullif(tp + fn, 0), 8) AS recall,
       round(2.0 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
             / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 8) AS f1,
       round(err, 8) AS class_error, round(acc, 8) AS accuracy
FROM c
"""


@query("logistic_predict_metrics", METRICS_SQL)
def logistic_predict_metrics(spark, sf):
    """P5 threshold at 0.5 (inclusive), A5 confusion counts, E2 error, E3 accuracy, E4 precision/recall/F1."""
    pred = lg.predict_class(base(spark, sf), LI_X, W_LOG, B_LOG)
    out = precision_recall_f1(pred, "y", "prediction", class_error_expr("y", "prediction").alias("class_error"),
                              accuracy_expr("y", "prediction").alias("accuracy"))
    return out.select("tp", "fp", "fn", "tn", *[rnd(c, 8).alias(c) for c in
                                                ("precision", "recall", "f1", "class_error", "accuracy")])


CE_SQL = f"""
WITH {BASE_SQL}, p AS (SELECT y, {_Z} AS zz FROM z)
SELECT round(avg(greatest(zz, 0.0) - zz * y + ln(1.0 + exp(-abs(zz)))), 8) AS bce_logits,
       round(avg(-(y * ln({_sig('zz')}) + (1.0 - y) * ln(1.0 - {_sig('zz')}))), 8) AS bce_probability
FROM p
"""


@query("binary_cross_entropy", CE_SQL)
def binary_cross_entropy(spark, sf):
    """E5: binary cross-entropy from logits (stable form) and from M2 probabilities sigmoid(w.x + b)."""
    z = lg.predict_logistic(base(spark, sf).withColumn("zz", lg.logit(LI_X, W_LOG, B_LOG)), LI_X, W_LOG, B_LOG)
    out = z.agg(binary_cross_entropy_expr("y", "zz").alias("bce_logits"),
                binary_cross_entropy_expr("y", "probability", from_logits=False).alias("bce_probability"))
    return out.select(*[rnd(c, 8).alias(c) for c in out.columns])


def _newton_sql(steps: int = 9) -> str:
    """Newton steps unrolled: weighted Gram sums of each, the 4 x 4 system by determinants."""
    xs = [*LI_X, "1.0"]
    d = len(xs)
    parts, prev = [BASE_SQL, "n0 AS (SELECT " + ", ".join(f"0.0::DOUBLE AS t{i}" for i in range(d)) + ")"], "n0"
    for s in range(1, steps + 1):
        zz = " + ".join(f"t{i} * {x}" for i, x in enumerate(xs))
        lam = lambda i: f" + {LAM!r} * any_value(t{i})" if i < d - 1 else ""
        sums = [f"sum((p - y) * {x}){lam(i)} AS g{i}" for i, x in enumerate(xs)]
        sums += [f"sum(p * (1 - p) * {xs[i]} * {xs[j]}){f' + {LAM!r}' if i == j < d - 1 else ''} AS h{i}_{j}" for i in range(d) for j in range(i, d)]
        parts.append(f"g{s} AS MATERIALIZED (SELECT {', '.join(f'any_value(t{i}) AS t{i}' for i in range(d))}, {', '.join(sums)} "
                     f"FROM (SELECT *, {_sig(zz)} AS p FROM z, {prev}))")
        move = cramer_sql([[f"h{min(i, j)}_{max(i, j)}" for j in range(d)] for i in range(d)], [f"g{i}" for i in range(d)])
        parts.append(f"n{s} AS MATERIALIZED (SELECT {', '.join(f't{i} - {m} AS t{i}' for i, m in enumerate(move))} FROM g{s})")
        prev = f"n{s}"
    return ("WITH " + ",\n".join(parts) + f"\nSELECT 'intercept' AS term, round(t{d - 1}, 6) AS value FROM {prev}"
            + "".join(f" UNION ALL SELECT '{c}', round(t{i}, 6) FROM {prev}" for i, c in enumerate(LI_X)))


@query("logistic_newton", _newton_sql())
def logistic_newton(spark, sf):
    """M12 by Newton steps: L2 logistic regression (lambda = 0.7), one weighted-Gram aggregate per step, to convergence."""
    w, b, _ = lg.fit_newton(base(spark, sf), LI_X, "y", LAM)
    rows = [("intercept", round(b, 6))] + [(c, round(float(v), 6)) for c, v in zip(LI_X, w)]
    return spark.createDataFrame(rows, "term string, value double")


@query("logistic_ml_fit")
def logistic_ml_fit(spark, sf):
    """L2 logistic regression (lambda = 0.7, C = 1/lambda) through pyspark.ml L-BFGS."""
    w, b, _ = lg.fit_ml_logistic(base(spark, sf), LI_X, "y", LAM)
    rows = [("intercept", round(b, 6))] + [(c, round(float(v), 6)) for c, v in zip(LI_X, w)]
    return spark.createDataFrame(rows, "term string, value double")


@query("one_vs_rest")
def one_vs_rest(spark, sf):
    """One-vs-all logistic models over the 10 embedding labels; per-class training accuracy."""
    from ..functions.core import array_cols
    emb = tbl(spark, sf, "embeddings")
    cols = [f"e{i}" for i in range(64)]
    data = emb.select(*array_cols("embedding", 64, "e"), "label")
    model, assembled = lg.fit_one_vs_rest(data, cols, "label")
    pred = model.transform(assembled)
    return pred.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                     F.round(accuracy_expr(F.col("label").cast("double"), "prediction"), 6)
                                     .alias("accuracy"))


GRID_W, GRID_B, STEPS = [0.08, -10.0], -1.5, 20
GRID_SQL = f"""
WITH box AS (SELECT min(l_quantity) AS lo1, max(l_quantity) AS hi1, min(l_discount) AS lo2, max(l_discount) AS hi2
             FROM lineitem),
g AS (SELECT i.range AS i, j.range AS j, lo1 + (hi1 - lo1) * i.range / {STEPS - 1}.0 AS g1,
             lo2 + (hi2 - lo2) * j.range / {STEPS - 1}.0 AS g2 FROM box, range({STEPS}) i, range({STEPS}) j),
p AS (SELECT *, {_sig(f'({GRID_W[0]!r} * g1 + {GRID_W[1]!r} * g2 + {GRID_B!r})')} AS pr FROM g)
SELECT CAST(i AS BIGINT) AS i, CAST(j AS BIGINT) AS j, round(g1, 8) AS g1, round(g2, 8) AS g2,
       round(pr, 8) AS probability, CAST(CASE WHEN pr >= 0.5 THEN 1 ELSE 0 END AS BIGINT) AS prediction FROM p
"""


@query("decision_grid", GRID_SQL)
def decision_grid(spark, sf):
    """M15 re-aimed: 20x20 grid over the (quantity, discount) bounding box, scored and thresholded."""
    li = tbl(spark, sf, "lineitem")
    g = lg.boundary_grid(li, "l_quantity", "l_discount",
                         lambda a, b: sigmoid(a * F.lit(GRID_W[0]) + b * F.lit(GRID_W[1]) + F.lit(GRID_B)), STEPS)
    return g.select(F.col("i").cast("long"), F.col("j").cast("long"), rnd("g1", 8).alias("g1"),
                    rnd("g2", 8).alias("g2"), rnd("probability", 8).alias("probability"),
                    F.col("prediction").cast("long"))
