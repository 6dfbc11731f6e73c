"""Dense-network queries: batch scoring with given weights, pyspark.ml MLP, data-parallel training."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..functions import core as fn
from ..functions.core import array_cols
from ..operators import dense as dn
from ..operators.evaluate import accuracy_expr, halved_mse_expr, sparse_cross_entropy_expr
from ..operators.prepare import hash_bucket, zscore
from .common import LI_X, LI_Y, rnd, tbl
from .registry import query


def rule_weights(n_in: int, n_out: int, seed: int, scale: float) -> np.ndarray:
    """Given (fixed) weights of the scoring queries: round(sin(seed + 7i + 3j) * scale, 4)."""
    return np.array([[round(math.sin(seed + 7 * i + 3 * j) * scale, 4) for j in range(n_out)] for i in range(n_in)])


SMALL = [(rule_weights(3, 4, 1, 0.8), np.array([0.1, -0.1, 0.05, 0.0]), "relu"),
         (rule_weights(4, 3, 2, 0.8), np.array([0.0, 0.2, -0.2]), "linear")]
WIDE = [(rule_weights(64, 16, 3, 0.3), np.zeros(16), "relu"),
        (rule_weights(16, 10, 4, 0.3), np.array([0.01 * j for j in range(10)]), "linear")]


def _layers_sql(inputs: list[str], layers) -> list[str]:
    cur = inputs
    for w, b, act in layers:
        nxt = []
        for j in range(w.shape[1]):
            z = f"({float(b[j])!r} + " + " + ".join(f"({c}) * {float(w[i, j])!r}" for i, c in enumerate(cur)) + ")"
            nxt.append(f"greatest({z}, 0.0)" if act == "relu" else z)
        cur = nxt
    return cur


def _small_sql() -> str:
    z = [f"z_{c}" for c in LI_X]
    out = _layers_sql(z, SMALL)
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
    zc = ", ".join(f"({c} - mu_{c}) / sd_{c} AS z_{c}" for c in LI_X)
    m = "greatest(o0, o1, o2)"
    den = f"(exp(o0 - {m}) + exp(o1 - {m}) + exp(o2 - {m}))"
    am = "CASE WHEN o0 >= o1 AND o0 >= o2 THEN 0 WHEN o1 >= o2 THEN 1 ELSE 2 END"
    return f"""
WITH s AS (SELECT {st} FROM lineitem), z AS (SELECT {zc} FROM lineitem, s),
o AS (SELECT {', '.join(f'{e} AS o{j}' for j, e in enumerate(out))} FROM z),
p AS (SELECT {am} AS cls, exp({m} - {m}) / {den} AS pmax FROM o)
SELECT CAST(cls AS INTEGER) AS cls, count(*) AS n, round(avg(pmax), 8) AS mean_pmax FROM p GROUP BY cls
"""


@query("dense_scoring", _small_sql())
def dense_scoring(spark, sf):
    """R1/R2 as generated expressions (3-4-3 net, ReLU then linear), F4 softmax, F5 argmax; class counts."""
    li = tbl(spark, sf, "lineitem").select(*LI_X)
    z, _ = zscore(li, LI_X)
    out = dn.forward(z, LI_X, SMALL, "o")
    logits = F.array("o0", "o1", "o2")
    p = out.select(fn.argmax(logits).alias("cls"), F.array_max(fn.softmax(logits)).alias("pmax"))
    return p.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), rnd(F.avg("pmax"), 8).alias("mean_pmax"))


def _wide_sql() -> str:
    ins = [f"CAST(embedding[{i + 1}] AS DOUBLE)" for i in range(64)]
    out = _layers_sql(ins, WIDE)
    m = "greatest(" + ", ".join(f"o{j}" for j in range(10)) + ")"
    lse = f"({m} + ln(" + " + ".join(f"exp(o{j} - {m})" for j in range(10)) + "))"
    pick = "CASE label " + " ".join(f"WHEN {j} THEN o{j}" for j in range(10)) + " END"
    am = "CASE " + " ".join(
        "WHEN " + " AND ".join([f"o{j} > o{i}" for i in range(j)] + [f"o{j} >= o{i}" for i in range(j + 1, 10)])
        + f" THEN {j}" for j in range(10)) + " END"
    return f"""
WITH o AS (SELECT label, {', '.join(f'{e} AS o{j}' for j, e in enumerate(out))} FROM embeddings)
SELECT label, count(*) AS n, round(avg(CASE WHEN {am} = label THEN 1.0 ELSE 0.0 END), 8) AS accuracy,
       round(avg({lse} - {pick}), 6) AS sparse_ce FROM o GROUP BY label
"""


@query("dense_scoring_wide", _wide_sql())
def dense_scoring_wide(spark, sf):
    """R2 with many weights (64-16-10): vectorised forward pass over Arrow batches; F5 argmax accuracy and
    E5 sparse categorical cross-entropy from logits, per label."""
    emb = tbl(spark, sf, "embeddings").select("label", *array_cols("embedding", 64, "e"))
    out = dn.forward(emb, [f"e{i}" for i in range(64)], WIDE, "o")
    logits = F.array(*[F.col(f"o{j}") for j in range(10)])
    s = out.select("label", logits.alias("lg"))
    return s.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        rnd(accuracy_expr(F.col("label"), fn.argmax("lg")), 8).alias("accuracy"),
        rnd(sparse_cross_entropy_expr("label", "lg"), 6).alias("sparse_ce"))


@query("mlp_classifier")
def mlp_classifier(spark, sf):
    """Pyspark.ml multilayer perceptron (64-16-10, sigmoid hidden, softmax output); training accuracy per label."""
    emb = tbl(spark, sf, "embeddings").select("label", *array_cols("embedding", 64, "e"))
    cols = [f"e{i}" for i in range(64)]
    model, data = dn.ml_mlp(emb, cols, "label", [16], 10, max_iter=50)
    pred = model.transform(data)
    return pred.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                     rnd(accuracy_expr(F.col("label"), F.col("prediction")), 6).alias("accuracy"))


def _reg_frame(spark, sf):
    li = tbl(spark, sf, "lineitem").select(*LI_X, (F.col(LI_Y) / 1000.0).alias("y"))
    z, _ = zscore(li, LI_X)
    return z


@query("dense_train")
def dense_train(spark, sf):
    """Data-parallel full-batch Adam (per-task numpy gradients, position-wise summed by Spark) on a 3-8-1 ReLU
    regression net; objective per step and the final halved MSE of the fitted net."""
    z = _reg_frame(spark, sf)
    layers = dn.init_layers([3, 8, 1], ["relu", "linear"], seed=0)
    fitted, hist = dn.train_full_batch(z, LI_X, "y", layers, loss="mse", lr=0.05, steps=10)
    mse = dn.forward(z, LI_X, fitted, "o").agg(halved_mse_expr("y", "o0")).first()[0]
    rows = [(int(i), round(v, 6)) for i, v in hist] + [(len(hist), round(float(mse), 6))]
    return spark.createDataFrame(rows, "step long, objective double")


# R5's other losses: literal start weights, Adam on two batches by hash, every step also unrolled in SQL.
LOSS_LR, LOSS_L2, LOSS_STEPS, LOSS_BATCHES = 0.05, 3.0, 4, 2
LOSS_NETS = {
    "logits_bce": [(rule_weights(3, 2, 5, 0.8), np.array([0.1, -0.05]), "relu"), (rule_weights(2, 1, 6, 0.8), np.array([0.02]), "linear")],
    "sparse_ce": [(rule_weights(3, 2, 7, 0.8), np.array([-0.1, 0.15]), "relu"), (rule_weights(2, 3, 8, 0.8), np.array([0.0, 0.1, -0.1]), "linear")],
}
LOSS_LABELS = {"logits_bce": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
               "sparse_ce": "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END"}


def _loss_sql() -> str:
    key = "concat_ws('-', l_orderkey, l_linenumber)"
    st = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
    parts = [f"s AS (SELECT {st} FROM lineitem)",
             "d AS MATERIALIZED (SELECT " + ", ".join(f"({c} - mu_{c}) / sd_{c} AS x{i}" for i, c in enumerate(LI_X))
             + f", ('0x' || substr(md5({key}), 1, 8))::BIGINT % 100 % {LOSS_BATCHES} AS batch, "
             + ", ".join(f"{sql} AS y_{n}" for n, sql in LOSS_LABELS.items()) + " FROM lineitem, s)"]
    outs = []
    for name, net in LOSS_NETS.items():
        (w1, b1, _), (w2, b2, _) = net
        k = w2.shape[1]
        at = {f"p{i}_{j}": w1[i, j] for i in range(3) for j in range(2)} | {f"c{j}": b1[j] for j in range(2)}
        at |= {f"q{j}_{o}": w2[j, o] for j in range(2) for o in range(k)} | {f"e{o}": b2[o] for o in range(k)}
        pen = [n for n in at if n[0] in "pq"]
        parts.append(f"{name}0 AS (SELECT " + ", ".join(f"{float(v)!r}::DOUBLE AS {n}, 0.0::DOUBLE AS m_{n}, 0.0::DOUBLE AS v_{n}" for n, v in at.items()) + ")")
        for t in range(1, LOSS_STEPS + 1):
            prev = f"{name}{t - 1}"
            z = ", ".join(f"c{j} + " + " + ".join(f"x{i} * p{i}_{j}" for i in range(3)) + f" AS z{j}" for j in range(2))
            o = ", ".join(f"e{u} + greatest(z0, 0) * q0_{u} + greatest(z1, 0) * q1_{u} AS o{u}" for u in range(k))
            if name == "logits_bce":
                loss, deltas = "greatest(o0, 0) - o0 * y + ln(1 + exp(-abs(o0)))", ["1 / (1 + exp(-o0)) - y"]
            else:
                den = " + ".join(f"exp(o{u})" for u in range(k))
                pick = "CASE y " + " ".join(f"WHEN {u} THEN o{u}" for u in range(k)) + " END"
                loss, deltas = f"ln({den}) - {pick}", [f"exp(o{u}) / ({den}) - CASE WHEN y = {u} THEN 1 ELSE 0 END" for u in range(k)]
            back = [f"CASE WHEN z{j} > 0 THEN " + " + ".join(f"d{u} * q{j}_{u}" for u in range(k)) + " ELSE 0 END AS h{j}".replace("{j}", str(j)) for j in range(2)]
            g = {f"p{i}_{j}": f"x{i} * h{j}" for i in range(3) for j in range(2)} | {f"c{j}": f"h{j}" for j in range(2)}
            g |= {f"q{j}_{u}": f"greatest(z{j}, 0) * d{u}" for j in range(2) for u in range(k)} | {f"e{u}": f"d{u}" for u in range(k)}
            sums = ", ".join(f"sum({e}) / count(*)" + (f" + {LOSS_L2!r} / count(*) * any_value({n})" if n in pen else "") + f" AS g_{n}" for n, e in g.items())
            sq = " + ".join(f"{n} * {n}" for n in pen)
            parts.append(f"{name}g{t} AS MATERIALIZED (SELECT {sums}, avg({loss}) + {LOSS_L2!r} / (2 * count(*)) * any_value({sq}) AS objective FROM ("
                         f"SELECT *, {', '.join(back)} FROM (SELECT *, {', '.join(f'{e} AS d{u}' for u, e in enumerate(deltas))} FROM ("
                         f"SELECT *, {o} FROM (SELECT *, {z} FROM (SELECT x0, x1, x2, y_{name} AS y FROM d WHERE batch = {(t - 1) % LOSS_BATCHES}), {prev})))))")
            alpha = LOSS_LR * math.sqrt(1 - dn.ADAM_B2 ** t) / (1 - dn.ADAM_B1 ** t)
            mv = ", ".join(f"{n}, m_{n} + (g_{n} - m_{n}) * {1 - dn.ADAM_B1!r} AS m_{n}, v_{n} + (g_{n} * g_{n} - v_{n}) * {1 - dn.ADAM_B2!r} AS v_{n}" for n in at)
            new = ", ".join(f"{n} - {alpha!r} * m_{n} / (sqrt(v_{n}) + {dn.ADAM_EPS!r}) AS {n}, m_{n}, v_{n}" for n in at)
            parts.append(f"{name}{t} AS MATERIALIZED (SELECT {new} FROM (SELECT {mv} FROM {prev}, {name}g{t}))")
            outs.append(f"SELECT '{name}' AS loss, 'objective_{t - 1}' AS term, round(objective, 7) AS value FROM {name}g{t}")
        outs += [f"SELECT '{name}', '{n}', round({n}, 7) FROM {name}{LOSS_STEPS}" for n in at]
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(outs)


@query("dense_train_losses", _loss_sql())
def dense_train_losses(spark, sf):
    """R5 with logits_bce (3-2-1) and sparse_ce (3-2-3): four Adam steps on two batches by hash from literal start weights, L2;
    objective of every step and the final weights."""
    li = tbl(spark, sf, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    d = li.select(*LI_X, key.alias("k"), *[F.expr(sql).alias(f"y_{n}") for n, sql in LOSS_LABELS.items()])
    z, _ = zscore(d, LI_X)
    rows = []
    for name, net in LOSS_NETS.items():
        fitted, hist = dn.train_batches(z, LI_X, f"y_{name}", net, name, LOSS_LR, LOSS_STEPS, LOSS_L2,
                                        hash_bucket("k") % LOSS_BATCHES, LOSS_BATCHES)
        rows += [(name, f"objective_{i}", round(v, 7)) for i, v in hist]
        (w1, b1, _), (w2, b2, _) = fitted
        at = {f"p{i}_{j}": w1[i, j] for i in range(3) for j in range(2)} | {f"c{j}": b1[j] for j in range(2)}
        at |= {f"q{j}_{o}": w2[j, o] for j in range(2) for o in range(w2.shape[1])} | {f"e{o}": b2[o] for o in range(w2.shape[1])}
        rows += [(name, n, round(float(v), 7)) for n, v in at.items()]
    return spark.createDataFrame(rows, "loss string, term string, value double")


@query("dense_lambda_sweep")
def dense_lambda_sweep(spark, sf):
    """The R5 network trained with L2 strength 0, 1 and 10; final objective and halved MSE per strength."""
    z = _reg_frame(spark, sf).cache()
    rows = []
    for lam in (0.0, 1.0, 10.0):
        layers = dn.init_layers([3, 8, 1], ["relu", "linear"], seed=0)
        fitted, hist = dn.train_full_batch(z, LI_X, "y", layers, loss="mse", lr=0.05, steps=5, l2=lam)
        mse = dn.forward(z, LI_X, fitted, "o").agg(halved_mse_expr("y", "o0")).first()[0]
        rows.append((lam, round(hist[-1][1], 6), round(float(mse), 6)))
    z.unpersist()
    return spark.createDataFrame(rows, "l2 double, final_objective double, train_mse_half double")
