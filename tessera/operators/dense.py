"""Dense networks as table jobs.

Scoring (R1/R2): with few weights each unit is a generated column
expression g(sum_i a_i W_ij + b_j) and the whole stack stays inside
whole-stage codegen.  With many weights a single expression would not fit a
compiled method, so the forward pass runs as a vectorised pandas UDF over
Arrow batches with the weights in its closure.

Training (R5): data-parallel Adam on all rows or on deterministic mini-batches.
Each step ships the current weights to the tasks; every task returns the summed
loss and gradient of its rows as one array, the arrays are added over a tree of
tasks, and the driver applies the Adam update to a parameter vector whose size is
the model's, not the data's.
"""

import math
import sys
from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import ACTIVATIONS, activation_sql, dot_sql
from ..session import working_set
from .moments import sum_vectors

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

MAX_EXPR_TERMS = 256
LAYER_ACTIVATIONS = ("relu", "sigmoid", "linear", "softmax")
ADAM_B1, ADAM_B2, ADAM_EPS = 0.9, 0.999, 1e-7


def _np_act(name: str, z: np.ndarray) -> np.ndarray:
    if name == "relu":
        return np.maximum(z, 0.0)
    if name == "sigmoid":
        return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    if name == "softmax":
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)
    if name == "linear":
        return z
    raise ValueError(name)


def _layer_exprs(activation: str, zs: Sequence[str]) -> list[str]:
    """Outputs of a layer as SQL over the columns that hold its weighted sums."""
    if activation != "softmax":
        return [activation_sql(activation, z) for z in zs]
    top = f"greatest({', '.join(zs)})" if len(zs) > 1 else zs[0]
    total = " + ".join(f"exp({z} - {top})" for z in zs)
    return [f"exp({z} - {top}) / ({total})" for z in zs]


def forward(df: DataFrame, in_cols: Sequence[str], layers: Sequence[tuple], out_prefix: str = "out") -> DataFrame:
    """R2: apply a stack of (W, b, activation) layers; outputs out0..out{m-1}.

    Activations: relu, sigmoid, linear, softmax; others raise.  A null input makes every output null, a
    NaN input follows the arithmetic; both hold whatever the size of the stack."""
    for _, _, a in layers:
        if a not in LAYER_ACTIVATIONS:
            raise ValueError(f"unknown activation {a!r}")
    layers = [(np.asarray(w, dtype=float), np.asarray(b, dtype=float), a) for w, b, a in layers]
    terms = sum(w.size for w, _, _ in layers)
    m = layers[-1][0].shape[1]
    if terms <= MAX_EXPR_TERMS:
        # one SQL expression per unit; hidden units become columns the next layer names
        cur, out = list(in_cols), df
        for li, (w, b, a) in enumerate(layers):
            last = li == len(layers) - 1
            names = [f"{out_prefix}{j}" if last else f"_{out_prefix}_h{li}_{j}" for j in range(w.shape[1])]
            zs = [f"_{out_prefix}_h{li}_z{j}" for j in range(w.shape[1])]
            out = out.withColumns({z: F.expr(dot_sql(cur, w[:, j], b[j])) for j, z in enumerate(zs)})
            out = out.withColumns({n: F.expr(e) for n, e in zip(names, _layer_exprs(a, zs), strict=True)})
            cur = names
        return out.drop(*[c for c in out.columns if c.startswith(f"_{out_prefix}_h")])

    @F.pandas_udf("array<double>")
    def forward_batch(x: pd.Series) -> pd.Series:
        a = np.stack(x.to_numpy()).astype(float)
        for w, b, act in layers:
            a = _np_act(act, a @ w + b)
        return pd.Series(list(a))

    tmp = df.withColumn("_fwd", forward_batch(F.array(*[F.col(c).cast("double") for c in in_cols])))
    whole = reduce(lambda p, q: p & q, [F.col(c).isNotNull() for c in in_cols])
    return tmp.withColumns({f"{out_prefix}{j}": F.when(whole, F.coalesce(F.col("_fwd")[j], F.lit(float("nan"))))
                            for j in range(m)}).drop("_fwd")


# --- R5: data-parallel full-batch training ------------------------------------

def init_layers(sizes: Sequence[int], acts: Sequence[str], seed: int = 0) -> list:
    """Glorot-uniform weights from a seeded numpy generator (driver side,
    size of the model only), zero biases."""
    rng = np.random.default_rng(seed)
    out = []
    for n_in, n_out, a in zip(sizes[:-1], sizes[1:], acts):
        lim = math.sqrt(6.0 / (n_in + n_out))
        out.append((rng.uniform(-lim, lim, size=(n_in, n_out)), np.zeros(n_out), a))
    return out


def _flatten(layers) -> np.ndarray:
    return np.concatenate([np.concatenate([w.ravel(), b.ravel()]) for w, b, _ in layers])


def _unflatten(vec: np.ndarray, like) -> list:
    out, pos = [], 0
    for w, b, a in like:
        nw = w.size
        out.append((vec[pos:pos + nw].reshape(w.shape), vec[pos + nw:pos + nw + b.size].copy(), a))
        pos += nw + b.size
    return out


def batch_loss_grad(x: np.ndarray, y: np.ndarray, layers, loss: str) -> tuple[float, np.ndarray]:
    """Summed loss and gradient of one batch (numpy backprop)."""
    acts, zs = [x], []
    a = x
    for w, b, act in layers:
        z = a @ w + b
        zs.append(z)
        a = _np_act(act, z)
        acts.append(a)
    out = zs[-1] if loss in ("logits_bce", "sparse_ce") else acts[-1]
    if loss == "mse":
        diff = out[:, 0] - y
        total = float(0.5 * np.sum(diff * diff))
        delta = diff[:, None]
    elif loss == "logits_bce":
        z = out[:, 0]
        total = float(np.sum(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))))
        delta = (1.0 / (1.0 + np.exp(-z)) - y)[:, None]
    elif loss == "sparse_ce":
        m = out.max(axis=1, keepdims=True)
        e = np.exp(out - m)
        p = e / e.sum(axis=1, keepdims=True)
        idx = y.astype(int)
        total = float(-np.sum(np.log(p[np.arange(len(idx)), idx])))
        delta = p
        delta[np.arange(len(idx)), idx] -= 1.0
    else:
        raise ValueError(loss)
    grads = []
    for li in range(len(layers) - 1, -1, -1):
        w, _, act = layers[li]
        if li != len(layers) - 1 or loss == "mse":
            if act == "relu":
                delta = delta * (zs[li] > 0)
            elif act == "sigmoid":
                s = acts[li + 1]
                delta = delta * s * (1 - s)
        grads.append((acts[li].T @ delta, delta.sum(axis=0)))
        delta = delta @ w.T
    grads.reverse()
    return total, np.concatenate([np.concatenate([gw.ravel(), gb.ravel()]) for gw, gb in grads])


def train_batches(df: DataFrame, in_cols: Sequence[str], label: str, layers, loss: str = "mse", lr: float = 0.01,
                  steps: int = 10, l2: float = 0.0, batch: Column | None = None, batches: int = 1):
    """Adam on mini-batches.  ``batch`` numbers a row's batch from 0 (a function of the row, so batches are the
    same on every run); step t uses batch t mod ``batches``.  Without it every step uses all rows.

    The loss (mse, logits_bce, sparse_ce) is one Spark job per step: every task returns the sums of its rows as one
    array, arrays are added over a tree of tasks.  The objective is mean loss + l2/(2m) * sum W^2 (biases
    unpenalised), m the batch's rows.  Rows with a missing value are left out; an empty batch changes nothing.
    Returns (layers, history[(step, objective before the step, on its batch)])."""
    number = F.lit(0) if batch is None else batch.cast("int")
    cols = list(in_cols)
    data = working_set(df.select(number.alias("_b"), F.col(label).cast("double").alias("_y"),
                                 *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]).dropna())
    theta = _flatten(layers)
    mom, vel = np.zeros_like(theta), np.zeros_like(theta)
    is_w = _flatten([(np.ones_like(w), np.zeros_like(b), a) for w, b, a in layers])
    history = []
    try:
        for t in range(1, steps + 1):
            current = _unflatten(theta, layers)

            def part(it, current=current):
                total = None
                for b in it:
                    if not b.num_rows:
                        continue
                    y, *x = (b.column(i).to_numpy(zero_copy_only=False) for i in range(1, b.num_columns))
                    lsum, g = batch_loss_grad(np.column_stack(x), y, current, loss)
                    v = np.concatenate([[float(b.num_rows), lsum], g])
                    total = v if total is None else total + v
                if total is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

            rows = data.where(F.col("_b") == (t - 1) % batches)
            m, loss_sum, *grad = sum_vectors(rows.mapInArrow(part, "v array<double>"), len(theta) + 2)
            if not m:
                continue
            grad = np.array(grad) / m + (l2 / m) * theta * is_w
            history.append((t - 1, float(loss_sum / m + l2 / (2 * m) * float(np.sum((theta * is_w) ** 2)))))
            mom = mom + (grad - mom) * (1 - ADAM_B1)
            vel = vel + (grad * grad - vel) * (1 - ADAM_B2)
            alpha = lr * math.sqrt(1 - ADAM_B2 ** t) / (1 - ADAM_B1 ** t)
            theta = theta - alpha * mom / (np.sqrt(vel) + ADAM_EPS)
    finally:
        data.unpersist()
    return _unflatten(theta, layers), history


def train_full_batch(df: DataFrame, in_cols: Sequence[str], label: str, layers, loss: str = "mse",
                     lr: float = 0.01, steps: int = 10, l2: float = 0.0):
    """R5 with every step over all rows."""
    return train_batches(df, in_cols, label, layers, loss, lr, steps, l2)


def ml_mlp(df: DataFrame, in_cols: Sequence[str], label: str, hidden: Sequence[int], n_classes: int,
           max_iter: int = 100, seed: int = 1):
    """Pyspark.ml MultilayerPerceptronClassifier (sigmoid hidden layers,
    softmax output, L-BFGS): the same model family, not the same weights."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=list(in_cols), outputCol="_features").transform(
        df.select(*in_cols, F.col(label).cast("double").alias(label)))
    mlp = MultilayerPerceptronClassifier(featuresCol="_features", labelCol=label,
                                         layers=[len(in_cols), *hidden, n_classes], maxIter=max_iter, seed=seed)
    return mlp.fit(data), data
