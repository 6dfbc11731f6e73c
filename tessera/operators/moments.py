"""Moment aggregate and the algebra that lives on it.

One Spark aggregate computes, for feature columns x_1..x_d and a label y,
the row count, the means and the population covariance matrix of
[x, y].  Partial states are merged with the stable pairwise update, so the
moments do not lose digits the way raw sum-of-products would on large data.
Few columns are one hash aggregate (``covar_pop`` of every pair); many columns
go through Arrow batches, whose states (n, means, centred X'X) are one matrix
product each and are merged task by task and then over a tree of tasks, so
neither plan nor time grows with the number of column pairs.  Either way
rows with a missing value in any of the columns are left out, and each task
ships one state whatever the input size or key skew.

Everything downstream (linear cost, gradient, gradient descent, least
squares, ridge, cost surfaces, degree and lambda sweeps) is d x d algebra
on the driver: its size depends on the number of features, never on rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of the package

# Above so many columns the aggregate is made of matrix products: d (d + 1) / 2
# covariance expressions would outgrow a compiled method (8,000 bytes of code, beyond which it is interpreted).
WIDE = 6
TREE = (64, 8, 1)  # tasks per level of the merge of states


# Names of derived columns and the function that makes them, in the tasks, of the matrix of the features.
Terms = tuple[Sequence[str], Callable[[np.ndarray], np.ndarray]]


@dataclass
class Moments:
    """Moments of columns ``names`` (features first, label last if any)."""

    names: list[str]
    n: int
    mean: np.ndarray
    cov: np.ndarray
    has_label: bool = True

    @property
    def d(self) -> int:
        return len(self.names) - (1 if self.has_label else 0)

    @property
    def mu_x(self) -> np.ndarray:
        return self.mean[: self.d]

    @property
    def mu_y(self) -> float:
        return float(self.mean[self.d])

    @property
    def cxx(self) -> np.ndarray:
        return self.cov[: self.d, : self.d]

    @property
    def cxy(self) -> np.ndarray:
        return self.cov[: self.d, self.d]

    @property
    def cyy(self) -> float:
        return float(self.cov[self.d, self.d])

    def second_moment(self) -> np.ndarray:
        """E[v v^T] = cov + mu mu^T."""
        return self.cov + np.outer(self.mean, self.mean)

    def select(self, idx: Sequence[int]) -> "Moments":
        """Moments of a subset of the features (label kept)."""
        keep = list(idx) + ([self.d] if self.has_label else [])
        return Moments([self.names[i] for i in keep], self.n, self.mean[keep],
                       self.cov[np.ix_(keep, keep)], self.has_label)


def _pair_alias(i: int, j: int) -> str:
    return f"_c_{i}_{j}"


def moment_exprs(cols: Sequence[Column | str]) -> list[Column]:
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    exprs = [F.count(F.lit(1)).alias("_n")]
    exprs += [F.avg(c).alias(f"_m_{i}") for i, c in enumerate(cs)]
    for i in range(len(cs)):
        for j in range(i, len(cs)):
            exprs.append(F.covar_pop(cs[i], cs[j]).alias(_pair_alias(i, j)))
    return exprs


def _from_row(row, names: list[str], has_label: bool) -> Moments:
    k = len(names)
    mean = np.array([row[f"_m_{i}"] for i in range(k)], dtype=float)
    cov = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            cov[i, j] = cov[j, i] = row[_pair_alias(i, j)]
    return Moments(list(names), int(row["_n"]), mean, cov, has_label)


class _State:
    """Running n, means and centred sums of products of one group."""

    def __init__(self, k: int) -> None:
        self.n, self.mean, self.m2 = 0, np.zeros(k), np.zeros((k, k))

    def add(self, n: int, mean: np.ndarray, m2: np.ndarray) -> None:
        if not n:
            return
        total = self.n + n
        delta = mean - self.mean
        self.m2 += m2 + np.outer(delta, delta) * (self.n * n / total)
        self.mean = self.mean + delta * (n / total)
        self.n = total


def _states(rows: DataFrame, names: Sequence[str], width: int, terms: Terms | None, label: int) -> DataFrame:
    """One row (grp, n, mean, m2) per task and group of ``rows`` (grp, then ``names`` as doubles without nulls, the last
    ``label`` of them labels); with ``terms`` of the columns made of the features.  ``width``: columns in a state."""
    k = len(names)
    make = terms[1] if terms else None

    def run(batches):
        held: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(k)]).astype(float)
            if make:
                x = np.column_stack([make(x[:, : k - label]), x[:, k - label:]])
            keys, of = np.unique(b.column(0).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for i, key in enumerate(keys.tolist()):
                part = x if len(keys) == 1 else x[of == i]
                mean = part.mean(axis=0)
                part = part - mean
                held.setdefault(key, _State(width)).add(len(part), mean, part.T @ part)
        yield from _packed(held)

    return rows.mapInArrow(run, "grp string, n long, mean binary, m2 binary")


def _packed(held: dict):
    for key, st in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([st.n], pa.int64()), pa.array([st.mean.tobytes()], pa.binary()),
                                          pa.array([st.m2.tobytes()], pa.binary())], names=["grp", "n", "mean", "m2"])


def _merged(states: DataFrame, k: int) -> DataFrame:
    """Tree merge: each level's tasks add the states they receive one by one, holding one state per group."""
    def run(batches):
        held: dict = {}
        for b in batches:
            for key, n, mean, m2 in zip(*[b.column(i).to_pylist() for i in range(4)], strict=True):
                held.setdefault(key, _State(k)).add(n, np.frombuffer(mean), np.frombuffer(m2).reshape(k, k))
        yield from _packed(held)

    for tasks in TREE:
        states = states.repartition(tasks).mapInArrow(run, "grp string, n long, mean binary, m2 binary")
    return states


def sum_vectors(parts: DataFrame, size: int) -> np.ndarray:
    """The sum of all rows' array ``v`` (``size`` doubles): tasks add what they receive one by one, over a tree of
    tasks; one vector reaches the driver."""
    def run(batches):
        total = None
        for b in batches:
            if b.num_rows:
                part = np.asarray(b.column(0).flatten(), dtype=float).reshape(b.num_rows, size).sum(axis=0)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["v"])

    for tasks in TREE[1:]:
        parts = parts.repartition(tasks).mapInArrow(run, "v array<double>")
    got = parts.collect()
    return np.array(got[0]["v"]) if got else np.zeros(size)


def _wide_moments(rows: DataFrame, names: list[str], has_label: bool, terms: Terms | None = None) -> dict[str, Moments]:
    """Moments per ``grp`` (a string) by batched matrix products; d x d numbers per group reach the driver."""
    made = [*terms[0], *names[len(names) - has_label:]] if terms else names
    k = len(made)
    full = rows.select("grp", *[F.col(c).cast("double").alias(c) for c in names]).dropna(subset=names)
    out = {}
    for r in _merged(_states(full, names, k, terms, int(has_label)), k).collect():
        m2 = np.frombuffer(r["m2"]).reshape(k, k)
        out[r["grp"]] = Moments(made, r["n"], np.frombuffer(r["mean"]).copy(), (m2 + m2.T) / (2.0 * r["n"]), has_label)
    return out


def compute_moments(df: DataFrame, features: Sequence[str], label: str | None = None, wide: int = WIDE,
                    terms: Terms | None = None) -> Moments:
    """One aggregate job -> Moments on the driver (size O(d^2)).  ``terms``: of columns made of the features instead."""
    names = list(features) + ([label] if label else [])
    if terms or len(names) > wide:
        found = _wide_moments(df.select(F.lit("").alias("grp"), *names), names, label is not None, terms)
        if not found:
            raise ValueError("no rows")
        return found[""]
    row = df.select(*names).dropna().agg(*moment_exprs(names)).first()
    if row["_n"] == 0:
        raise ValueError("no rows")
    return _from_row(row, names, label is not None)


def compute_moments_by(df: DataFrame, key: str, features: Sequence[str], label: str | None = None,
                       max_groups: int = 10_000, wide: int = WIDE) -> dict:
    """A7 per group of a low-cardinality key (e.g. the split label): one job,
    one row per group (partial aggregation keeps skewed groups cheap).  More than
    ``max_groups`` groups, which would not fit the driver, raise."""
    names = list(features) + ([label] if label else [])
    if len(names) > wide:
        ids = df.select(key).distinct().limit(max_groups + 1).collect()
        rows = df.select(F.col(key).cast("string").alias("grp"), *names)
        found = _wide_moments(rows, names, label is not None) if len(ids) <= max_groups else {}
        by_text = {str(r[0]): r[0] for r in ids}
        got = {by_text[g]: m for g, m in found.items()}
    else:
        ids = (df.select(key, *names).dropna(subset=names).groupBy(key).agg(*moment_exprs(names))
               .limit(max_groups + 1).collect())
        got = {r[key]: _from_row(r, names, label is not None) for r in ids}
    if len(ids) > max_groups:
        raise ValueError(f"more than {max_groups} groups of {key}")
    return got


# --- errors of many candidate models in one scan (M3, E6, E7, E9, E10) --------

MAX_TERMS = 32  # products in one aggregate; more outgrow a compiled method, as above


def residual_costs(df: DataFrame, features: Sequence[str], label: str, candidates: Sequence[tuple[Sequence[float], float]],
                   group: str | None = None, max_terms: int = MAX_TERMS, terms: Terms | None = None) -> dict:
    """group -> [1/(2m) sum (w.x + b - y)^2 for every candidate (w, b)], from the rows themselves in one scan.

    Sums of squared residuals are never negative and keep their digits where the fit is close, which the quadratic form of
    the moments does not.  A candidate with fewer weights than features uses the first ones.  Up to ``max_terms``
    products are expressions of one aggregate; more go through Arrow batches (one matrix product a batch),
    each task shipping one row per group.  With ``terms`` the candidates weigh columns made of the features."""
    cols = list(features)
    make = terms[1] if terms else None
    key = F.col(group) if group else F.lit(None).cast("string")
    rows = df.select(key.alias("_g"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)],
                     F.col(label).cast("double").alias("_y")).dropna(subset=[*[f"_x{i}" for i in range(len(cols))], "_y"])
    if not terms and sum(len(w) for w, _ in candidates) <= max_terms:
        def error(w, b) -> Column:
            e = sum((F.lit(float(x)) * F.col(f"_x{i}") for i, x in enumerate(w)), F.lit(0.0)) + F.lit(float(b)) - F.col("_y")
            return e * e
        got = rows.groupBy("_g").agg(*[F.avg(error(w, b)).alias(f"c{i}") for i, (w, b) in enumerate(candidates)]).collect()
        return {r["_g"]: [0.5 * r[f"c{i}"] for i in range(len(candidates))] for r in got}
    weights = np.zeros((len(terms[0]) if terms else len(cols), len(candidates)))
    for i, (w, _) in enumerate(candidates):
        weights[: len(w), i] = w
    bias = np.array([b for _, b in candidates], dtype=float)

    def run(batches):
        held: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = np.column_stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(cols))])
            x = make(x) if make else x
            e = x @ weights + bias - b.column(len(cols) + 1).to_numpy(zero_copy_only=False)[:, None]
            seen: dict = {}
            of = np.array([seen.setdefault(g, len(seen)) for g in b.column(0).to_pylist()])
            for g, i in seen.items():
                part = e[of == i]
                n, total = held.get(g, (0, 0.0))
                held[g] = n + len(part), total + (part * part).sum(axis=0)
        for g, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([g], b.column(0).type), pa.array([n], pa.int64()), pa.array([total], pa.list_(pa.float64()))],
                                             names=["_g", "n", "s"])

    kind = rows.schema["_g"].dataType.simpleString()
    parts = rows.mapInArrow(run, f"_g {kind}, n long, s array<double>")
    long = parts.select("_g", "n", F.posexplode("s").alias("i", "v"))
    got = long.groupBy("_g", "i").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    out: dict = {}
    for r in got:
        out.setdefault(r["_g"], [0.0] * len(candidates))[r["i"]] = 0.5 * r["v"] / r["n"]
    return out


# --- linear model algebra on moments (M3, M6, M10, M11, E8) -----------------

def linear_cost(m: Moments, w: Sequence[float], b: float, lam: float = 0.0) -> float:
    """M3: 1/(2m) sum (w.x+b-y)^2 + lam/(2m) sum w^2 from moments, for cost histories.  The quadratic form cancels
    where the fit is close (never below 0 here); ``residual_costs`` gives such costs from the rows."""
    w = np.asarray(w, dtype=float)
    bias = float(w @ m.mu_x + b - m.mu_y)
    var = float(w @ m.cxx @ w - 2.0 * w @ m.cxy + m.cyy)
    return 0.5 * (max(var, 0.0) + bias * bias) + lam / (2.0 * m.n) * float(w @ w)


def linear_gradient(m: Moments, w: Sequence[float], b: float, lam: float = 0.0) -> tuple[np.ndarray, float]:
    """M6: (dJ/dw, dJ/db) = (E[e x] + lam/m w, E[e]) with e = w.x+b-y."""
    w = np.asarray(w, dtype=float)
    mean_err = float(w @ m.mu_x + b - m.mu_y)
    dw = m.cxx @ w - m.cxy + m.mu_x * mean_err + (lam / m.n) * w
    return dw, mean_err


def gradient_descent_on_moments(m: Moments, w0: Sequence[float], b0: float, alpha: float, iters: int,
                                lam: float = 0.0, decay_points: int = 0, decay_digits: int | None = None,
                                floor: float | None = None) -> tuple[np.ndarray, float, list]:
    """M8 (linear): the reference's simultaneous update, iterated on the moments.

    Returns (w, b, history) with a history row (iter, cost, w, b, alpha) per iteration.  ``decay_points`` > 0 turns on M9: at
    that many evenly spaced progress points (every ceil(iters / points) iterations), alpha is divided by 10
    for what follows when the cost is the one of the point before (``decay_digits``: rounded so far).  With
    ``floor``, the least-squares cost from the rows, a cost is floor plus a quadratic form around the least-squares
    solution: a sum of terms that are not negative, so nothing cancels.
    """
    w = np.asarray(w0, dtype=float).copy()
    b = float(b0)
    best = None if floor is None else least_squares(m)

    def cost() -> float:
        if best is None:
            return linear_cost(m, w, b, lam)
        dw = w - best[0]
        shift = float(dw @ m.mu_x + b - best[1])
        return floor + 0.5 * (float(dw @ m.cxx @ dw) + shift * shift) + lam / (2.0 * m.n) * float(w @ w)

    hist = []
    every = -(-iters // decay_points) if decay_points else 0
    last_cost = None
    for i in range(iters):
        dw, db = linear_gradient(m, w, b, lam)
        w = w - alpha * dw
        b = b - alpha * db
        hist.append((i, cost(), w.tolist(), b, alpha))
        if every and i % every == 0:
            now = hist[-1][1] if decay_digits is None else round(hist[-1][1], decay_digits)
            if now == last_cost:
                alpha /= 10.0
            last_cost = now
    return w, b, hist


def least_squares(m: Moments) -> tuple[np.ndarray, float]:
    """w = Cxx^-1 Cxy, b = mu_y - w.mu_x (intercept fitted)."""
    w = np.linalg.solve(m.cxx, m.cxy)
    return w, float(m.mu_y - w @ m.mu_x)


def ridge(m: Moments, alpha: float) -> tuple[np.ndarray, float]:
    """Minimise SSE + alpha*||w||^2 with a free intercept:
    w = (m*Cxx + alpha I)^-1 m*Cxy."""
    a = m.n * m.cxx + alpha * np.eye(m.d)
    w = np.linalg.solve(a, m.n * m.cxy)
    return w, float(m.mu_y - w @ m.mu_x)


def fit_line(m: Moments) -> tuple[float, float]:
    """One-feature least squares (regr_slope / regr_intercept)."""
    slope = float(m.cxy[0] / m.cxx[0, 0])
    return slope, float(m.mu_y - slope * m.mu_x[0])


def merge(a: Moments, b: Moments) -> Moments:
    """Moments of the union of two disjoint row sets (Chan et al. pairwise update)."""
    n = a.n + b.n
    delta = b.mean - a.mean
    mean = a.mean + delta * (b.n / n)
    cov = (a.n * a.cov + b.n * b.cov) / n + np.outer(delta, delta) * (a.n * b.n / (n * n))
    return Moments(a.names, n, mean, cov, a.has_label)


def standardize(m: Moments, stats: dict[str, tuple[float, float]]) -> Moments:
    """Moments of z-scored features (x - mu)/sd given scaler statistics,
    derived exactly without another pass: mean' = (mean-mu)/sd, cov' = D cov D."""
    scale = np.ones(len(m.names))
    shift = np.zeros(len(m.names))
    for i, name in enumerate(m.names[: m.d]):
        mu, sd = stats[name]
        scale[i] = 1.0 / sd
        shift[i] = mu
    mean = (m.mean - shift) * scale
    cov = m.cov * np.outer(scale, scale)
    return Moments(m.names, m.n, mean, cov, m.has_label)


def scaler_from(m: Moments) -> dict[str, tuple[float, float]]:
    """Population z-score statistics of the features, read off the moments."""
    return {name: (float(m.mean[i]), float(np.sqrt(m.cov[i, i]))) for i, name in enumerate(m.names[: m.d])}
