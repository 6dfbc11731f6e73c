"""Column-returning math.

Everything here builds a ``Column`` expression so that Catalyst sees the
arithmetic and whole-stage codegen compiles it; nothing is a Python UDF.
Two shapes are supported: a list of scalar columns (generated sums, fully
codegen'd) and ``ARRAY<DOUBLE>`` columns (higher-order functions).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clipping bound of the overflow-safe sigmoid and the switch
# point of log(1+e^x) stated by the reference.
SIGMOID_CLIP = 500.0
LOG1PEXP_MAX = 20.0


def qname(name: str) -> str:
    """A column name quoted for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def num(x: float) -> str:
    """A double literal for SQL text that parses back to exactly ``x``."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def _names(cols) -> bool:
    return all(isinstance(c, str) for c in cols)


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def sigmoid(z, clip: bool = True) -> Column:
    """1/(1+e^-z); with ``clip`` z is limited to [-500, 500] first."""
    z = _c(z)
    if clip:  # greatest and least skip nulls and rank NaN highest: a missing input stays missing
        z = F.when(z.isNull() | F.isnan(z), z).otherwise(
            F.greatest(F.least(z, F.lit(SIGMOID_CLIP)), F.lit(-SIGMOID_CLIP)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log_1pexp(x, maximum: float = LOG1PEXP_MAX) -> Column:
    """ln(1+e^x), or x itself when x > maximum."""
    x = _c(x)
    return F.when(x <= F.lit(maximum), F.log1p(F.exp(x))).otherwise(x)


def relu(z) -> Column:
    """F3; null stays null."""
    z = _c(z)
    return F.when(z.isNotNull(), F.greatest(z, F.lit(0.0)))


def linear(z) -> Column:
    return _c(z)


ACTIVATIONS = {"sigmoid": sigmoid, "relu": relu, "linear": linear}


def activation_sql(name: str, z: str) -> str:
    """F1 / F3 / linear as SQL text around the expression ``z``."""
    if name == "relu":
        return f"nvl2({z}, greatest({z}, {num(0.0)}), NULL)"
    if name == "sigmoid":
        clipped = f"greatest(least({z}, {num(SIGMOID_CLIP)}), {num(-SIGMOID_CLIP)})"
        return f"({num(1.0)} / ({num(1.0)} + exp(-if({z} IS NULL OR isnan({z}), {z}, {clipped}))))"
    if name == "linear":
        return z
    raise ValueError(name)


def _elems(a: Column, n: int) -> list[Column]:
    return [a.getItem(i) for i in range(n)]


def softmax(arr, n: int | None = None) -> Column:
    """F4 on an array column; max-shifted (same value, no overflow).  With a
    known length ``n`` the result is built element-wise (compiled code)
    instead of with higher-order functions (interpreted)."""
    a = _c(arr)
    if n is not None:
        xs = _elems(a, n)
        m = F.greatest(*xs) if n > 1 else xs[0]
        ex = [F.exp(x - m) for x in xs]
        tot = reduce(lambda p, q: p + q, ex)
        return F.array(*[e / tot for e in ex])
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)


def argmax(arr) -> Column:
    """0-based position of the first maximum."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argmin(arr) -> Column:
    a = _c(arr)
    return (F.array_position(a, F.array_min(a)) - 1).cast("int")


def dot_sql(cols: Sequence[str], weights: Sequence[float], bias: float = 0.0) -> str:
    return "(" + " + ".join([num(bias)] + [f"{qname(c)} * {num(w)}" for c, w in zip(cols, weights)]) + ")"


def dot(cols: Sequence, weights: Sequence[float], bias: float = 0.0) -> Column:
    """F6 / M1 on scalar columns: b + sum_j w_j*x_j as one generated sum.
    For named columns the sum is handed to Spark as one SQL expression
    (one call instead of several per term)."""
    if _names(cols):
        return F.expr(dot_sql(cols, weights, bias))
    terms = [_c(c) * F.lit(float(w)) for c, w in zip(cols, weights)]
    return reduce(lambda a, b: a + b, terms, F.lit(float(bias)))


def array_dot(a, b, n: int | None = None) -> Column:
    """F6 on two array columns (element-wise expression when ``n`` is known)."""
    if n is not None:
        return reduce(lambda p, q: p + q, [x * y for x, y in zip(_elems(_c(a), n), _elems(_c(b), n))])
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def sq_dist_sql(cols: Sequence[str], point: Sequence[float]) -> str:
    return "(" + " + ".join(f"({qname(c)} - {num(p)}) * ({qname(c)} - {num(p)})" for c, p in zip(cols, point)) + ")"


def sq_dist_cols(cols: Sequence, point: Sequence[float]) -> Column:
    """squared L2 distance of scalar columns to a literal point."""
    if _names(cols):
        return F.expr(sq_dist_sql(cols, point))
    terms = [(_c(c) - F.lit(float(p))) * (_c(c) - F.lit(float(p))) for c, p in zip(cols, point)]
    return reduce(lambda a, b: a + b, terms)


def array_sq_dist(a, b, n: int | None = None) -> Column:
    """F7 on array columns (element-wise expression when ``n`` is known)."""
    if n is not None:
        return reduce(lambda p, q: p + q, [(x - y) * (x - y) for x, y in zip(_elems(_c(a), n), _elems(_c(b), n))])
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def array_norm(a, n: int | None = None) -> Column:
    return F.sqrt(array_dot(a, a, n))


def l2_normalize(a, eps: float = 1e-12, n: int | None = None) -> Column:
    """F8: v / max(||v||, sqrt(eps)) (the usual l2_normalize guard)."""
    a = _c(a)
    norm = F.greatest(array_norm(a, n), F.lit(eps ** 0.5))
    if n is not None:
        return F.array(*[x / norm for x in _elems(a, n)])
    return F.transform(a, lambda x: x / norm)


def binary_entropy(p) -> Column:
    """-p log2 p - (1-p) log2 (1-p); 0 at p in {0,1} and for null (empty set)."""
    p = _c(p)
    h = -p * F.log2(p) - (F.lit(1.0) - p) * F.log2(F.lit(1.0) - p)
    return F.when(p.isNull() | (p <= 0.0) | (p >= 1.0), F.lit(0.0)).otherwise(h)


def array_cols(arr, n: int, prefix: str) -> list[Column]:
    """Spread the first n array elements into scalar columns prefix0..prefix{n-1}."""
    a = _c(arr)
    return [a.getItem(i).cast("double").alias(f"{prefix}{i}") for i in range(n)]
