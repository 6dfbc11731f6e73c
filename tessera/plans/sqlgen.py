"""SQL text helpers for the oracle side (closed-form solves on moments)."""

from __future__ import annotations

import itertools


def _perm_sign(p) -> int:
    s = 1
    p = list(p)
    for i in range(len(p)):
        for j in range(i + 1, len(p)):
            if p[i] > p[j]:
                s = -s
    return s


def det_sql(mat: list[list[str]]) -> str:
    """Leibniz determinant of a small matrix of SQL expressions."""
    n = len(mat)
    terms = []
    for p in itertools.permutations(range(n)):
        prod = " * ".join(f"({mat[i][p[i]]})" for i in range(n))
        terms.append(("+ " if _perm_sign(p) > 0 else "- ") + prod)
    return "(" + " ".join(terms) + ")"


def cramer_sql(a: list[list[str]], rhs: list[str]) -> list[str]:
    """Solutions of a x = rhs (n <= 4) as SQL expressions."""
    n = len(a)
    d = det_sql(a)
    out = []
    for k in range(n):
        ak = [[rhs[i] if j == k else a[i][j] for j in range(n)] for i in range(n)]
        out.append(f"({det_sql(ak)} / {d})")
    return out


def moments_select(xs: list[str], y: str) -> str:
    """avg / covar_pop select list over x0..x{d-1} and y (names m_i, c_i_j, c_i_y, my)."""
    parts = ["count(*) AS n"] + [f"avg({x}) AS m_{i}" for i, x in enumerate(xs)] + [f"avg({y}) AS m_y"]
    for i in range(len(xs)):
        for j in range(i, len(xs)):
            parts.append(f"covar_pop({xs[i]}, {xs[j]}) AS c_{i}_{j}")
        parts.append(f"covar_pop({xs[i]}, {y}) AS c_{i}_y")
    parts.append(f"var_pop({y}) AS c_y_y")
    return ", ".join(parts)


def cov_name(i: int, j: int) -> str:
    return f"c_{min(i, j)}_{max(i, j)}"


def ols_weights_sql(d: int, ridge_alpha: float | None = None) -> list[str]:
    """w_i of least squares (or ridge with SSE + alpha||w||^2) from moments_select names."""
    if ridge_alpha is None:
        a = [[cov_name(i, j) for j in range(d)] for i in range(d)]
        rhs = [f"c_{i}_y" for i in range(d)]
    else:
        a = [[f"n * {cov_name(i, j)}" + (f" + {float(ridge_alpha)!r}" if i == j else "") for j in range(d)]
             for i in range(d)]
        rhs = [f"n * c_{i}_y" for i in range(d)]
    return cramer_sql(a, rhs)


def nested_ols_sql(src: str, xs: list[str], y: str, tag: str = "g") -> tuple[list[str], str]:
    """CTEs that eliminate the normal equations of y on xs, and the name of a one-row CTE with the weights
    ``w{d}_{i}`` and intercept ``b{d}`` of every nested model on the first d columns."""
    d = len(xs)
    ctes = [f"{tag}m AS (SELECT {moments_select(xs, y)} FROM {src})"]
    first = [f"{cov_name(i, j)} AS a_{i}_{j}" for i in range(d) for j in range(i, d)] + [f"c_{i}_y AS r_{i}" for i in range(d)]
    ctes.append(f"{tag}0 AS (SELECT n, m_y, {', '.join(f'm_{i}' for i in range(d))}, {', '.join(first)} FROM {tag}m)")
    for k in range(d - 1):  # rows below k lose their k-th entry; rows up to k are done
        cols = [f"a_{i}_{j}" if i <= k else f"a_{i}_{j} - a_{k}_{i} / a_{k}_{k} * a_{k}_{j} AS a_{i}_{j}"
                for i in range(d) for j in range(i, d)]
        cols += [f"r_{i}" if i <= k else f"r_{i} - a_{k}_{i} / a_{k}_{k} * r_{k} AS r_{i}" for i in range(d)]
        ctes.append(f"{tag}{k + 1} AS (SELECT n, m_y, {', '.join(f'm_{i}' for i in range(d))}, {', '.join(cols)} FROM {tag}{k})")
    out = []
    for size in range(1, d + 1):
        for i in reversed(range(size)):
            rest = "".join(f" - a_{i}_{j} * w{size}_{j}" for j in range(i + 1, size))
            out.append(f"(r_{i}{rest}) / a_{i}_{i} AS w{size}_{i}")
        out.append("m_y" + "".join(f" - w{size}_{i} * m_{i}" for i in range(size)) + f" AS b{size}")
    ctes.append(f"{tag}w AS (SELECT {', '.join(out)} FROM {tag}{d - 1})")
    return ctes, f"{tag}w"
