"""Linear-model queries over lineitem: y = l_extendedprice, x = quantity, discount, tax."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import linear as lin
from ..operators import moments as mo
from ..operators.evaluate import halved_mse_expr
from ..operators.prepare import zscore, zscore_transform
from .common import LI_ORDER, LI_X, LI_Y, long_table, tbl
from .registry import query
from .sqlgen import moments_select, nested_ols_sql, ols_weights_sql

# ---------------------------------------------------------------------------
# Flagship: T1 z-score -> A7 moments -> M10 solve -> M1 score -> E1.


def _z_sql() -> str:
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
    zs = ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in LI_X)
    return f"s AS (SELECT {stats} FROM lineitem), z AS (SELECT {zs}, {LI_Y} FROM lineitem, s)"


def _ols_sql(src: str, xs, y, ridge=None) -> str:
    ws = ols_weights_sql(len(xs), ridge)
    wsel = ", ".join(f"{w} AS w_{i}" for i, w in enumerate(ws))
    dotm = " + ".join(f"w_{i} * m_{i}" for i in range(len(xs)))
    return (f"m AS (SELECT {moments_select(list(xs), y)} FROM {src}), "
            f"sol0 AS (SELECT *, {wsel} FROM m), sol AS (SELECT *, m_y - ({dotm}) AS b FROM sol0)")


FLAGSHIP_SQL = f"""
WITH {_z_sql()}, {_ols_sql('z', LI_X, LI_Y)},
e AS (SELECT avg(power({' + '.join(f'w_{i} * {c}' for i, c in enumerate(LI_X))} + b - {LI_Y}, 2)) / 2 AS mse
      FROM z, sol)
SELECT 'intercept' AS term, round(b, 3) AS value FROM sol
{''.join(f" UNION ALL SELECT '{c}', round(w_{i}, 3) FROM sol" for i, c in enumerate(LI_X))}
UNION ALL SELECT 'train_mse_half', round(mse, 3) FROM e
"""


@query("linreg_flagship", FLAGSHIP_SQL)
def linreg_flagship(spark, sf):
    """T1 z-score, A7 moments, M10 least squares, M1 scoring, E1 halved MSE.

    One aggregate reads the raw moments; the z-score statistics (T1 fit) are
    its means and population variances, and the moments of the z-scored
    features follow exactly from them.  The returned frame applies the
    scaler and the model to every row (T2, M1) and averages the error (E1)."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, LI_Y)
    raw = mo.compute_moments(li, LI_X, LI_Y)
    stats = mo.scaler_from(raw)
    w, b = mo.least_squares(mo.standardize(raw, stats))
    scored = lin.predict_linear(zscore_transform(li, stats), LI_X, w, b)
    one = scored.agg(halved_mse_expr(LI_Y, "prediction").alias("mse"))
    pairs = [("intercept", F.lit(b))] + [(c, F.lit(float(wj))) for c, wj in zip(LI_X, w)]
    return long_table(one, pairs + [("train_mse_half", F.col("mse"))], 3)


# ---------------------------------------------------------------------------
# M3 + M6 at a fixed point, on rows and on moments.

W_FIX = [1000.0, -5000.0, 20000.0]
B_FIX = 1000.0
LAM_FIX = 0.7


def _fx_sql() -> str:
    return " + ".join(f"{w!r} * {c}" for w, c in zip(W_FIX, LI_X)) + f" + {B_FIX!r}"


COST_GRAD_SQL = f"""
WITH e AS (SELECT {', '.join(LI_X)}, ({_fx_sql()}) - {LI_Y} AS err FROM lineitem),
a AS (SELECT count(*) AS n, avg(err * err) / 2 AS c0, avg(err) AS db,
      {', '.join(f'avg(err * {c}) AS g_{c}' for c in LI_X)} FROM e)
SELECT 'cost_rows' AS term, round(c0 + {LAM_FIX!r} / (2 * n) * {sum(w * w for w in W_FIX)!r}, 1) AS value FROM a
UNION ALL SELECT 'cost_moments', round(c0 + {LAM_FIX!r} / (2 * n) * {sum(w * w for w in W_FIX)!r}, 1) FROM a
UNION ALL SELECT 'db', round(db, 3) FROM a
{''.join(f" UNION ALL SELECT 'dw_{c}', round(g_{c} + {LAM_FIX!r} / n * {w!r}, 3) FROM a" for c, w in zip(LI_X, W_FIX))}
"""


@query("linear_cost_gradient", COST_GRAD_SQL)
def linear_cost_gradient(spark, sf):
    """M3 regularised cost evaluated on rows and from A7 moments, M6 regularised gradient."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, LI_Y).cache()
    c_rows = lin.linear_cost(li, LI_X, LI_Y, W_FIX, B_FIX, LAM_FIX)
    m = mo.compute_moments(li, LI_X, LI_Y)
    c_mom = mo.linear_cost(m, W_FIX, B_FIX, LAM_FIX)
    dw, db = lin.linear_gradient(li, LI_X, LI_Y, W_FIX, B_FIX, LAM_FIX)
    li.unpersist()
    rows = [("cost_rows", round(c_rows, 1)), ("cost_moments", round(c_mom, 1)), ("db", round(db, 3))]
    rows += [(f"dw_{c}", round(float(g), 3)) for c, g in zip(LI_X, dw)]
    return spark.createDataFrame(rows, "term string, value double")


# ---------------------------------------------------------------------------
# M8: batch gradient descent on z-scored features, y in thousands.

GD_ALPHA, GD_ITERS = 0.1, 50


def _gd_sql() -> str:
    d = len(LI_X)
    from .sqlgen import cov_name
    err = " + ".join(f"w_{j} * m_{j}" for j in range(d)) + " + b - m_y"
    upd = []
    for i in range(d):
        cw = " + ".join(f"{cov_name(i, j)} * w_{j}" for j in range(d))
        upd.append(f"w_{i} - {GD_ALPHA!r} * (({cw}) - c_{i}_y + m_{i} * ({err})) AS w_{i}")
    upd.append(f"b - {GD_ALPHA!r} * ({err}) AS b")
    quad = " + ".join(f"w_{i} * w_{j} * {cov_name(i, j)}" for i in range(d) for j in range(d))
    lin_t = " + ".join(f"w_{i} * c_{i}_y" for i in range(d))
    cost = f"0.5 * (({quad}) - 2 * ({lin_t}) + c_y_y + power({err}, 2))"
    zcols = ", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in LI_X)
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
    return f"""
WITH RECURSIVE s AS (SELECT {stats} FROM lineitem),
z AS (SELECT {zcols}, {LI_Y} / 1000.0 AS y FROM lineitem, s),
m AS (SELECT {moments_select(LI_X, 'y')} FROM z),
gd(it, {', '.join(f'w_{i}' for i in range(d))}, b) AS (
  SELECT -1, {', '.join('0.0::DOUBLE' for _ in range(d))}, 0.0::DOUBLE
  UNION ALL
  SELECT it + 1, {', '.join(upd)} FROM gd, m WHERE it < {GD_ITERS - 1})
SELECT CAST(it AS BIGINT) AS iter, round({cost}, 6) AS cost,
       {', '.join(f'round(w_{i}, 6) AS w_{c}' for i, c in enumerate(LI_X))}, round(b, 6) AS b
FROM gd, m WHERE it >= 0
"""


@query("linear_gradient_descent", _gd_sql())
def linear_gradient_descent(spark, sf):
    """M8: batch gradient descent (simultaneous update) with cost history; one A7 job, updates on moments."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, (F.col(LI_Y) / 1000.0).alias("y"))
    z, _ = zscore(li, LI_X)
    w, b, _, hist = lin.fit_gradient_descent(z, LI_X, "y", [0.0] * 3, 0.0, GD_ALPHA, GD_ITERS)
    rows = [(int(i), round(c, 6), *[round(x, 6) for x in ws], round(bb, 6)) for i, c, ws, bb, _ in hist]
    schema = "iter long, cost double, " + ", ".join(f"w_{c} double" for c in LI_X) + ", b double"
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------------------
# M11 ridge, M10 raw least squares, one-feature line, M13 via pyspark.ml.

RIDGE_ALPHA = 100.0


def _coef_sql(src_ctes: str, src: str, xs, y, ridge=None, digits=4) -> str:
    out = f"WITH {src_ctes}{', ' if src_ctes else ''}{_ols_sql(src, xs, y, ridge)}\n"
    out += f"SELECT 'intercept' AS term, round(b, {digits}) AS value FROM sol"
    out += "".join(f" UNION ALL SELECT '{c}', round(w_{i}, {digits}) FROM sol" for i, c in enumerate(xs))
    return out


RIDGE_SQL = _coef_sql(
    f"s AS (SELECT {', '.join(f'avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}' for c in LI_X)} FROM lineitem), "
    f"z AS (SELECT {', '.join(f'({c} - mu_{c}) / sd_{c} AS {c}' for c in LI_X)}, {LI_Y} / 1000.0 AS y "
    f"FROM lineitem, s)", "z", LI_X, "y", RIDGE_ALPHA, 6)


@query("ridge_fit", RIDGE_SQL)
def ridge_fit(spark, sf):
    """Ridge (SSE + alpha*||w||^2, free intercept) on z-scored features from one moment job."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, (F.col(LI_Y) / 1000.0).alias("y"))
    z, _ = zscore(li, LI_X)
    w, b, _ = lin.fit_ridge(z, LI_X, "y", RIDGE_ALPHA)
    rows = [("intercept", round(b, 6))] + [(c, round(float(v), 6)) for c, v in zip(LI_X, w)]
    return spark.createDataFrame(rows, "term string, value double")


OLS_RAW_SQL = _coef_sql("", "lineitem", LI_X, LI_Y, None, 4)


@query("least_squares_raw", OLS_RAW_SQL)
def least_squares_raw(spark, sf):
    """Closed-form least squares on unscaled features (A7 + driver solve)."""
    w, b, _ = lin.fit_least_squares(tbl(spark, sf, "lineitem"), LI_X, LI_Y)
    rows = [("intercept", round(b, 4))] + [(c, round(float(v), 4)) for c, v in zip(LI_X, w)]
    return spark.createDataFrame(rows, "term string, value double")


@query("least_squares_ml", OLS_RAW_SQL)
def least_squares_ml(spark, sf):
    """M10/M13 through pyspark.ml LinearRegression (normal-equation solver, no penalty)."""
    w, b = lin.fit_ml_linear(tbl(spark, sf, "lineitem"), LI_X, LI_Y)
    rows = [("intercept", round(b, 4))] + [(c, round(float(v), 4)) for c, v in zip(LI_X, w)]
    return spark.createDataFrame(rows, "term string, value double")


LINE_SQL = f"""
SELECT 'slope' AS term, round(regr_slope({LI_Y}, l_quantity), 6) AS value FROM lineitem
UNION ALL SELECT 'intercept', round(regr_intercept({LI_Y}, l_quantity), 6) FROM lineitem
"""


@query("line_fit", LINE_SQL)
def line_fit(spark, sf):
    """M10 with one feature: slope and intercept of price on quantity."""
    m = mo.compute_moments(tbl(spark, sf, "lineitem"), ["l_quantity"], LI_Y)
    s, i = mo.fit_line(m)
    return spark.createDataFrame([("slope", round(s, 6)), ("intercept", round(i, 6))], "term string, value double")


# ---------------------------------------------------------------------------
# Cost surface over a (w, b) grid, y in thousands on quantity.

GRID_W = [0.0, 0.5, 1.0, 1.5, 2.0, 2.5]
GRID_B = [-10.0, -5.0, 0.0, 5.0, 10.0]

COST_SURFACE_SQL = f"""
WITH g AS (SELECT * FROM (VALUES {', '.join(f'({w!r}, {b!r})' for w in GRID_W for b in GRID_B)}) t(w, b)),
d AS (SELECT l_quantity AS x, {LI_Y} / 1000.0 AS y FROM lineitem)
SELECT w, b, round(avg(power(w * x + b - y, 2)) / 2, 6) AS cost,
       round(avg((w * x + b - y) * x), 6) AS dj_dw, round(avg(w * x + b - y), 6) AS dj_db
FROM g, d GROUP BY w, b
"""


@query("cost_surface", COST_SURFACE_SQL)
def cost_surface_q(spark, sf):
    """Cost and gradient at every (w, b) grid point from one moment pass (the parameter grid is exploded
    next to the one-row moments, so grid x data needs no join)."""
    from ..operators.selection import cost_surface
    d = tbl(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), (F.col(LI_Y) / 1000.0).alias("y"))
    out = cost_surface(d, "x", "y", GRID_W, GRID_B)
    return out.select("w", "b", *[F.round(c, 6).alias(c) for c in ("cost", "dj_dw", "dj_db")])


# ---------------------------------------------------------------------------
# Sweeps over a 60/20/20 md5 split.

SPLIT_KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber)"
BUCKET_SQL = f"((('0x' || substr(md5({SPLIT_KEY_SQL}), 1, 8))::BIGINT) % 100)"
SPLIT_SQL = f"CASE WHEN {BUCKET_SQL} < 60 THEN 'train' WHEN {BUCKET_SQL} < 80 THEN 'cv' ELSE 'test' END"
DEGREES = [1, 2, 3, 4]
LAMBDAS = [0.0, 0.01, 0.1, 1.0, 10.0, 100.0]


def split_lineitem(spark, sf):
    from ..operators.selection import split_column
    li = tbl(spark, sf, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return li.select(*[c for c in LI_ORDER if c not in LI_X], *LI_X, (F.col(LI_Y) / 1000.0).alias("y"),
                     split_column(key).alias("split"))


def _sweep_sql(cands: list, xs_for, ridge_for, label_col: str, label_val) -> str:
    """One CTE chain per candidate: train-stat z-score, Cramer solve, errors."""
    dmax = max(len(xs_for(c)) for c in cands)
    base = (f"base AS (SELECT {SPLIT_SQL} AS split, l_quantity AS x, l_discount, l_tax, {LI_Y} / 1000.0 AS y, "
            + ", ".join(f"power(l_quantity, {k}.0) AS p{k}" for k in range(1, dmax + 1)) + " FROM lineitem)")
    parts, selects = [base], []
    for ci, c in enumerate(cands):
        xs = xs_for(c)
        st = ", ".join(f"avg({x}) AS mu{i}, stddev_pop({x}) AS sd{i}" for i, x in enumerate(xs))
        zs = ", ".join(f"({x} - mu{i}) / sd{i} AS z{i}" for i, x in enumerate(xs))
        zn = [f"z{i}" for i in range(len(xs))]
        ws = ols_weights_sql(len(xs), ridge_for(c))
        dotm = " + ".join(f"w_{i} * m_{i}" for i in range(len(xs)))
        pred = " + ".join(f"w_{i} * z{i}" for i in range(len(xs))) + " + b"
        parts += [
            f"st{ci} AS (SELECT {st} FROM base WHERE split = 'train')",
            f"zz{ci} AS (SELECT split, y, {zs} FROM base, st{ci})",
            f"m{ci} AS (SELECT {moments_select(zn, 'y')} FROM zz{ci} WHERE split = 'train')",
            f"w{ci} AS (SELECT *, {', '.join(f'{w} AS w_{i}' for i, w in enumerate(ws))} FROM m{ci})",
            f"s{ci} AS (SELECT *, m_y - ({dotm}) AS b FROM w{ci})",
            f"e{ci} AS (SELECT {label_val(c)} AS {label_col}, "
            f"avg(CASE WHEN split = 'train' THEN power({pred} - y, 2) END) / 2 AS tr, "
            f"avg(CASE WHEN split = 'cv' THEN power({pred} - y, 2) END) / 2 AS cv FROM zz{ci}, s{ci})",
        ]
        selects.append(f"SELECT * FROM e{ci}")
    parts.append("u AS (" + " UNION ALL ".join(selects) + ")")
    return ("WITH " + ",\n".join(parts) + f"""
SELECT {label_col}, round(tr, 6) AS train_mse_half, round(cv, 6) AS cv_mse_half, round(cv - tr, 6) AS cv_minus_train,
       CAST(CASE WHEN cv = min(cv) OVER () THEN 1 ELSE 0 END AS BIGINT) AS is_best FROM u""")


def _round_sweep(df, key):
    return df.select(key, *[F.round(c, 6).alias(c) for c in ("train_mse_half", "cv_mse_half", "cv_minus_train")],
                     "is_best")


@query("degree_sweep", _sweep_sql(DEGREES, lambda d: [f"p{k}" for k in range(1, d + 1)], lambda d: None,
                                  "degree", lambda d: f"CAST({d} AS BIGINT)"))
def degree_sweep_q(spark, sf):
    """E6 + E13: polynomial degree 1..4 of quantity, train-stat scaling, train/cv halved MSE, best by cv."""
    from ..operators.selection import degree_sweep
    return _round_sweep(degree_sweep(split_lineitem(spark, sf), "l_quantity", "y", DEGREES), "degree")


DEEP = 10
BASELINE = 90.0  # a stated reference error, as a human level or a competing model's


def _deep_sql() -> str:
    names = [f"t{k}" for k in range(1, DEEP + 1)]
    ctes = [f"base AS (SELECT {SPLIT_SQL} AS split, l_quantity AS x, {LI_Y} / 1000.0 AS y FROM lineitem)",
            "ends AS (SELECT min(x) AS lo, max(x) AS hi FROM base WHERE split = 'train')",
            "c1 AS (SELECT split, y, 1.0::DOUBLE AS t0, (x * 2.0 - (lo + hi)) / (hi - lo) AS t1 FROM base, ends)"]
    ctes += [f"c{k} AS (SELECT *, 2.0 * t1 * t{k - 1} - t{k - 2} AS t{k} FROM c{k - 1})" for k in range(2, DEEP + 1)]
    ctes.append(f"tr AS (SELECT * FROM c{DEEP} WHERE split = 'train')")
    solve, w = nested_ols_sql("tr", names, "y")
    pred = lambda d: " + ".join(f"w{d}_{i} * t{i + 1}" for i in range(d)) + f" + b{d}"
    errs = [f"avg(power({pred(d)} - y, 2)) / 2 AS e{d}" for d in range(1, DEEP + 1)]
    ctes += [*solve, f"e AS (SELECT split, {', '.join(errs)} FROM c{DEEP}, {w} GROUP BY split)",
             "l AS (" + " UNION ALL ".join(f"SELECT {d}::BIGINT AS degree, split, e{d} AS err FROM e" for d in range(1, DEEP + 1)) + ")",
             "p AS (SELECT degree, max(err) FILTER (split = 'train') AS tr, max(err) FILTER (split = 'cv') AS cv, "
             "max(err) FILTER (split = 'test') AS te FROM l GROUP BY degree)"]
    return ("WITH " + ",\n".join(ctes) + f"""
SELECT degree, round(tr, 6) AS train_mse_half, round(cv, 6) AS cv_mse_half, round(te, 6) AS test_mse_half,
       round(cv - tr, 6) AS cv_minus_train, round(tr - {BASELINE!r}, 6) AS train_minus_baseline,
       CAST(CASE WHEN cv = min(cv) OVER () THEN 1 ELSE 0 END AS BIGINT) AS is_best FROM p""")


@query("degree_sweep_deep", _deep_sql())
def degree_sweep_deep(spark, sf):
    """E6 + E13: degrees 1..10 of quantity fitted on train, errors on train, cv and test from one residual scan, the
    variance gap and the gap to a baseline error, best by cv."""
    from ..operators.selection import degree_sweep
    out = degree_sweep(split_lineitem(spark, sf), "l_quantity", "y", range(1, DEEP + 1), baseline=BASELINE)
    return out.select("degree", *[F.round(c, 6).alias(c) for c in out.columns[1:-1]], "is_best")


@query("lambda_sweep", _sweep_sql(LAMBDAS, lambda l: [f"p{k}" for k in range(1, 5)], lambda l: l,
                                  "reg_lambda", lambda l: f"CAST({l!r} AS DOUBLE)"))
def lambda_sweep_q(spark, sf):
    """Ridge strength sweep on degree-4 features, same moments, best by cv."""
    from ..operators.selection import lambda_sweep
    return _round_sweep(lambda_sweep(split_lineitem(spark, sf), "l_quantity", "y", 4, LAMBDAS), "reg_lambda")


FEATURE_SETS = {"q": ["x"], "q_d": ["x", "l_discount"], "q_d_t": ["x", "l_discount", "l_tax"]}


@query("feature_set_sweep", _sweep_sql(list(FEATURE_SETS), lambda k: FEATURE_SETS[k], lambda k: None,
                                       "feature_set", lambda k: f"'{k}'"))
def feature_set_sweep_q(spark, sf):
    """Compare feature lists on one moment pass over their union."""
    from ..operators.selection import feature_set_sweep
    d = split_lineitem(spark, sf).withColumnRenamed("l_quantity", "x")
    return _round_sweep(feature_set_sweep(d, FEATURE_SETS, "y"), "feature_set")


def _learning_sql(steps: int = 10) -> str:
    xs = LI_X
    d = len(xs)
    ws = ols_weights_sql(d)
    dotm = " + ".join(f"w_{i} * m_{i}" for i in range(d))
    pred = " + ".join(f"w_{i} * {x}" for i, x in enumerate(xs)) + " + b"
    return f"""
WITH base AS (SELECT {SPLIT_SQL} AS split, {', '.join(c for c in LI_ORDER if c not in xs)}, {', '.join(xs)}, {LI_Y} / 1000.0 AS y FROM lineitem),
tr AS (SELECT *, row_number() OVER (ORDER BY {', '.join(LI_ORDER)}) - 1 AS pos, count(*) OVER () AS n
       FROM base WHERE split = 'train'),
k AS (SELECT range AS k FROM range(1, {steps + 1})),
pre AS (SELECT k.k, tr.* FROM tr, k WHERE tr.pos * {steps} < k.k * tr.n),
m AS (SELECT k, {moments_select(xs, 'y')} FROM pre GROUP BY k),
w AS (SELECT *, {', '.join(f'{w} AS w_{i}' for i, w in enumerate(ws))} FROM m),
s AS (SELECT *, m_y - ({dotm}) AS b FROM w),
etr AS (SELECT s.k, s.n, avg(power({pred.replace('w_', 's.w_').replace(' b', ' s.b')} - pre.y, 2)) / 2 AS tr
        FROM pre JOIN s ON pre.k = s.k GROUP BY s.k, s.n),
ecv AS (SELECT s.k, avg(power({pred.replace('w_', 's.w_').replace(' b', ' s.b')} - base.y, 2)) / 2 AS cv
        FROM base, s WHERE base.split = 'cv' GROUP BY s.k)
SELECT CAST(etr.n AS BIGINT) AS train_rows, round(tr, 6) AS train_mse_half, round(cv, 6) AS cv_mse_half
FROM etr JOIN ecv ON etr.k = ecv.k
"""


@query("learning_curve", _learning_sql())
def learning_curve_q(spark, sf):
    """E9 + T11: growing train prefixes (10%..100% in key order), train and cv error per size."""
    from ..operators.selection import learning_curve
    d = split_lineitem(spark, sf)
    out = learning_curve(d, LI_X, "y", LI_ORDER, 10)
    return out.select("train_rows", *[F.round(c, 6).alias(c) for c in ("train_mse_half", "cv_mse_half")])


DECAY_ITERS, DECAY_POINTS, DECAY_ALPHA, DECAY_DIGITS = 205, 20, 0.5, 4


def _decay_sql() -> str:
    """The update unrolled as a recursion that carries alpha and the cost of the last progress point."""
    from .sqlgen import cov_name
    d, every = len(LI_X), -(-DECAY_ITERS // DECAY_POINTS)
    err = " + ".join(f"w_{j} * m_{j}" for j in range(d)) + " + b - m_y"
    upd = [f"w_{i} - alpha * (({' + '.join(f'{cov_name(i, j)} * w_{j}' for j in range(d))}) - c_{i}_y + m_{i} * ({err})) AS w_{i}"
           for i in range(d)]
    quad = " + ".join(f"w_{i} * w_{j} * {cov_name(i, j)}" for i in range(d) for j in range(d))
    cost = f"0.5 * (({quad}) - 2 * ({' + '.join(f'w_{i} * c_{i}_y' for i in range(d))}) + c_y_y + power({err}, 2))"
    ws = ", ".join(f"w_{i}" for i in range(d))
    stats = ", ".join(f"avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}" for c in LI_X)
    return f"""
WITH RECURSIVE s AS (SELECT {stats} FROM lineitem),
z AS (SELECT {", ".join(f"({c} - mu_{c}) / sd_{c} AS {c}" for c in LI_X)}, {LI_Y} / 1000.0 AS y FROM lineitem, s),
m AS (SELECT {moments_select(LI_X, 'y')} FROM z),
gd(it, {ws}, b, alpha, last, cost, used) AS (
  SELECT -1, {', '.join('0.0::DOUBLE' for _ in range(d))}, 0.0::DOUBLE, {DECAY_ALPHA!r}::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
  UNION ALL
  SELECT it, {ws}, b, CASE WHEN it % {every} = 0 AND round(c, {DECAY_DIGITS}) = last THEN alpha / 10 ELSE alpha END,
         CASE WHEN it % {every} = 0 THEN round(c, {DECAY_DIGITS}) ELSE last END, c, alpha
  FROM (SELECT u.*, {cost} AS c FROM (SELECT it + 1 AS it, {', '.join(upd)}, b - alpha * ({err}) AS b, alpha, last
                                      FROM gd, m WHERE it < {DECAY_ITERS - 1}) u, m))
SELECT CAST(it AS BIGINT) AS iter, round(cost, 6) AS cost, {', '.join(f'round(w_{i}, 6) AS w_{c}' for i, c in enumerate(LI_X))},
       round(b, 6) AS b, used AS alpha FROM gd WHERE it >= 0 AND (it % {every} = 0 OR it = {DECAY_ITERS - 1})
"""


@query("linear_gd_decay_path", _decay_sql())
def linear_gd_decay_path(spark, sf):
    """M8 + M9: gradient descent with 20 progress points; where the cost (4 decimals) is that of the point before, alpha
    is divided by 10.  Cost, weights and the alpha used at every progress point and at the end."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, (F.col(LI_Y) / 1000.0).alias("y"))
    z, _ = zscore(li, LI_X)
    _, _, _, hist = lin.fit_gradient_descent(z, LI_X, "y", [0.0] * 3, 0.0, DECAY_ALPHA, DECAY_ITERS, 0.0, DECAY_POINTS, DECAY_DIGITS)
    every = -(-DECAY_ITERS // DECAY_POINTS)
    rows = [(int(i), round(c, 6), *[round(x, 6) for x in ws], round(b, 6), alpha) for i, c, ws, b, alpha in hist
            if i % every == 0 or i == DECAY_ITERS - 1]
    return spark.createDataFrame(rows, "iter long, cost double, " + ", ".join(f"w_{c} double" for c in LI_X) + ", b double, alpha double")


# 400 steps end at the least-squares solution whatever the step rule does on the way; the rule itself is seen by
# linear_gd_decay_path.
STEP_DECAY_SQL = f"""
WITH {_z_sql().replace(f", {LI_Y} FROM", f", {LI_Y} / 1000.0 AS y FROM")}, {_ols_sql('z', LI_X, 'y')},
e AS (SELECT avg(power({' + '.join(f'w_{i} * {c}' for i, c in enumerate(LI_X))} + b - y, 2)) / 2 AS c FROM z, sol)
SELECT 'intercept' AS term, round(b, 6) AS value FROM sol
{''.join(f" UNION ALL SELECT '{c}', round(w_{i}, 6) FROM sol" for i, c in enumerate(LI_X))}
UNION ALL SELECT 'final_cost', round(c, 6) FROM e
"""


@query("linear_gd_step_decay", STEP_DECAY_SQL)
def linear_gd_step_decay(spark, sf):
    """M8 + M9: 400 gradient-descent steps on z-scored features with 40 progress points; at a progress point
    where the cost did not change, alpha is divided by 10.  Final weights, cost and learning rate."""
    li = tbl(spark, sf, "lineitem").select(*LI_X, (F.col(LI_Y) / 1000.0).alias("y"))
    z, _ = zscore(li, LI_X)
    m = mo.compute_moments(z, LI_X, "y")
    w, b, hist = mo.gradient_descent_on_moments(m, [0.0] * 3, 0.0, 0.5, 400, decay_points=40)
    rows = [("intercept", round(b, 6))] + [(c, round(float(v), 6)) for c, v in zip(LI_X, w)]
    rows.append(("final_cost", round(hist[-1][1], 6)))
    return spark.createDataFrame(rows, "term string, value double")
