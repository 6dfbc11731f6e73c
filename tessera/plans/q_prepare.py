"""Feature-preparation, projection and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import core as fn
from ..operators import prepare as pr
from .common import LI_ORDER, LI_X, rnd, tbl
from .registry import query

KEY_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _bucket_sql(expr: str) -> str:
    return f"((('0x' || substr(md5({expr}), 1, 8))::BIGINT) % 100)"


def li_key():
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


# --- T1 / T2 ----------------------------------------------------------------

ZFIT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(stddev_pop({c}), 8) AS sd FROM lineitem" for c in LI_X)


@query("zscore_fit", ZFIT_SQL)
def zscore_fit_q(spark, sf):
    """T1 fit: per-feature mean and population standard deviation (one aggregate)."""
    st = pr.zscore_fit(tbl(spark, sf, "lineitem"), LI_X)
    return spark.createDataFrame([(c, round(m, 8), round(s, 8)) for c, (m, s) in st.items()],
                                 "feature string, mean double, sd double")


ZAPPLY_SQL = f"""
WITH b AS (SELECT *, {_bucket_sql(KEY_SQL)} AS bucket FROM lineitem),
s AS (SELECT {', '.join(f'avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}' for c in LI_X)} FROM b WHERE bucket < 80)
SELECT l_orderkey, l_linenumber, {', '.join(f'round(({c} - mu_{c}) / sd_{c}, 8) AS z_{c}' for c in LI_X)}
FROM b, s WHERE bucket >= 80
"""


@query("zscore_apply_test", ZAPPLY_SQL)
def zscore_apply_test(spark, sf):
    """T9 80/20 hash split, T1 fit on train only, T2 apply the train statistics to the test rows."""
    li = tbl(spark, sf, "lineitem")
    lab = li.withColumn("_b", pr.hash_bucket(li_key()))
    train, test = lab.where(F.col("_b") < 80), lab.where(F.col("_b") >= 80)
    st = pr.zscore_fit(train, LI_X)
    out = pr.zscore_transform(test, st, suffix="_z")
    return out.select("l_orderkey", "l_linenumber", *[rnd(f"{c}_z", 8).alias(f"z_{c}") for c in LI_X])


# --- T3 / T4 / T5 -----------------------------------------------------------

MM_SQL = f"""
WITH s AS (SELECT min(l_quantity) AS lo_q, max(l_quantity) AS hi_q, min(l_discount) AS lo_d, max(l_discount) AS hi_d
           FROM lineitem),
t AS (SELECT l_orderkey, l_linenumber, (l_quantity - lo_q) / (hi_q - lo_q) * 2.0 - 1.0 AS q_s,
             (l_discount - lo_d) / (hi_d - lo_d) * 2.0 - 1.0 AS d_s, lo_q, hi_q, lo_d, hi_d FROM lineitem, s)
SELECT l_orderkey, l_linenumber, round(q_s, 8) AS q_scaled, round(d_s, 8) AS d_scaled,
       round((q_s + 1.0) / 2.0 * (hi_q - lo_q) + lo_q, 8) AS q_back, round((d_s + 1.0) / 2.0 * (hi_d - lo_d) + lo_d, 8) AS d_back
FROM t
"""


@query("minmax_scale", MM_SQL)
def minmax_scale(spark, sf):
    """Min-max scaling to [-1, 1] and the inverse transform back."""
    li = tbl(spark, sf, "lineitem")
    st = pr.minmax_fit(li, ["l_quantity", "l_discount"])
    s = pr.minmax_transform(li, st, suffix="_s")
    return s.select("l_orderkey", "l_linenumber", rnd("l_quantity_s", 8).alias("q_scaled"),
                    rnd("l_discount_s", 8).alias("d_scaled"),
                    rnd(pr.minmax_inverse("l_quantity_s", st["l_quantity"]), 8).alias("q_back"),
                    rnd(pr.minmax_inverse("l_discount_s", st["l_discount"]), 8).alias("d_back"))


MEANNORM_SQL = f"""
WITH s AS (SELECT {', '.join(f'avg({c}) AS mu_{c}, min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in LI_X)} FROM lineitem)
SELECT {', '.join(f"round(sum(({c} - mu_{c}) / (hi_{c} - lo_{c})), 6) AS sum_{c}, round(max(({c} - mu_{c}) / (hi_{c} - lo_{c})), 8) AS max_{c}, round(max(hi_{c} - lo_{c}), 8) AS ptp_{c}" for c in LI_X)}
FROM lineitem, s
"""


@query("mean_normalize", MEANNORM_SQL)
def mean_normalize_q(spark, sf):
    """T4 mean normalisation (x - mean)/(max - min) and T5 peak-to-peak per feature."""
    li = tbl(spark, sf, "lineitem")
    mn = pr.mean_normalize(li, LI_X, suffix="_n")
    ptp = pr.peak_to_peak(li, LI_X).first()
    agg = mn.agg(*[F.sum(f"{c}_n").alias(f"sum_{c}") for c in LI_X], *[F.max(f"{c}_n").alias(f"max_{c}") for c in LI_X])
    cols = []
    for c in LI_X:
        cols += [rnd(f"sum_{c}", 6).alias(f"sum_{c}"), rnd(f"max_{c}", 8).alias(f"max_{c}"),
                 F.round(F.lit(float(ptp[f"{c}_ptp"])), 8).alias(f"ptp_{c}")]
    return agg.select(*cols)


# --- T6 / T7 / T8 -------------------------------------------------------------

def _map_feature_sql(x1: str, x2: str, degree: int) -> list[str]:
    out = []
    for i in range(1, degree + 1):
        for j in range(i + 1):
            out.append(f"power({x1}, {float(i - j)!r}) * power({x2}, {float(j)!r})")
    return out


# The maps run on z-scored inputs (T1 first).  Raw inputs have few decimals, so
# their term means are often exact decimals ending in 5, where any fixed
# rounding digit lets float noise pick the side.
Z3_SQL = ("WITH s AS (SELECT avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_discount) AS md, "
          "stddev_pop(l_discount) AS sd, avg(l_tax) AS mx, stddev_pop(l_tax) AS sx FROM lineitem), "
          "t AS (SELECT (l_quantity - mq) / sq AS q, (l_discount - md) / sd AS d, (l_tax - mx) / sx AS x "
          "FROM lineitem, s)\n")


def z3(spark, sf):
    li = tbl(spark, sf, "lineitem")
    z, _ = pr.zscore(li.select(*LI_X), LI_X)
    return z.select(F.col("l_quantity").alias("q"), F.col("l_discount").alias("d"), F.col("l_tax").alias("x"))


POLY_SQL = (
    Z3_SQL
    + " UNION ALL ".join(f"SELECT 'pow_{k}' AS term, round(avg(power(q, {float(k)!r})), 8) AS value FROM t"
                         for k in range(1, 7))
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT 'map_{k}', round(avg({e}), 8) FROM t"
                         for k, e in enumerate(_map_feature_sql("d", "x", 6)))
)


@query("polynomial_features", POLY_SQL)
def polynomial_features(spark, sf):
    """T1 z-score, then T6 one-variable powers x..x^6 and T7 two-variable map (27 monomials at degree 6), averaged over all rows."""
    li = z3(spark, sf)
    p = pr.poly_one(li, "q", 6, prefix="pow_")
    p, _ = pr.poly_features(p, ["d", "x"], 6, prefix="map_")
    names = [f"pow_{k}" for k in range(1, 7)] + [f"map_{k}" for k in range(27)]
    one = p.agg(*[F.avg(n).alias(n) for n in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("term"), rnd(n, 8).alias("value")) for n in names])))


def _poly_terms_sql() -> list[tuple[str, str]]:
    terms = pr.poly_terms(["q", "d", "x"], 3)
    return [(f"poly{k}", " * ".join(t)) for k, t in enumerate(terms)]


POLYN_SQL = (Z3_SQL
             + " UNION ALL ".join(f"SELECT '{n}' AS term, round(avg({e}), 8) AS value FROM t" for n, e in _poly_terms_sql()))


@query("polynomial_expansion", POLYN_SQL)
def polynomial_expansion(spark, sf):
    """T1 z-score, then T8: all monomials of degree 1..3 of three variables (19 terms), averaged over all rows."""
    li = z3(spark, sf)
    p, names = pr.poly_features(li, ["q", "d", "x"], 3)
    one = p.agg(*[F.avg(n).alias(n) for n in names])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("term"), rnd(n, 8).alias("value")) for n in names])))


# --- T9 / T10 / T11 -----------------------------------------------------------

SPLIT_SQL = f"""
WITH b AS (SELECT {_bucket_sql(KEY_SQL)} AS bucket, l_quantity FROM lineitem)
SELECT 'two_way' AS scheme, CASE WHEN bucket < 67 THEN 'train' ELSE 'test' END AS split, count(*) AS n,
       round(sum(l_quantity), 4) AS sum_qty FROM b GROUP BY 2
UNION ALL
SELECT 'three_way', CASE WHEN bucket < 60 THEN 'train' WHEN bucket < 80 THEN 'cv' ELSE 'test' END, count(*),
       round(sum(l_quantity), 4) FROM b GROUP BY 2
"""


@query("hash_splits", SPLIT_SQL)
def hash_splits(spark, sf):
    """T9 two-way (test 33%) and T10 three-way (60/20/20) reproducible md5-bucket splits; sizes and sums."""
    li = tbl(spark, sf, "lineitem")
    two = li.select(F.lit("two_way").alias("scheme"), pr.split_label(li_key(), [("train", .67), ("test", .33)])
                    .alias("split"), "l_quantity")
    three = li.select(F.lit("three_way").alias("scheme"), pr.split_label(li_key(), [("train", .6), ("cv", .2),
                                                                                   ("test", .2)]).alias("split"),
                      "l_quantity")
    u = two.unionByName(three)
    return u.groupBy("scheme", "split").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4)
                                            .alias("sum_qty"))


PREFIX_SQL = f"""
WITH o AS (SELECT l_quantity, row_number() OVER (ORDER BY {', '.join(LI_ORDER)}) - 1 AS pos, count(*) OVER () AS n
           FROM lineitem)
SELECT CASE WHEN pos < CAST(floor(0.8 * n) AS BIGINT) THEN 'train' ELSE 'eval' END AS split, count(*) AS n,
       round(sum(l_quantity), 4) AS sum_qty FROM o GROUP BY 1
"""


@query("prefix_split", PREFIX_SQL)
def prefix_split_q(spark, sf):
    """First 80% of the rows in key order are train (the cut key is an order statistic), the rest eval."""
    li = tbl(spark, sf, "lineitem")
    s = pr.prefix_split(li, LI_ORDER, 0.8)
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("sum_qty"))


EXACT_SQL = f"""
WITH o AS (SELECT l_quantity, {', '.join(c for c in LI_ORDER if c != 'l_quantity')},
                  ('0x' || substr(md5(concat_ws('-', l_orderkey, l_linenumber)), 1, 15))::BIGINT AS h FROM lineitem),
r AS (SELECT *, row_number() OVER (ORDER BY h, l_orderkey, l_linenumber, {', '.join(LI_ORDER)}) AS rn, count(*) OVER () AS n FROM o),
s AS (SELECT 'two_way' AS scheme, CASE WHEN rn <= n - CAST(ceil(n * 33 / 100.0) AS BIGINT) THEN 'train' ELSE 'test' END AS split, * FROM r
  UNION ALL
  SELECT 'three_way', CASE WHEN rn <= n - CAST(ceil(n * 40 / 100.0) AS BIGINT) THEN 'train'
                           WHEN rn <= n - CAST(ceil(n * 20 / 100.0) AS BIGINT) THEN 'cv' ELSE 'test' END, * FROM r)
SELECT scheme, split, count(*) AS n, max(h) AS last_hash, count(DISTINCT l_orderkey) AS n_orders FROM s GROUP BY scheme, split
"""


@query("exact_splits", EXACT_SQL)
def exact_splits(spark, sf):
    """Splits with exact row counts (test of 33%, and 60/20/20) in hash order, cut at order statistics."""
    li = tbl(spark, sf, "lineitem")
    parts = [("two_way", [("train", .67), ("test", .33)]), ("three_way", [("train", .6), ("cv", .2), ("test", .2)])]
    text = F.concat_ws("-", "l_orderkey", "l_linenumber")
    hashed = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")
    out = None
    for scheme, fractions in parts:
        s = pr.exact_split(li, ["l_orderkey", "l_linenumber"], fractions).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"), F.max(hashed).alias("last_hash"), F.count_distinct("l_orderkey").alias("n_orders"))
        s = s.select(F.lit(scheme).alias("scheme"), "split", "n", "last_hash", "n_orders")
        out = s if out is None else out.unionByName(s)
    return out


ONE_HOT_LONG_SQL = """
WITH lv AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM (SELECT DISTINCT p_type AS level FROM part WHERE p_type IS NOT NULL))
SELECT p_partkey, p_type AS level, code, 1::INTEGER AS flag FROM part JOIN lv ON p_type = level
"""


@query("one_hot_levels", ONE_HOT_LONG_SQL)
def one_hot_levels(spark, sf):
    """P9 in long form: the active part type of every part and its code in the level dictionary of the data."""
    part = tbl(spark, sf, "part")
    return pr.one_hot_long(part, "p_partkey", "p_type", pr.level_table(part, "p_type"))


# --- P1-P4, P7, P8 --------------------------------------------------------------

PROJ_SQL = f"""
SELECT count(*) AS n, round(sum(ones), 4) AS sum_ones, {', '.join(f'round(sum({c}), 4) AS sum_{c}' for c in LI_X)}
FROM (SELECT {', '.join(LI_X)}, 1.0 AS ones FROM lineitem WHERE l_returnflag = 'R')
"""


@query("project_filter", PROJ_SQL)
def project_filter(spark, sf):
    """P1 column slice, P2 exact-name target exclusion, P3 appended ones column, P4 class filter (y = R)."""
    li = tbl(spark, sf, "lineitem")
    feats = pr.exclude(LI_X + ["l_extendedprice"], "l_extendedprice")
    d = li.where(F.col("l_returnflag") == "R").select(*feats).withColumn("ones", F.lit(1.0))
    return d.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("ones"), 4).alias("sum_ones"),
                 *[F.round(F.sum(c), 4).alias(f"sum_{c}") for c in feats])


MISS_SQL = f"""
WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
                  CASE WHEN l_quantity >= 25 THEN 1 ELSE 0 END AS yhat, {', '.join(c for c in LI_ORDER if c not in ('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey'))}
           FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(y AS BIGINT) AS y, CAST(yhat AS BIGINT) AS yhat FROM p WHERE y <> yhat
ORDER BY {', '.join(LI_ORDER)} LIMIT 8
"""


@query("misclassified", MISS_SQL)
def misclassified(spark, sf):
    """The first 8 misclassified rows (in key order) of a rule classifier (quantity >= 25 predicts R)."""
    li = tbl(spark, sf, "lineitem")
    p = li.select(*LI_ORDER, F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("long").alias("y"),
                  pr.threshold(F.col("l_quantity"), 25).cast("long").alias("yhat"))
    wrong = p.where(F.col("y") != F.col("yhat")).orderBy(*LI_ORDER).limit(8)
    return wrong.select("l_orderkey", "l_linenumber", "y", "yhat")


LONG_SQL = """
SELECT vec_id, CAST(j.range AS BIGINT) AS position, round(CAST(embedding[j.range + 1] AS DOUBLE), 6) AS value
FROM embeddings, range(64) j
"""


@query("wide_to_long", LONG_SQL)
def wide_to_long_q(spark, sf):
    """Vectors to (id, position, value) rows with posexplode."""
    from ..sources.readers import array_to_long
    emb = tbl(spark, sf, "embeddings")
    lng = array_to_long(emb, ["vec_id"], "embedding")
    return lng.select("vec_id", F.col("position").cast("long"), rnd("value", 6).alias("value"))


UNPIVOT_SQL = f"""
SELECT feature, count(*) AS n, round(sum(value), 4) AS total FROM (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS value FROM lineitem" for c in LI_X)}) GROUP BY feature
"""


@query("unpivot_features", UNPIVOT_SQL)
def unpivot_features(spark, sf):
    """Wide feature columns to long (feature, value) rows with unpivot, totals per feature."""
    from ..sources.readers import wide_to_long
    lng = wide_to_long(tbl(spark, sf, "lineitem"), ["l_orderkey"], LI_X, "feature", "value")
    return lng.groupBy("feature").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


# --- P9 -----------------------------------------------------------------------

TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
SEGS_SQL = "SELECT DISTINCT c_mktsegment FROM customer"

ONEHOT_SQL = ("SELECT p_partkey, p_name, p_size, "
              + ", ".join(f"CAST(CASE WHEN p_type = '{t}' THEN 1 ELSE 0 END AS INTEGER) AS p_type_{t}" for t in TYPES)
              + " FROM part")


@query("one_hot", ONEHOT_SQL)
def one_hot_q(spark, sf):
    """get_dummies on p_type: sorted levels, prefix = column name, original dropped, others kept."""
    part = tbl(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_type")
    return pr.one_hot(part, ["p_type"])


FLAGS_SQL = ("SELECT p_partkey, " + " || ".join(
    f"CASE WHEN p_type = '{t}' THEN '{t}|' ELSE '' END" for t in TYPES) + " AS active FROM part")


@query("active_flag_names", FLAGS_SQL)
def active_flag_names(spark, sf):
    """Names of the active flags of a one-hot vector (filter over zipped arrays)."""
    part = tbl(spark, sf, "part")
    flags = F.array(*[F.when(F.col("p_type") == t, 1).otherwise(0) for t in TYPES])
    names = pr.active_names(flags, TYPES)
    return part.select("p_partkey", F.concat(F.array_join(names, "|"), F.when(F.size(names) > 0, "|")
                                             .otherwise("")).alias("active"))


PICK_SQL = f"""
WITH r AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) AS rating
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
j AS (SELECT r.*, p.p_type FROM r JOIN part p ON p.p_partkey = r.item_id),
prof AS (SELECT user_id, {', '.join(f"coalesce(avg(rating) FILTER (WHERE p_type = '{t}'), 0.0) AS a_{t}" for t in TYPES)}
         FROM j GROUP BY user_id)
SELECT j.user_id, j.item_id, round(CASE j.p_type {' '.join(f"WHEN '{t}' THEN a_{t}" for t in TYPES)} END, 6) AS genre_ave
FROM j JOIN prof ON j.user_id = prof.user_id
"""


@query("pick_user_genre_average", PICK_SQL)
def pick_user_genre_average(spark, sf):
    """For each rating, the user's average in the item's genres (values picked where the item's flag is 1)."""
    from ..operators.recommend import user_profile
    from .q_recommend import ratings_frame
    r = ratings_frame(spark, sf)
    it = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    prof = user_profile(r, it, "user_id", "item_id", "p_type", "rating", TYPES)
    prof = prof.select("user_id", F.array(*[F.col(t) for t in TYPES]).alias("avgs"))
    j = r.join(it, "item_id").withColumn("flags", F.array(*[F.when(F.col("p_type") == t, 1).otherwise(0)
                                                           for t in TYPES]))
    j = j.join(prof, "user_id")
    picked = pr.pick_where_flag("avgs", "flags")
    return j.select("user_id", "item_id", rnd(F.element_at(picked, 1), 6).alias("genre_ave"))


# --- F1-F11 ------------------------------------------------------------------------

def _fn_sql() -> str:
    z = "(l_quantity / 5.0 - 5.0)"
    a, b, c = "(l_quantity / 50.0)", "(l_discount * 10.0)", "(l_tax * 10.0)"
    m = f"greatest({a}, {b}, {c})"
    den = f"(exp({a} - {m}) + exp({b} - {m}) + exp({c} - {m}))"
    am = f"CASE WHEN {a} >= {b} AND {a} >= {c} THEN 0 WHEN {b} >= {c} THEN 1 ELSE 2 END"
    amin = f"CASE WHEN {a} <= {b} AND {a} <= {c} THEN 0 WHEN {b} <= {c} THEN 1 ELSE 2 END"
    p = "(l_discount * 10.0)"
    ent = f"CASE WHEN {p} <= 0 OR {p} >= 1 THEN 0.0 ELSE -{p} * log2({p}) - (1 - {p}) * log2(1 - {p}) END"
    norm = f"sqrt({a} * {a} + {b} * {b} + {c} * {c})"
    return f"""
SELECT round(avg(1.0 / (1.0 + exp(-greatest(least({z}, 500.0), -500.0)))), 8) AS avg_sigmoid,
       round(avg(CASE WHEN {z} <= 20.0 THEN ln(1.0 + exp({z})) ELSE {z} END), 8) AS avg_log1pexp,
       round(avg(greatest({z}, 0.0)), 8) AS avg_relu,
       round(avg(exp({a} - {m}) / {den}), 8) AS avg_softmax_0,
       CAST(sum(CASE WHEN ({am}) = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_argmax_0,
       CAST(sum(CASE WHEN ({am}) = 2 THEN 1 ELSE 0 END) AS BIGINT) AS n_argmax_2,
       CAST(sum(CASE WHEN ({amin}) = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_argmin_1,
       round(avg(0.5 * {a} - 2.0 * {b} + 3.0 * {c} + 1.0), 8) AS avg_dot,
       round(avg({a} * {b} + {b} * {c} + {c} * {a}), 8) AS avg_array_dot,
       round(avg(power({a} - 0.5, 2) + power({b} - 0.5, 2) + power({c} - 0.5, 2)), 8) AS avg_sq_dist,
       round(avg({norm}), 8) AS avg_norm,
       round(avg({a} / greatest({norm}, 1e-6)), 8) AS avg_unit_0,
       round(avg({ent}), 8) AS avg_entropy,
       round(avg(power({a}, 2) + cos({b}) + exp({c}) + abs({z}) + round({z}, 1)), 8) AS avg_elementwise,
       round(avg(CASE WHEN {a} >= 0.5 THEN 1.0 ELSE 0.0 END), 8) AS share_threshold
FROM lineitem
"""


@query("scalar_functions", _fn_sql())
def scalar_functions(spark, sf):
    """F1 sigmoid, F2 log1pexp, F3 relu, F4 softmax, F5 argmax/argmin, F6 dot, F7 squared distance and norm,
    F8 L2 normalise, F9 elementwise math, F10 vector arithmetic, F11 binary entropy, P5 threshold; averaged."""
    li = tbl(spark, sf, "lineitem")
    z = F.col("l_quantity") / 5.0 - 5.0
    a, b, c = F.col("l_quantity") / 50.0, F.col("l_discount") * 10.0, F.col("l_tax") * 10.0
    d = li.select(z.alias("z"), a.alias("a"), b.alias("b"), c.alias("c"), F.array(a, b, c).alias("v"))
    sm = fn.softmax("v", n=3)
    unit = fn.l2_normalize("v", n=3)
    shifted = F.array(F.col("b"), F.col("c"), F.col("a"))
    return d.agg(
        rnd(F.avg(fn.sigmoid("z")), 8).alias("avg_sigmoid"),
        rnd(F.avg(fn.log_1pexp("z")), 8).alias("avg_log1pexp"),
        rnd(F.avg(fn.relu("z")), 8).alias("avg_relu"),
        rnd(F.avg(sm[0]), 8).alias("avg_softmax_0"),
        F.count_if(fn.argmax("v") == 0).alias("n_argmax_0"),
        F.count_if(fn.argmax("v") == 2).alias("n_argmax_2"),
        F.count_if(fn.argmin("v") == 1).alias("n_argmin_1"),
        rnd(F.avg(fn.dot(["a", "b", "c"], [0.5, -2.0, 3.0], 1.0)), 8).alias("avg_dot"),
        rnd(F.avg(fn.array_dot("v", shifted, n=3)), 8).alias("avg_array_dot"),
        rnd(F.avg(fn.array_sq_dist("v", F.array(F.lit(0.5), F.lit(0.5), F.lit(0.5)), n=3)), 8).alias("avg_sq_dist"),
        rnd(F.avg(fn.array_norm("v", n=3)), 8).alias("avg_norm"),
        rnd(F.avg(unit[0]), 8).alias("avg_unit_0"),
        rnd(F.avg(fn.binary_entropy("b")), 8).alias("avg_entropy"),
        rnd(F.avg(F.pow("a", 2) + F.cos("b") + F.exp("c") + F.abs("z") + F.round("z", 1)), 8).alias("avg_elementwise"),
        rnd(F.avg(pr.threshold("a", 0.5).cast("double")), 8).alias("share_threshold"),
    )
