"""Recommender queries.

Ratings: lineitem joined to orders, user = o_custkey, item = l_partkey,
rating = mean l_quantity of the pair.  Users are all customers, items all
parts.  Factors start from md5-hashed values of the id (portable).
"Requested users" (C3-C6, C8) are the three users with the most ratings
(ties by id), found by a top-k over the rating table.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from ..functions.core import array_dot, l2_normalize
from ..operators import recommend as rc
from ..operators.factors import ADAM_B1, ADAM_B2, ADAM_EPS
from ..operators import dense as dn
from ..operators.prepare import level_table, minmax_inverse
from ..session import SWEPT, cut_lineage, session_conf
from .common import rnd, tbl
from .registry import query

RATINGS_SQL = ("ratings AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) AS rating "
               "FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey, l.l_partkey)")
TOPU_SQL = ("topu AS (SELECT user_id FROM ratings GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 3)")


def ratings_frame(spark, sf, materialize: bool = False):
    """The rating table; ``materialize`` writes it once to the shared
    checkpoint folder for queries that read it in several jobs."""
    li = tbl(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = tbl(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    r = (li.join(od, "l_orderkey").groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
         .agg(F.avg("l_quantity").alias("rating")))
    return cut_lineage(r) if materialize else r


def requested_users(ratings) -> list[int]:
    top = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "user_id").limit(3)
    return [r["user_id"] for r in top.collect()]


def _hash_sql(tag: str, id_expr: str, j) -> str:
    return f"((('0x' || substr(md5(concat_ws('-', '{tag}', CAST({id_expr} AS VARCHAR), '{j}')), 1, 8))::BIGINT) / 4294967296.0)"


def _factor_sql(name: str, src: str, id_col: str, out_id: str, tag: str, k: int, bias: bool) -> str:
    cols = [f"({_hash_sql(tag, id_col, j)} - 0.5) AS f_{j}" for j in range(k)]
    if bias:
        cols.append(f"({_hash_sql(tag, id_col, 'b')} - 0.5) AS b")
    return f"{name} AS (SELECT {id_col} AS {out_id}, {', '.join(cols)} FROM {src})"


def factors(spark, sf, k: int):
    items = rc.init_factors(tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id")), "item_id", k, "x")
    users = rc.init_factors(tbl(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")), "user_id", k, "w",
                            with_bias=True)
    return items, users


# --- T12 ------------------------------------------------------------------------

MEANS_SQL = f"""
WITH {RATINGS_SQL},
m AS (SELECT item_id, avg(rating) AS item_mean, count(*) AS n_ratings FROM ratings GROUP BY item_id)
SELECT p.p_partkey AS item_id, round(coalesce(m.item_mean, 0.0), 6) AS item_mean,
       CAST(coalesce(m.n_ratings, 0) AS BIGINT) AS n_ratings
FROM part p LEFT JOIN m ON p.p_partkey = m.item_id
"""


@query("item_mean_normalize", MEANS_SQL)
def item_mean_normalize(spark, sf):
    """Per-item mean over rated cells only (0 for unrated items, by left join + coalesce)."""
    means = rc.item_means(ratings_frame(spark, sf), "item_id", "rating")
    parts = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"))
    j = parts.join(means, "item_id", "left")
    return j.select("item_id", rnd(F.coalesce("item_mean", F.lit(0.0)), 6).alias("item_mean"),
                    F.coalesce("n_ratings", F.lit(0)).cast("long").alias("n_ratings"))


# --- C1 -------------------------------------------------------------------------

K1 = 4


def _cost_sql(lams) -> str:
    dotx = " + ".join(f"i.f_{j} * u.f_{j}" for j in range(K1))
    sq = " + ".join(f"f_{j} * f_{j}" for j in range(K1))
    sels = " UNION ALL ".join(
        f"SELECT 'lambda_{lam}' AS term, round(0.5 * sse + {lam!r} / 2 * (w2 + x2), 4) AS value FROM a" for lam in lams)
    return f"""
WITH {RATINGS_SQL},
{_factor_sql('it', 'part', 'p_partkey', 'item_id', 'x', K1, False)},
{_factor_sql('us', 'customer', 'c_custkey', 'user_id', 'w', K1, True)},
j AS (SELECT ({dotx} + u.b - r.rating) AS err FROM ratings r JOIN it i ON r.item_id = i.item_id
      JOIN us u ON r.user_id = u.user_id),
a AS (SELECT (SELECT sum(err * err) FROM j) AS sse, (SELECT sum({sq}) FROM us) AS w2, (SELECT sum({sq}) FROM it) AS x2)
{sels}
"""


@query("cofi_cost", _cost_sql([0.0, 1.5]))
def cofi_cost_q(spark, sf):
    """Collaborative-filtering cost over rated cells (factor joins), with lambda 0 and 1.5."""
    items, users = factors(spark, sf, K1)
    lams = (0.0, 1.5)
    costs = rc.cofi_cost(ratings_frame(spark, sf), items, users, "user_id", "item_id", "rating", K1, lams)
    rows = [(f"lambda_{lam}", round(cost, 4)) for lam, cost in zip(lams, costs, strict=True)]
    return spark.createDataFrame(rows, "term string, value double")


# --- C2 -------------------------------------------------------------------------

K2, STEPS, LR, LAM = 3, 3, 0.1, 1.0


def _train_sql(k: int, steps: int, digits: int) -> str:
    """Every step unrolled; each step's tables are materialised, as the next one reads them more than once."""
    fn = [f"f_{j}" for j in range(k)]
    un = fn + ["b"]
    sq = " + ".join(f"f_{j} * f_{j}" for j in range(k))
    parts = [RATINGS_SQL,
             "mean AS (SELECT item_id, avg(rating) AS item_mean FROM ratings GROUP BY item_id)",
             "rn AS MATERIALIZED (SELECT r.user_id, r.item_id, r.rating - m.item_mean AS y FROM ratings r JOIN mean m "
             "ON r.item_id = m.item_id)",
             _factor_sql("it0r", "part", "p_partkey", "item_id", "x", k, False),
             _factor_sql("us0r", "customer", "c_custkey", "user_id", "w", k, True),
             "it0 AS (SELECT *, " + ", ".join(f"0.0::DOUBLE AS m_{c}, 0.0::DOUBLE AS v_{c}" for c in fn) + " FROM it0r)",
             "us0 AS (SELECT *, " + ", ".join(f"0.0::DOUBLE AS m_{c}, 0.0::DOUBLE AS v_{c}" for c in un) + " FROM us0r)"]
    costs = []
    for t in range(1, steps + 1):
        p = t - 1
        alpha = LR * math.sqrt(1 - ADAM_B2 ** t) / (1 - ADAM_B1 ** t)
        dotx = " + ".join(f"i.f_{j} * u.f_{j}" for j in range(k))
        parts.append(f"j{t} AS MATERIALIZED (SELECT r.user_id, r.item_id, {', '.join(f'i.f_{j} AS x_{j}, u.f_{j} AS w_{j}' for j in range(k))}, "
                     f"({dotx} + u.b - r.y) AS err FROM rn r JOIN it{p} i ON r.item_id = i.item_id "
                     f"JOIN us{p} u ON r.user_id = u.user_id)")
        parts.append(f"gu{t} AS (SELECT user_id, {', '.join(f'sum(err * x_{j}) AS g_f_{j}' for j in range(k))}, "
                     f"sum(err) AS g_b FROM j{t} GROUP BY user_id)")
        parts.append(f"gi{t} AS (SELECT item_id, {', '.join(f'sum(err * w_{j}) AS g_f_{j}' for j in range(k))} "
                     f"FROM j{t} GROUP BY item_id)")
        parts.append(f"c{t} AS (SELECT {p} AS iter, 0.5 * (SELECT sum(err * err) FROM j{t}) + {LAM!r} / 2 * "
                     f"((SELECT sum({sq}) FROM us{p}) + (SELECT sum({sq}) FROM it{p})) AS cost)")
        costs.append(f"SELECT * FROM c{t}")
        for side, names, key, g in (("us", un, "user_id", "gu"), ("it", fn, "item_id", "gi")):
            lam = {c: (0.0 if c == "b" else LAM) for c in names}
            gexpr = {c: f"(coalesce(g.g_{c}, 0.0) + {lam[c]!r} * s.{c})" for c in names}
            mv = ", ".join(f"s.m_{c} + ({gexpr[c]} - s.m_{c}) * {1 - ADAM_B1!r} AS m_{c}, "
                           f"s.v_{c} + ({gexpr[c]} * {gexpr[c]} - s.v_{c}) * {1 - ADAM_B2!r} AS v_{c}" for c in names)
            parts.append(f"{side}{t}a AS (SELECT s.{key}, {', '.join('s.' + c for c in names)}, {mv} "
                         f"FROM {side}{p} s LEFT JOIN {g}{t} g ON s.{key} = g.{key})")
            upd = ", ".join(f"{c} - {alpha!r} * m_{c} / (sqrt(v_{c}) + {ADAM_EPS!r}) AS {c}" for c in names)
            keep = ", ".join(f"m_{c}, v_{c}" for c in names)
            parts.append(f"{side}{t} AS MATERIALIZED (SELECT {key}, {upd}, {keep} FROM {side}{t}a)")
    final_i = f"it{steps}"
    final_u = f"us{steps}"
    return ("WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(
        f"SELECT CAST(iter AS BIGINT) AS iter, round(cost, {digits}) AS cost FROM c{t}" for t in range(1, steps + 1))
        + f" UNION ALL SELECT {steps}::BIGINT, round(0.5 * (SELECT sum(power("
        + " + ".join(f"i.f_{j} * u.f_{j}" for j in range(k))
        + f" + u.b - r.y, 2)) FROM rn r JOIN {final_i} i ON r.item_id = i.item_id JOIN {final_u} u "
          f"ON r.user_id = u.user_id) + {LAM!r} / 2 * ((SELECT sum({sq}) FROM {final_u}) + (SELECT sum({sq}) "
          f"FROM {final_i})), {digits})")


@query("cofi_train", _train_sql(K2, STEPS, 6))
def cofi_train(spark, sf):
    """C2 + T12: Adam steps on the C1 objective over mean-normalised ratings; cost before each step and after the last."""
    items, users = factors(spark, sf, K2)
    rn = rc.normalize_ratings(ratings_frame(spark, sf), "item_id", "rating").select(
        "user_id", "item_id", F.col("rating_norm").alias("y"))
    rn = rn.cache()
    it, us, hist = rc.train_factors(rn, items, users, "user_id", "item_id", "y", K2, LAM, LR, STEPS)
    final = rc.cofi_cost(rn, it, us, "user_id", "item_id", "y", K2, LAM)
    rn.unpersist()
    rows = [(i, round(c, 6)) for i, c in hist] + [(STEPS, round(final, 6))]
    return spark.createDataFrame(rows, "iter long, cost double")


K16, STEPS16 = 16, 20


@query("cofi_train_16", _train_sql(K16, STEPS16, 3))
def cofi_train_16(spark, sf):
    """C2 + T12: twenty Adam steps with 16 factors in blocks of users and items; cost before each step and after the last."""
    items, users = factors(spark, sf, K16)
    with session_conf(spark, SWEPT):
        rn = cut_lineage(rc.normalize_ratings(ratings_frame(spark, sf), "item_id", "rating").select(
            "user_id", "item_id", F.col("rating_norm").alias("y")))
    it, us, hist = rc.train_factors(rn, items, users, "user_id", "item_id", "y", K16, LAM, LR, STEPS16)
    final = rc.cofi_cost(rn, it, us, "user_id", "item_id", "y", K16, LAM)
    rows = [(i, round(c, 3)) for i, c in hist] + [(STEPS16, round(final, 3))]
    return spark.createDataFrame(rows, "iter long, cost double")


# --- C3 / C4 / C5 / C6 -------------------------------------------------------------

def scored_requested(spark, sf):
    r = ratings_frame(spark, sf, materialize=True)
    users = requested_users(r)
    items, ufac = factors(spark, sf, K1)
    urows = [row.asDict() for row in ufac.where(F.col("user_id").isin(users)).collect()]
    means = rc.item_means(r, "item_id", "rating")
    it = items.join(means, "item_id", "left")
    # of the ratings only the requested users' are needed from here on
    return r.where(F.col("user_id").isin(users)), rc.score_users(it, "item_id", urows, K1, item_mean="item_mean")


SCORE_BASE = f"""{RATINGS_SQL}, {TOPU_SQL},
{_factor_sql('it', 'part', 'p_partkey', 'item_id', 'x', K1, False)},
{_factor_sql('us', 'customer', 'c_custkey', 'user_id', 'w', K1, True)},
mean AS (SELECT item_id, avg(rating) AS item_mean, count(*) AS n_ratings FROM ratings GROUP BY item_id),
sc AS (SELECT u.user_id, i.item_id, {' + '.join(f'i.f_{j} * u.f_{j}' for j in range(K1))} + u.b
              + coalesce(m.item_mean, 0.0) AS score, coalesce(m.n_ratings, 0) AS n_ratings, m.item_mean
       FROM it i CROSS JOIN (SELECT * FROM us WHERE user_id IN (SELECT user_id FROM topu)) u
       LEFT JOIN mean m ON m.item_id = i.item_id)"""

RECO_SQL = f"""
WITH {SCORE_BASE},
un AS (SELECT * FROM sc WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.user_id = sc.user_id AND r.item_id = sc.item_id)),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rnk FROM un)
SELECT rk.user_id, CAST(rnk AS BIGINT) AS rank, rk.item_id, p.p_name, round(score, 6) AS score
FROM rk JOIN part p ON p.p_partkey = rk.item_id WHERE rnk <= 5
"""


@query("recommend_unseen", RECO_SQL)
def recommend_unseen(spark, sf):
    """C3 scores (+ item mean) for the requested users, C4: J4 anti join of rated items, W7 top-5 per user, J1 names."""
    r, sc = scored_requested(spark, sf)
    top = rc.recommend_unseen(sc, r, "user_id", "item_id", 5)
    names = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_name")
    return top.join(names, "item_id").select("user_id", F.col("rank").cast("long"), "item_id", "p_name",
                                             rnd("score", 6).alias("score"))


RECO_ALL_SQL = f"""
WITH {RATINGS_SQL},
{_factor_sql('it', 'part', 'p_partkey', 'item_id', 'x', K1, False)},
{_factor_sql('us', 'customer', 'c_custkey', 'user_id', 'w', K1, True)},
mean AS (SELECT item_id, avg(rating) AS item_mean FROM ratings GROUP BY item_id),
sc AS (SELECT u.user_id, i.item_id, {' + '.join(f'i.f_{j} * u.f_{j}' for j in range(K1))} + u.b + coalesce(m.item_mean, 0.0) AS score
       FROM it i LEFT JOIN mean m ON m.item_id = i.item_id CROSS JOIN us u),
un AS (SELECT sc.* FROM sc ANTI JOIN ratings r ON r.user_id = sc.user_id AND r.item_id = sc.item_id)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank, item_id, round(score, 6) AS score
FROM un QUALIFY rank <= 5
"""


@query("recommend_all_users", RECO_ALL_SQL)
def recommend_all_users(spark, sf):
    """C3/C4 for every user: scores (+ item mean) by blocks of users and items, the best five unrated items of each."""
    r = ratings_frame(spark, sf, materialize=True)
    items, users = factors(spark, sf, K1)
    items = items.join(rc.item_means(r, "item_id", "rating").select("item_id", "item_mean"), "item_id", "left")
    top = rc.recommend_all(r, items, users, "user_id", "item_id", K1, 5, "item_mean")
    return top.select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", rnd("score", 6).alias("score"))


ORIG_SQL = f"""
WITH {SCORE_BASE}
SELECT sc.user_id, sc.item_id, round(r.rating, 6) AS rating, round(sc.score, 6) AS predicted
FROM sc JOIN ratings r ON r.user_id = sc.user_id AND r.item_id = sc.item_id
"""


@query("original_vs_predicted", ORIG_SQL)
def original_vs_predicted(spark, sf):
    """Original rating next to the prediction for the requested users' rated items."""
    r, sc = scored_requested(spark, sf)
    j = sc.join(r.select("user_id", "item_id", "rating"), ["user_id", "item_id"])
    return j.select("user_id", "item_id", rnd("rating", 6).alias("rating"), rnd("score", 6).alias("predicted"))


BLEND_SQL = f"""
WITH {SCORE_BASE},
first_user AS (SELECT user_id FROM topu ORDER BY user_id LIMIT 1),
top300 AS (SELECT * FROM sc WHERE user_id = (SELECT user_id FROM first_user) ORDER BY score DESC, item_id LIMIT 300)
SELECT item_id, round(score, 6) AS score, round(item_mean, 6) AS item_mean, CAST(n_ratings AS BIGINT) AS n_ratings
FROM top300 WHERE n_ratings > 20
"""


@query("blend_popular", BLEND_SQL)
def blend_popular(spark, sf):
    """The 300 best predictions of one requested user, kept when rated more than 20 times, by mean rating."""
    _, sc = scored_requested(spark, sf)
    first = sc.agg(F.min("user_id")).first()[0]
    top = sc.where(F.col("user_id") == first).orderBy(F.col("score").desc(), "item_id").limit(300)
    top = top.where(F.coalesce("n_ratings", F.lit(0)) > 20).orderBy(F.col("item_mean").desc())
    return top.select("item_id", rnd("score", 6).alias("score"), rnd("item_mean", 6).alias("item_mean"),
                      F.col("n_ratings").cast("long"))


# --- C9 -------------------------------------------------------------------------

NN_SQL = """
WITH pts AS (SELECT vec_id, j.range AS dim, CAST(embedding[j.range + 1] AS DOUBLE) AS x FROM embeddings, range(64) j),
d AS (SELECT a.vec_id, b.vec_id AS other, sum(power(a.x - b.x, 2)) AS dist FROM pts a JOIN pts b
      ON a.dim = b.dim AND a.vec_id <> b.vec_id GROUP BY a.vec_id, b.vec_id)
SELECT vec_id, other AS nearest_id, round(dist, 6) AS sq_dist FROM d
QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) = 1
"""


@query("nearest_item", NN_SQL)
def nearest_item(spark, sf):
    """Exact nearest other embedding (lowest id on ties) by blocked co-groups; no pair rows emitted."""
    from ..functions.core import array_cols
    emb = tbl(spark, sf, "embeddings").select("vec_id", *array_cols("embedding", 64, "e"))
    nn = rc.nearest_items(emb, "vec_id", [f"e{i}" for i in range(64)])
    return nn.select("vec_id", "nearest_id", rnd("sq_dist", 6).alias("sq_dist"))


# --- A8 / A9 / T13 ----------------------------------------------------------------

ROLLUP_SQL = f"""
WITH {RATINGS_SQL},
tags AS (SELECT p_partkey AS item_id, unnest(regexp_split_to_array(p_name, ' ')) AS tag FROM part)
SELECT t.tag, count(DISTINCT r.item_id) AS num_items, round(avg(r.rating), 6) AS ave_rating, count(*) AS num_ratings
FROM ratings r JOIN tags t ON r.item_id = t.item_id GROUP BY t.tag
"""


@query("genre_rollup", ROLLUP_SQL)
def genre_rollup_q(spark, sf):
    """A8 with P10: name words as multi-value tags (split + explode), per tag items, mean rating, ratings."""
    from ..operators.prepare import explode_multi
    tags = explode_multi(tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_name"),
                         "p_name", " ", "tag")
    out = rc.genre_rollup(ratings_frame(spark, sf), tags, "item_id", "tag", "rating")
    return out.select("tag", "num_items", rnd("ave_rating", 6).alias("ave_rating"), "num_ratings")


TOP_SQL = f"""
WITH {RATINGS_SQL},
a AS (SELECT item_id, count(*) AS num_ratings, avg(rating) AS ave_rating FROM ratings GROUP BY item_id
      ORDER BY num_ratings DESC, item_id LIMIT 10)
SELECT a.item_id, a.num_ratings, round(a.ave_rating, 6) AS ave_rating, p.p_name FROM a JOIN part p ON p.p_partkey = a.item_id
"""


@query("most_rated_items", TOP_SQL)
def most_rated_items(spark, sf):
    """The 10 most rated items with their mean rating and name."""
    top = rc.most_rated(ratings_frame(spark, sf), "item_id", "rating", 10)
    names = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_name")
    # the top-10 side is the bounded one: broadcast it, stream the name table past it
    return names.join(F.broadcast(top), "item_id").select("item_id", "num_ratings", rnd("ave_rating", 6)
                                                           .alias("ave_rating"), "p_name")


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

PROFILE_SQL = f"""
WITH {RATINGS_SQL},
j AS (SELECT r.*, p.p_type FROM ratings r JOIN part p ON p.p_partkey = r.item_id)
SELECT user_id, count(*) AS rating_count, round(avg(rating), 6) AS rating_ave,
       {', '.join(f"round(coalesce(avg(rating) FILTER (WHERE p_type = '{t}'), 0.0), 6) AS {t}" for t in TYPES)}
FROM j GROUP BY user_id
"""


@query("user_profile", PROFILE_SQL)
def user_profile_q(spark, sf):
    """Per user rating count, mean rating and mean rating per part type (pivot over the 6 known levels)."""
    it = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    prof = rc.user_profile(ratings_frame(spark, sf), it, "user_id", "item_id", "p_type", "rating", TYPES)
    return prof.select("user_id", "rating_count", rnd("rating_ave", 6).alias("rating_ave"),
                       *[rnd(t, 6).alias(t) for t in TYPES])


LEVELS_SQL = f"""
WITH {RATINGS_SQL},
lv AS (SELECT level, row_number() OVER (ORDER BY level) - 1 AS code FROM (SELECT DISTINCT p_type AS level FROM part WHERE p_type IS NOT NULL)),
m AS (SELECT r.user_id, p.p_type AS level, avg(r.rating) AS mean, count(*) AS n FROM ratings r JOIN part p ON p.p_partkey = r.item_id GROUP BY ALL)
SELECT u.user_id, lv.level, lv.code, round(coalesce(m.mean, 0.0), 6) AS mean, coalesce(m.n, 0) AS n
FROM (SELECT DISTINCT user_id FROM ratings) u CROSS JOIN lv LEFT JOIN m ON m.user_id = u.user_id AND m.level = lv.level
"""


@query("user_profile_levels", LEVELS_SQL)
def user_profile_levels(spark, sf):
    """T13 + P9 with the levels of the data: mean rating of every user for every part type of the level dictionary."""
    part = tbl(spark, sf, "part")
    it = part.select(F.col("p_partkey").alias("item_id"), "p_type")
    r = ratings_frame(spark, sf, materialize=True)
    out = rc.user_level_means(r, it, level_table(part, "p_type"), "user_id", "item_id", "p_type", "rating")
    return out.select("user_id", "level", "code", rnd("mean", 6).alias("mean"), "n")


# --- C7 / C8: two towers ---------------------------------------------------------

def _tower(n_in: int, n_hidden: int, n_out: int, seed: int):
    """Fixed tower weights from a simple rule (the query's given parameters)."""
    w1 = np.array([[round(np.sin(seed + 3 * i + 7 * j), 4) for j in range(n_hidden)] for i in range(n_in)])
    w2 = np.array([[round(np.cos(seed + 5 * i + 2 * j), 4) for j in range(n_out)] for i in range(n_hidden)])
    return [(w1, np.zeros(n_hidden), "relu"), (w2, np.zeros(n_out), "linear")]


USER_IN = ["rating_count_s", "rating_ave_s"] + [f"{t}_s" for t in TYPES]
ITEM_IN = ["p_size_s", "price_s"] + [f"is_{t}" for t in TYPES]
UT, IT = _tower(8, 4, 3, 1), _tower(8, 4, 3, 2)


def _tower_sql(inputs: list[str], layers) -> list[str]:
    cur = inputs
    for w, b, act in layers:
        nxt = []
        for j in range(w.shape[1]):
            z = f"({float(b[j])!r} + " + " + ".join(f"({c}) * {float(w[i, j])!r}" for i, c in enumerate(cur)) + ")"
            nxt.append(f"greatest({z}, 0.0)" if act == "relu" else z)
        cur = nxt
    return cur


def _two_tower_sql() -> str:
    ucols = _tower_sql(USER_IN, UT)
    icols = _tower_sql(ITEM_IN, IT)
    un = "sqrt(" + " + ".join(f"u{j} * u{j}" for j in range(3)) + ")"
    inn = "sqrt(" + " + ".join(f"v{j} * v{j}" for j in range(3)) + ")"
    return f"""
WITH {RATINGS_SQL}, {TOPU_SQL},
j AS (SELECT r.*, p.p_type FROM ratings r JOIN part p ON p.p_partkey = r.item_id),
prof AS (SELECT user_id, count(*) AS rating_count, avg(rating) AS rating_ave,
       {', '.join(f"coalesce(avg(rating) FILTER (WHERE p_type = '{t}'), 0.0) AS {t}" for t in TYPES)} FROM j GROUP BY user_id),
ps AS (SELECT max(rating_count) AS mc FROM prof),
us AS (SELECT user_id, rating_count / mc AS rating_count_s, rating_ave / 50.0 AS rating_ave_s,
       {', '.join(f'{t} / 50.0 AS {t}_s' for t in TYPES)} FROM prof, ps WHERE user_id IN (SELECT user_id FROM topu)),
ut AS (SELECT user_id, {', '.join(f'{c} AS u{j}' for j, c in enumerate(ucols))} FROM us),
utn AS (SELECT user_id, {', '.join(f'u{j} / greatest({un}, 1e-6) AS u{j}' for j in range(3))} FROM ut),
its AS (SELECT p_partkey AS item_id, p_size / 50.0 AS p_size_s, p_retailprice / 2000.0 AS price_s,
        {', '.join(f"CASE WHEN p_type = '{t}' THEN 1.0 ELSE 0.0 END AS is_{t}" for t in TYPES)} FROM part),
itt AS (SELECT item_id, {', '.join(f'{c} AS v{j}' for j, c in enumerate(icols))} FROM its),
itn AS (SELECT item_id, {', '.join(f'v{j} / greatest({inn}, 1e-6) AS v{j}' for j in range(3))} FROM itt),
rng AS (SELECT min(rating) AS lo, max(rating) AS hi FROM ratings),
sc AS (SELECT u.user_id, i.item_id, {' + '.join(f'u.u{j} * i.v{j}' for j in range(3))} AS s FROM utn u CROSS JOIN itn i),
pr AS (SELECT sc.*, (s + 1.0) / 2.0 * (hi - lo) + lo AS predicted FROM sc, rng),
seen AS (SELECT pr.*, coalesce(r.rating, 0.0) AS rating FROM pr LEFT JOIN ratings r ON r.user_id = pr.user_id
         AND r.item_id = pr.item_id),
rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY predicted DESC, item_id) AS rnk FROM seen)
SELECT rk.user_id, CAST(rnk AS BIGINT) AS rank, rk.item_id, p.p_name, round(predicted, 6) AS predicted,
       round(rating, 6) AS rating FROM rk JOIN part p ON p.p_partkey = rk.item_id WHERE rnk <= 5
"""


@query("two_tower_recommend", _two_tower_sql())
def two_tower_recommend(spark, sf):
    """User tower on the T13 profile, item tower on part features (R1/R2), L2-normalised (F8) dot (F6),
    T3 inverse scaling to the rating range, J2 left join of the user's own rating (0 if none), W7 top-5, J1 names."""
    r = ratings_frame(spark, sf, materialize=True)
    users = requested_users(r)
    it = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    prof = rc.user_profile(r, it, "user_id", "item_id", "p_type", "rating", TYPES)
    mc = prof.agg(F.max("rating_count")).first()[0]
    us = prof.where(F.col("user_id").isin(users)).select(
        "user_id", (F.col("rating_count") / F.lit(float(mc))).alias("rating_count_s"),
        (F.col("rating_ave") / 50.0).alias("rating_ave_s"), *[(F.col(t) / 50.0).alias(f"{t}_s") for t in TYPES])
    ut = dn.forward(us, USER_IN, UT, "u")
    uvec = ut.select("user_id", l2_normalize(F.array("u0", "u1", "u2"), 1e-12, n=3).alias("uv")).collect()
    part = tbl(spark, sf, "part")
    its = part.select(F.col("p_partkey").alias("item_id"), "p_name", (F.col("p_size") / 50.0).alias("p_size_s"),
                      (F.col("p_retailprice") / 2000.0).alias("price_s"),
                      *[F.when(F.col("p_type") == t, 1.0).otherwise(0.0).alias(f"is_{t}") for t in TYPES])
    itn = dn.forward(its, ITEM_IN, IT, "v").select("item_id", "p_name", l2_normalize(
        F.array("v0", "v1", "v2"), 1e-12, n=3).alias("iv"))
    # J3 as a generator: each item row emits one row per requested user (literal user vectors)
    scored = itn.select("item_id", "p_name", F.inline(F.array(*[
        F.struct(F.lit(u["user_id"]).alias("user_id"), array_dot(F.col("iv"), F.array(*[F.lit(float(x)) for x in u["uv"]]),
                                                                 n=3).alias("s")) for u in uvec])))
    rng = r.agg(F.min("rating").alias("lo"), F.max("rating").alias("hi")).first()
    scored = scored.withColumn("predicted", minmax_inverse(F.col("s"), (rng["lo"], rng["hi"])))
    seen = scored.join(r.select("user_id", "item_id", "rating"), ["user_id", "item_id"], "left").withColumn(
        "rating", F.coalesce("rating", F.lit(0.0)))
    top = rc.top_k(seen, "user_id", [F.col("predicted").desc(), F.col("item_id")], 5)
    return top.select("user_id", F.col("rank").cast("long"), "item_id", "p_name", rnd("predicted", 6).alias("predicted"),
                      rnd("rating", 6).alias("rating"))



ITEM_PROFILE_SQL = f"""
WITH {RATINGS_SQL},
m AS (SELECT item_id, avg(rating) AS ave_rating, count(*) AS n_ratings FROM ratings GROUP BY item_id)
SELECT p.p_partkey AS item_id, p.p_size, round(coalesce(m.ave_rating, 0.0), 6) AS ave_rating,
       CAST(coalesce(m.n_ratings, 0) AS BIGINT) AS n_ratings,
       {', '.join(f"CAST(CASE WHEN p.p_type = '{t}' THEN 1 ELSE 0 END AS INTEGER) AS p_type_{t}" for t in TYPES)}
FROM part p LEFT JOIN m ON m.item_id = p.p_partkey
"""


@query("item_profile", ITEM_PROFILE_SQL)
def item_profile(spark, sf):
    """T13 item side: size, mean rating and rating count (0 when unrated), P9 one-hot type flags."""
    from ..operators.prepare import one_hot
    part = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_size", "p_type")
    means = rc.item_means(ratings_frame(spark, sf), "item_id", "rating")
    j = one_hot(part, ["p_type"]).join(means, "item_id", "left")
    return j.select("item_id", "p_size", rnd(F.coalesce("item_mean", F.lit(0.0)), 6).alias("ave_rating"),
                    F.coalesce("n_ratings", F.lit(0)).cast("long").alias("n_ratings"),
                    *[f"p_type_{t}" for t in TYPES])


def _new_user_sql() -> str:
    ucols = _tower_sql(USER_IN, UT)
    icols = _tower_sql(ITEM_IN, IT)
    un = "sqrt(" + " + ".join(f"u{j} * u{j}" for j in range(3)) + ")"
    inn = "sqrt(" + " + ".join(f"v{j} * v{j}" for j in range(3)) + ")"
    return f"""
WITH {RATINGS_SQL},
j AS (SELECT r.*, p.p_type FROM ratings r JOIN part p ON p.p_partkey = r.item_id),
prof AS (SELECT user_id, count(*) AS rating_count, avg(rating) AS rating_ave,
       {', '.join(f"coalesce(avg(rating) FILTER (WHERE p_type = '{t}'), 0.0) AS {t}" for t in TYPES)} FROM j GROUP BY user_id),
ps AS (SELECT max(rating_count) AS mc FROM prof),
us AS (SELECT avg(rating_count) / max(mc) AS rating_count_s, avg(rating_ave) / 50.0 AS rating_ave_s,
       {', '.join(f'avg({t}) / 50.0 AS {t}_s' for t in TYPES)} FROM prof, ps),
ut AS (SELECT {', '.join(f'{c} AS u{j}' for j, c in enumerate(ucols))} FROM us),
utn AS (SELECT {', '.join(f'u{j} / greatest({un}, 1e-6) AS u{j}' for j in range(3))} FROM ut),
its AS (SELECT p_partkey AS item_id, p_name, p_size / 50.0 AS p_size_s, p_retailprice / 2000.0 AS price_s,
        {', '.join(f"CASE WHEN p_type = '{t}' THEN 1.0 ELSE 0.0 END AS is_{t}" for t in TYPES)} FROM part),
itt AS (SELECT item_id, p_name, {', '.join(f'{c} AS v{j}' for j, c in enumerate(icols))} FROM its),
itn AS (SELECT item_id, p_name, {', '.join(f'v{j} / greatest({inn}, 1e-6) AS v{j}' for j in range(3))} FROM itt),
rng AS (SELECT min(rating) AS lo, max(rating) AS hi FROM ratings),
sc AS (SELECT i.item_id, i.p_name, ({' + '.join(f'u.u{j} * i.v{j}' for j in range(3))} + 1.0) / 2.0 * (hi - lo) + lo AS predicted
       FROM itn i, utn u, rng)
SELECT CAST(row_number() OVER (ORDER BY predicted DESC, item_id) AS BIGINT) AS rank, item_id, p_name,
       round(predicted, 6) AS predicted FROM sc QUALIFY rank <= 10
"""


@query("new_user_recommend", _new_user_sql())
def new_user_recommend(spark, sf):
    """C8 (new user): a cold-start user with the average profile (T13), user tower, every item scored once for
    that user (J3 as a projection), T3 inverse scaling, W7 top-10 with names (J1)."""
    r = ratings_frame(spark, sf, materialize=True)
    it = tbl(spark, sf, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    prof = rc.user_profile(r, it, "user_id", "item_id", "p_type", "rating", TYPES)
    mc = prof.agg(F.max("rating_count")).first()[0]
    avg = prof.agg((F.avg("rating_count") / F.lit(float(mc))).alias("rating_count_s"),
                   (F.avg("rating_ave") / 50.0).alias("rating_ave_s"), *[(F.avg(t) / 50.0).alias(f"{t}_s") for t in TYPES])
    uv = dn.forward(avg, USER_IN, UT, "u").select(l2_normalize(F.array("u0", "u1", "u2"), 1e-12, n=3)
                                                   .alias("uv")).first()["uv"]
    part = tbl(spark, sf, "part")
    its = part.select(F.col("p_partkey").alias("item_id"), "p_name", (F.col("p_size") / 50.0).alias("p_size_s"),
                      (F.col("p_retailprice") / 2000.0).alias("price_s"),
                      *[F.when(F.col("p_type") == t, 1.0).otherwise(0.0).alias(f"is_{t}") for t in TYPES])
    itn = dn.forward(its, ITEM_IN, IT, "v").select("item_id", "p_name", l2_normalize(
        F.array("v0", "v1", "v2"), 1e-12, n=3).alias("iv"))
    rng = r.agg(F.min("rating").alias("lo"), F.max("rating").alias("hi")).first()
    s = array_dot(F.col("iv"), F.array(*[F.lit(float(x)) for x in uv]), n=3)
    scored = itn.select("item_id", "p_name", minmax_inverse(s, (rng["lo"], rng["hi"])).alias("predicted"))
    top = rc.top_k(scored, None, [F.col("predicted").desc(), F.col("item_id")], 10)
    return top.select(F.col("rank").cast("long"), "item_id", "p_name", rnd("predicted", 6).alias("predicted"))


@query("als_fit")
def als_fit(spark, sf):
    """C2 fast path: pyspark.ml ALS (rank 4, 5 sweeps) on the rating table; training RMSE and factor counts."""
    r = ratings_frame(spark, sf, materialize=True)
    model = rc.ml_als(r, "user_id", "item_id", "rating", rank=4, reg=0.1, iters=5)
    pred = model.transform(r)
    rmse = pred.agg(F.sqrt(F.avg((F.col("prediction") - F.col("rating")) ** 2))).first()[0]
    return spark.createDataFrame([(round(float(rmse), 4), model.userFactors.count(), model.itemFactors.count())],
                                 "train_rmse double, n_user_factors long, n_item_factors long")
