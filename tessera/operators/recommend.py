"""Recommenders on a long, sparse rating table (SURVEY T12, T13, C1-C9, A8, A9,
J1-J5, J8, W6-W8).

Ratings are ``(user, item, rating)`` rows; an unrated cell simply has no
row, so costs and gradients touch rated cells only and the dense
items x users matrix is never built.  Factor tables are ``(id, f_0..f_{k-1})``
(users also carry a bias ``b``).  Joins of ratings to factor tables are
equi-joins on the id; a factor table has one row per id, so adaptive
execution broadcasts it when its runtime size is small and otherwise
splits hot ids with its skew-join handling.  Per-id gradient sums are
grouped aggregates with map-side partial sums, so a hot user or item adds
one row per task to the exchange, not one row per rating.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .factors import ADAM_B1, ADAM_B2, ADAM_EPS, BLOCK_BYTES, recommend_all, squared_errors, train_factors  # noqa: F401  (C2-C4)
from .nearest import nearest_items  # noqa: F401  (C9, J6)

def hash_unit(*parts) -> Column:
    """Deterministic U[0,1) from md5 of the parts joined by '-'; portable to any
    engine with md5 (first 32 bits / 2^32)."""
    key = F.concat_ws("-", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint").cast("double") / F.lit(4294967296.0)


def init_factors(ids: DataFrame, id_col: str, k: int, tag: str, scale: float = 1.0,
                 with_bias: bool = False) -> DataFrame:
    """Factor table with values (u - 0.5) * scale, u = hash_unit(tag, id, j)."""
    cols = [((hash_unit(tag, F.col(id_col), j) - F.lit(0.5)) * F.lit(scale)).alias(f"f_{j}") for j in range(k)]
    if with_bias:
        cols.append(((hash_unit(tag, F.col(id_col), "b") - F.lit(0.5)) * F.lit(scale)).alias("b"))
    return ids.select(id_col, *cols)


# --- T12 / A6 ---------------------------------------------------------------

def item_means(ratings: DataFrame, item: str, rating: str) -> DataFrame:
    """Mean over rated cells only, one row per item (grouped aggregate)."""
    return ratings.groupBy(item).agg(F.avg(rating).alias("item_mean"), F.count(F.lit(1)).alias("n_ratings"))


def normalize_ratings(ratings: DataFrame, item: str, rating: str, out: str = "rating_norm") -> DataFrame:
    """Subtract the item's mean rating (items without ratings have mean 0
    wherever they are joined later, via coalesce)."""
    means = item_means(ratings, item, rating).select(item, "item_mean")
    return ratings.join(means, item).withColumn(out, F.col(rating) - F.col("item_mean"))


# --- C1 / J8 ------------------------------------------------------------------

def _dot_k(k: int, a: str = "x_", b: str = "w_") -> Column:
    return sum((F.col(f"{a}{j}") * F.col(f"{b}{j}") for j in range(1, k)), F.col(f"{a}0") * F.col(f"{b}0"))


def joined_predictions(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str,
                       rating: str, k: int, broadcast_factors: bool = False) -> DataFrame:
    """Ratings joined to item and user factors; err = w_u.x_i + b_u - y.
    ``broadcast_factors`` (for factor tables whose size the caller has
    proven small) keeps the rating table where it is."""
    it = items.select(item, *[F.col(f"f_{j}").alias(f"x_{j}") for j in range(k)])
    us = users.select(user, *[F.col(f"f_{j}").alias(f"w_{j}") for j in range(k)], F.col("b").alias("bu"))
    if broadcast_factors:
        it, us = F.broadcast(it), F.broadcast(us)
    j = ratings.select(user, item, rating).join(it, item).join(us, user)
    return j.withColumn("err", _dot_k(k) + F.col("bu") - F.col(rating))


def factor_sq_sum(fac: DataFrame, k: int) -> Column:
    return F.sum(sum((F.col(f"f_{j}") * F.col(f"f_{j}") for j in range(1, k)), F.col("f_0") * F.col("f_0")))


def cofi_cost(ratings: DataFrame, items: DataFrame, users: DataFrame, user: str, item: str, rating: str,
              k: int, lam: float | Sequence[float]) -> float | list[float]:
    """1/2 sum over rated cells of err^2 + lam/2 (sum W^2 + sum X^2); b unpenalised.  Several ``lam`` give a list of
    costs from one pass over the ratings.  Ratings are joined to factor tables of up to BLOCK_BYTES; larger ones are
    met block by block, as in training: joined, every rating would carry its factors through a shuffle."""
    (w2, nu), (x2, ni) = (fac.agg(factor_sq_sum(fac, k), F.count(F.lit(1))).first() for fac in (users, items))
    w2, x2 = w2 or 0.0, x2 or 0.0
    if 8 * (nu * (k + 1) + ni * k) <= BLOCK_BYTES:
        j = joined_predictions(ratings, items, users, user, item, rating, k)
        sse = j.agg(F.sum(F.col("err") * F.col("err"))).first()[0] or 0.0
    else:
        sse = squared_errors(ratings, items, users, user, item, rating, k)
    costs = [0.5 * sse + v / 2.0 * (w2 + x2) for v in (lam if isinstance(lam, Sequence) else [lam])]
    return costs if isinstance(lam, Sequence) else costs[0]


# --- C2: training by gradient steps is in factors.py ---------------------------

def ml_als(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 10, reg: float = 0.1,
           iters: int = 10, seed: int = 1):
    """Fast path: pyspark.ml ALS (no bias term, count-weighted lambda: a
    different objective from C1)."""
    from pyspark.ml.recommendation import ALS
    return ALS(userCol=user, itemCol=item, ratingCol=rating, rank=rank, regParam=reg, maxIter=iters,
               seed=seed, coldStartStrategy="drop").fit(ratings)


# --- C3-C6 --------------------------------------------------------------------

def score_users(items: DataFrame, item: str, user_rows: list[dict], k: int, item_mean: str | None = None,
                user: str = "user_id", out: str = "score") -> DataFrame:
    """C3 for a requested, bounded list of users: their factors become
    literals and every item row emits one row per requested user (a
    generator over the item table, not a join).  ``item_mean`` adds the
    item's mean rating back."""
    structs = []
    for u in user_rows:
        s = sum((F.col(f"f_{j}") * F.lit(float(u[f"f_{j}"])) for j in range(k)), F.lit(float(u.get("b", 0.0))))
        if item_mean:
            s = s + F.coalesce(F.col(item_mean), F.lit(0.0))
        structs.append(F.struct(F.lit(u[user]).alias(user), s.alias(out)))
    return items.select("*", F.inline(F.array(*structs)))


def top_k(df: DataFrame, group: str | None, order: Sequence[Column], k: int, rn: str = "rank") -> DataFrame:
    """The first k rows per group by ``order`` (row_number <= k lets Spark
    cut each map-side partition to k rows per group before the shuffle)."""
    w = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(*order)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k)


def recommend_unseen(scored: DataFrame, ratings: DataFrame, user: str, item: str, k: int,
                     score: str = "score") -> DataFrame:
    """C4: drop already-rated items (J4 anti join) and keep the top k per user."""
    unseen = scored.join(ratings.select(user, item), [user, item], "left_anti")
    return top_k(unseen, user, [F.col(score).desc(), F.col(item)], k)


# --- A8 / A9 / T13 --------------------------------------------------------------

def genre_rollup(ratings: DataFrame, item_genres: DataFrame, item: str, genre: str, rating: str) -> DataFrame:
    """Per genre the number of items, their mean rating and number of ratings."""
    per_item = ratings.groupBy(item).agg(F.sum(rating).alias("_s"), F.count(rating).alias("_v"), F.count(F.lit(1)).alias("_n"))
    j = per_item.join(item_genres.select(item, genre), item)  # ratings are summed per item before they meet the tags
    return j.groupBy(genre).agg(F.count_distinct(item).alias("num_items"), (F.sum("_s") / F.sum("_v")).alias("ave_rating"),
                                F.sum("_n").alias("num_ratings"))


def most_rated(ratings: DataFrame, item: str, rating: str, k: int = 10) -> DataFrame:
    """Items ranked by number of ratings (then id), with their mean rating."""
    agg = ratings.groupBy(item).agg(F.count(F.lit(1)).alias("num_ratings"), F.avg(rating).alias("ave_rating"))
    return agg.orderBy(F.col("num_ratings").desc(), F.col(item)).limit(k)


def user_profile(ratings: DataFrame, item_genres: DataFrame, user: str, item: str, genre: str, rating: str,
                 levels: Sequence[str]) -> DataFrame:
    """Per user the rating count, mean rating and mean rating per genre
    (pivot over a given, bounded list of genre levels; 0 when none).  Users whose
    items carry no genre keep their row."""
    j = ratings.join(item_genres.select(item, genre), item, "left")
    per = j.groupBy(user).pivot(genre, list(levels)).agg(F.avg(rating))
    per = per.fillna(0.0, subset=list(levels))
    tot = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("rating_count"), F.avg(rating).alias("rating_ave"))
    return tot.join(per, user)


def user_level_means(ratings: DataFrame, item_levels: DataFrame, levels: DataFrame, user: str, item: str, level: str,
                     rating: str) -> DataFrame:
    """T13 in long form: (user, level, code, mean, n) for every user and every level of the dictionary ``levels``
    (level, code), however many there are; mean 0 and n 0 where the user rated nothing of it."""
    per = (ratings.join(item_levels.select(item, F.col(level).alias("level")), item)
           .groupBy(user, "level").agg(F.avg(rating).alias("mean"), F.count(F.lit(1)).alias("n")))
    users = ratings.select(user).distinct()
    codes = levels.agg(F.sort_array(F.collect_list(F.struct("code", "level"))).alias("all"))  # the dictionary, one row
    every = users.withColumn("all", codes.scalar()).select(user, F.inline("all"))
    return every.join(per, [user, "level"], "left").select(
        user, "level", "code", F.coalesce("mean", F.lit(0.0)).alias("mean"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))
