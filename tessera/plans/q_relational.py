"""Sources, sinks, aggregates, windows and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import readers as rd
from ..sources.synthetic import replicate
from .common import LI_X, rnd, tbl
from .registry import query

IO_SQL = f"""
SELECT count(*) AS n, {', '.join(f'round(sum({c}), 4) AS sum_{c}' for c in LI_X)},
       CAST(count(*) - 1 AS BIGINT) AS max_id, CAST(count(*) AS BIGINT) AS n_header_read,
       {', '.join(f'round(sum({c}), 4) AS hsum_{c}' for c in LI_X)}
FROM lineitem
"""


@query("csv_roundtrip", IO_SQL)
def csv_roundtrip(spark, sf):
    """S12 sink (CSV into the shared checkpoint folder), S1 headerless reader with explicit schema and row
    positions, S2 header line skipped by option, S3 header reader, S4 external header file; totals read back."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/io-{uuid.uuid4().hex}"
    li = tbl(spark, sf, "lineitem").select(*LI_X)
    li.write.mode("overwrite").csv(f"{base}/plain")
    li.write.mode("overwrite").option("header", True).csv(f"{base}/with_header")
    spark.createDataFrame([(",".join(LI_X),)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/names")
    plain = rd.read_numeric_csv(spark, f"{base}/plain", LI_X)
    named = rd.apply_header_file(spark, rd.read_numeric_csv(spark, f"{base}/plain", ["a", "b", "c"], with_id=False),
                                 f"{base}/names")
    hdr = rd.read_csv_with_header(spark, f"{base}/with_header", rd.numeric_schema(LI_X))
    skipped = rd.read_numeric_csv(spark, f"{base}/with_header", LI_X, header=True, with_id=False)
    a = plain.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 4).alias(f"sum_{c}") for c in LI_X],
                  F.max("id").alias("max_id")).first()
    h = hdr.agg(F.count(F.lit(1)).alias("n"), *[F.round(F.sum(c), 4).alias(f"hsum_{c}") for c in LI_X]).first()
    if named.columns != LI_X or skipped.count() != h["n"]:
        raise RuntimeError("header handling lost or renamed data")
    row = (a["n"], *[a[f"sum_{c}"] for c in LI_X], a["max_id"], h["n"], *[h[f"hsum_{c}"] for c in LI_X])
    schema = ("n long, " + ", ".join(f"sum_{c} double" for c in LI_X) + ", max_id long, n_header_read long, "
              + ", ".join(f"hsum_{c} double" for c in LI_X))
    return spark.createDataFrame([row], schema)


REPL_SQL = """
SELECT n_regionkey, CAST(count(*) * 3 AS BIGINT) AS n_rows FROM nation GROUP BY n_regionkey
"""


@query("replicate_rows", REPL_SQL)
def replicate_rows(spark, sf):
    """Every nation row three times (a generator, not a join), counted per region."""
    r = replicate(tbl(spark, sf, "nation"), 3)
    return r.groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n_rows"))


STATS_SQL = """
SELECT l_returnflag, round(sum(l_quantity), 4) AS sum_qty, round(avg(l_quantity), 8) AS mean_qty,
       min(l_quantity) AS min_qty, max(l_quantity) AS max_qty, count(*) AS n,
       round(stddev_pop(l_quantity), 8) AS sd_qty, round(var_pop(l_quantity), 8) AS var_qty
FROM lineitem GROUP BY l_returnflag
"""


@query("column_stats", STATS_SQL)
def column_stats(spark, sf):
    """A1: sum, mean, min, max, count, population sd and variance per group."""
    li = tbl(spark, sf, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.sum("l_quantity"), 4).alias("sum_qty"), F.round(F.avg("l_quantity"), 8).alias("mean_qty"),
        F.min("l_quantity").alias("min_qty"), F.max("l_quantity").alias("max_qty"), F.count(F.lit(1)).alias("n"),
        F.round(F.stddev_pop("l_quantity"), 8).alias("sd_qty"), F.round(F.var_pop("l_quantity"), 8).alias("var_qty"))


CLASS_SQL = """
SELECT quality, count(*) AS n, round(count(*) / (SELECT count(*) FROM labels), 8) AS share,
       round(avg(toxic), 8) AS toxic_rate FROM labels GROUP BY quality
"""


@query("class_counts", CLASS_SQL)
def class_counts(spark, sf):
    """A3: class counts and proportions (and the mean of a second 0/1 label per class)."""
    lab = tbl(spark, sf, "labels")
    total = lab.count()
    return lab.groupBy("quality").agg(F.count(F.lit(1)).alias("n"),
                                      F.round(F.count(F.lit(1)) / F.lit(float(total)), 8).alias("share"),
                                      F.round(F.avg("toxic"), 8).alias("toxic_rate"))


DISTINCT_SQL = "SELECT DISTINCT label FROM embeddings"


@query("distinct_labels", DISTINCT_SQL)
def distinct_labels(spark, sf):
    """A4: the distinct class labels."""
    return tbl(spark, sf, "embeddings").select("label").distinct()


ARG_SQL = """
SELECT o_custkey,
       arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS best_order,
       arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest_order,
       round(max(o_totalprice), 4) AS max_price
FROM orders GROUP BY o_custkey
"""


@query("argmax_per_group", ARG_SQL)
def argmax_per_group(spark, sf):
    """Per customer the order with the highest / lowest price (lowest key on ties) via max_by / min_by."""
    o = tbl(spark, sf, "orders")
    return o.groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"))).alias("best_order"),
        F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest_order"),
        F.round(F.max("o_totalprice"), 4).alias("max_price"))


TOPK_SQL = """
SELECT c_nationkey, CAST(rk AS BIGINT) AS rank, c_custkey, round(c_acctbal, 4) AS c_acctbal FROM (
  SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rk FROM customer)
WHERE rk <= 3
"""


@query("top_k_per_group", TOPK_SQL)
def top_k_per_group(spark, sf):
    """Top-3 customers by balance per nation (row_number <= k, limited per map partition before the shuffle)."""
    from ..operators.recommend import top_k
    c = tbl(spark, sf, "customer")
    t = top_k(c, "c_nationkey", [F.col("c_acctbal").desc(), F.col("c_custkey")], 3)
    return t.select("c_nationkey", F.col("rank").cast("long"), "c_custkey", rnd("c_acctbal", 4).alias("c_acctbal"))


SAMPLE_SQL = """
SELECT event_id, user_id, event_type, round(value, 4) AS value FROM events
ORDER BY md5(concat(CAST(event_id AS VARCHAR), '-42')) LIMIT 64
"""


@query("sample_rows", SAMPLE_SQL)
def sample_rows(spark, sf):
    """A reproducible 64-row sample without replacement (seeded hash order, top-k)."""
    e = tbl(spark, sf, "events")
    s = e.orderBy(F.md5(F.concat(F.col("event_id").cast("string"), F.lit("-42")))).limit(64)
    return s.select("event_id", "user_id", "event_type", rnd("value", 4).alias("value"))


NEWUSER_SQL = """
WITH ratings AS (SELECT o.o_custkey AS user_id, l.l_partkey AS item_id, avg(l.l_quantity) AS rating
                 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2),
top AS (SELECT item_id FROM ratings GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 10),
mx AS (SELECT max(rating) AS r FROM ratings),
u AS (SELECT * FROM ratings UNION ALL SELECT -1, top.item_id, mx.r FROM top, mx)
SELECT item_id, CAST(count(*) AS BIGINT) AS n_ratings, round(avg(rating), 6) AS item_mean FROM u
WHERE item_id IN (SELECT item_id FROM top) GROUP BY item_id
"""


@query("add_new_user", NEWUSER_SQL)
def add_new_user(spark, sf):
    """Prepend a new user's ratings (top rating for the 10 most rated items) with unionByName, then T12 means."""
    from ..operators.recommend import item_means, most_rated
    from .q_recommend import ratings_frame
    r = ratings_frame(spark, sf, materialize=True)
    top = most_rated(r, "item_id", "rating", 10).select("item_id")
    best = r.agg(F.max("rating")).first()[0]
    new = top.select(F.lit(-1).cast("long").alias("user_id"), "item_id", F.lit(float(best)).alias("rating"))
    allr = new.unionByName(r)
    m = item_means(allr, "item_id", "rating").join(top, "item_id", "left_semi")
    return m.select("item_id", F.col("n_ratings").cast("long"), rnd("item_mean", 6).alias("item_mean"))

