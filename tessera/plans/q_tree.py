"""Tree queries: binary features of lineitem, label = (l_returnflag = 'R')."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import tree as tr
from ..operators.prepare import split_label
from .common import tbl
from .registry import query

BIN = {
    "open": ("l_linestatus = 'O'", lambda: F.col("l_linestatus") == "O"),
    "big_discount": ("l_discount >= 0.05", lambda: F.col("l_discount") >= 0.05),
    "high_tax": ("l_tax >= 0.04", lambda: F.col("l_tax") >= 0.04),
    "large_qty": ("l_quantity >= 25", lambda: F.col("l_quantity") >= 25),
    "pricey": ("l_extendedprice >= 50000", lambda: F.col("l_extendedprice") >= 50000),
}
FEATS = list(BIN)
DEPTH = 3


def binary_frame(spark, sf):
    li = tbl(spark, sf, "lineitem")
    return li.select(*[F.when(c(), 1).otherwise(0).alias(n) for n, (_, c) in BIN.items()],
                     F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"))


def _h(p: str) -> str:
    return f"(CASE WHEN {p} <= 0 OR {p} >= 1 THEN 0.0 ELSE -({p}) * log2({p}) - (1 - ({p})) * log2(1 - ({p})) END)"


def _gain_sql(j: int) -> str:
    left = f"(CASE WHEN l{j} = 0 THEN 0.0 ELSE l{j} / n * {_h(f'l1_{j} / l{j}')} END)"
    right = f"(CASE WHEN n - l{j} = 0 THEN 0.0 ELSE (n - l{j}) / n * {_h(f'(n1 - l1_{j}) / (n - l{j})')} END)"
    return f"({_h('n1 / n')} - ({left} + {right}))"


def _best_sql(k: int) -> str:
    conds = []
    for j in range(k):
        c = [f"g{j} > 0"] + [f"g{j} > g{i}" for i in range(j)] + [f"g{j} >= g{i}" for i in range(j + 1, k)]
        conds.append(f"WHEN {' AND '.join(c)} THEN {j}")
    return f"CASE {' '.join(conds)} ELSE -1 END"


def _tree_sql() -> str:
    k = len(FEATS)
    fsel = ", ".join(f"CASE WHEN {sql} THEN 1 ELSE 0 END AS {n}" for n, (sql, _) in BIN.items())
    parts = [f"r0 AS (SELECT 1::BIGINT AS node, {fsel}, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y "
             f"FROM lineitem)"]
    outs = []
    for d in range(DEPTH + 1):
        sums = ", ".join(f"sum({f}) AS l{j}, sum({f} * y) AS l1_{j}" for j, f in enumerate(FEATS))
        parts.append(f"s{d} AS (SELECT node, count(*) AS n, sum(y) AS n1, {sums} FROM r{d} GROUP BY node)")
        if d == DEPTH:
            outs.append(f"SELECT node, {d} AS depth, -1 AS feature, n, n1, NULL::DOUBLE AS gain FROM s{d}")
            break
        gains = ", ".join(f"{_gain_sql(j)} AS g{j}" for j in range(k))
        parts.append(f"g{d} AS (SELECT *, {gains} FROM s{d})")
        gsel = " ".join(f"WHEN {j} THEN g{j}" for j in range(k))
        parts.append(f"b{d} AS (SELECT *, {_best_sql(k)} AS best FROM g{d})")
        outs.append(f"SELECT node, {d} AS depth, best AS feature, n, n1, CASE best {gsel} END AS gain FROM b{d}")
        fval = "CASE b.best " + " ".join(f"WHEN {j} THEN r.{f}" for j, f in enumerate(FEATS)) + " END"
        parts.append(f"r{d + 1} AS (SELECT 2 * r.node + CASE WHEN {fval} = 1 THEN 0 ELSE 1 END AS node, "
                     f"{', '.join('r.' + f for f in FEATS)}, r.y FROM r{d} r JOIN b{d} b ON r.node = b.node "
                     f"WHERE b.best >= 0)")
    parts.append("u AS (" + " UNION ALL ".join(outs) + ")")
    return ("WITH " + ",\n".join(parts) + "\nSELECT CAST(node AS BIGINT) AS node_id, CAST(depth AS BIGINT) AS depth, "
            "CAST(feature AS BIGINT) AS feature, CAST(n AS BIGINT) AS n, CAST(n1 AS BIGINT) AS n_pos, "
            "round(gain, 10) AS gain FROM u")


@query("decision_tree_levelwise", _tree_sql())
def decision_tree_levelwise(spark, sf):
    """D1 routing, D2/D3 gains from one per-level aggregate, D4 best split, D5 level-wise tree to depth 3."""
    t = tr.build_tree(binary_frame(spark, sf), FEATS, "y", DEPTH)
    return t.withColumn("gain", F.round("gain", 10))


ROOT_SQL = ("WITH r AS (SELECT " + ", ".join(f"CASE WHEN {sql} THEN 1 ELSE 0 END AS {n}" for n, (sql, _) in BIN.items())
            + ", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem), s AS (SELECT count(*) AS n, "
            "sum(y) AS n1, " + ", ".join(f"sum({f}) AS l{j}, sum({f} * y) AS l1_{j}" for j, f in enumerate(FEATS))
            + " FROM r)\n" + " UNION ALL ".join(
                f"SELECT '{f}' AS feature, round({_gain_sql(j)}, 10) AS gain, round({_h('n1 / n')}, 10) AS node_entropy "
                f"FROM s" for j, f in enumerate(FEATS)))


@query("information_gain_root", ROOT_SQL)
def information_gain_root(spark, sf):
    """D3 at the root: information gain of each binary feature and the node entropy."""
    data = binary_frame(spark, sf)
    gains = tr.root_gains(data, FEATS, "y")
    r = data.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("n1")).first()
    h = tr.entropy(r["n1"] / r["n"])
    return spark.createDataFrame([(f, round(g, 10), round(h, 10)) for f, g in zip(FEATS, gains)],
                                 "feature string, gain double, node_entropy double")


BOOST_ROUNDS, BOOST_STEP, BOOST_DEPTH, BOOST_PATIENCE = 6, 0.5, 2, 6
SPLIT_ID = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"


def _boost_sql() -> str:
    """Rounds unrolled over the table of feature patterns; every round's tree has two levels of splits."""
    k = len(FEATS)
    feats = ", ".join(FEATS)
    parts = ["r AS (SELECT " + ", ".join(f"CASE WHEN {sql} THEN 1 ELSE 0 END AS {n}" for n, (sql, _) in BIN.items())
             + f", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, (('0x' || substr(md5({SPLIT_ID}), 1, 8))::BIGINT) % 100 < 80 AS t "
             "FROM lineitem)",
             f"s0 AS MATERIALIZED (SELECT {feats}, 1.0 * count(*) FILTER (t) AS n, 1.0 * count(*) FILTER (t AND y = 1) AS n1, "
             f"1.0 * count(*) FILTER (NOT t) AS vn, 1.0 * count(*) FILTER (NOT t AND y = 1) AS vn1, 0.0::DOUBLE AS score FROM r GROUP BY {feats})"]
    outs = []
    for r in range(1, BOOST_ROUNDS + 1):
        parts.append(f"a{r}_0 AS MATERIALIZED (SELECT *, 1 AS node, n / (1 + exp(-score)) - n1 AS g, "
                     f"n / (1 + exp(-score)) * (1 - 1 / (1 + exp(-score))) AS h FROM s{r - 1})")
        for d in range(BOOST_DEPTH):
            sums = ", ".join(f"sum(g * {f}) AS gl{j}, sum(h * {f}) AS hl{j}" for j, f in enumerate(FEATS))
            gains = ", ".join(f"CASE WHEN hl{j} >= 1 AND hh - hl{j} >= 1 THEN 0.5 * (gl{j} * gl{j} / (hl{j} + 1) + (gg - gl{j}) * (gg - gl{j}) "
                              f"/ (hh - hl{j} + 1) - gg * gg / (hh + 1)) ELSE 0 END AS g{j}" for j in range(k))
            parts.append(f"b{r}_{d} AS MATERIALIZED (SELECT *, {_best_sql(k)} AS best FROM (SELECT *, {gains} FROM (SELECT node, sum(g) AS gg, "
                         f"sum(h) AS hh, {sums} FROM a{r}_{d} GROUP BY node)))")
            on = "CASE best " + " ".join(f"WHEN {j} THEN {f}" for j, f in enumerate(FEATS)) + " END"
            # a node that does not split keeps its rows as its own left child: its sums, and so its leaf, stay the same
            parts.append(f"a{r}_{d + 1} AS MATERIALIZED (SELECT a.* EXCLUDE (node), 2 * a.node + CASE WHEN best < 0 OR {on} = 1 THEN 0 ELSE 1 END AS node "
                         f"FROM a{r}_{d} a JOIN b{r}_{d} b ON a.node = b.node)")
        parts.append(f"v{r} AS (SELECT node, -{BOOST_STEP!r} * sum(g) / (sum(h) + 1) AS value FROM a{r}_{BOOST_DEPTH} GROUP BY node)")
        parts.append(f"s{r} AS MATERIALIZED (SELECT {feats}, n, n1, vn, vn1, score + value AS score FROM a{r}_{BOOST_DEPTH} a JOIN v{r} v ON a.node = v.node)")
        loss = lambda n, p: f"sum({p} * ln(1 + exp(-score)) + ({n} - {p}) * ln(1 + exp(score))) / sum({n})"
        outs.append(f"SELECT {r}::BIGINT AS round, {loss('n', 'n1')} AS tr, {loss('vn', 'vn1')} AS va FROM s{r}")
    return ("WITH " + ",\n".join(parts) + ",\nu AS (" + " UNION ALL ".join(outs) + ") SELECT round, round(tr, 9) AS train_loss, "
            "round(va, 9) AS valid_loss, CAST(round = (SELECT arg_min(round, va) FROM u) AS BIGINT) AS is_best FROM u")


@query("boosted_rounds", _boost_sql())
def boosted_rounds(spark, sf):
    """Six rounds of logistic gradient boosting on binary features, train and validation loss of each, best round flagged."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    li = tbl(spark, sf, "lineitem")
    d = li.select(*[F.when(c(), 1).otherwise(0).alias(n) for n, (_, c) in BIN.items()],
                  F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
                  split_label(key, [("train", 0.8), ("test", 0.2)]).alias("split"))
    history, _ = tr.boost(d.where("split = 'train'"), d.where("split = 'test'"), FEATS, "y", BOOST_ROUNDS, BOOST_STEP, BOOST_DEPTH,
                          patience=BOOST_PATIENCE)
    best = min(history, key=lambda h: (h[2], h[0]))[0]
    rows = [(r, round(a, 9), round(b, 9), int(r == best)) for r, a, b in history]
    return spark.createDataFrame(rows, "round long, train_loss double, valid_loss double, is_best long")


NUM = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def num_frame(spark, sf):
    li = tbl(spark, sf, "lineitem")
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return li.select(*NUM, F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
                     split_label(key, [("train", 0.8), ("test", 0.2)]).alias("split"))


@query("ml_tree_ensembles")
def ml_tree_ensembles(spark, sf):
    """D6 decision tree, D7 random forest, D8 boosted trees with a validation set; train/test accuracy."""
    d = num_frame(spark, sf)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    rows = []
    m = tr.decision_tree(train, NUM, "y", max_depth=4, min_instances=10)
    rows.append(("decision_tree", tr.accuracy(m, train, NUM, "y"), tr.accuracy(m, test, NUM, "y")))
    m = tr.random_forest(train, NUM, "y", n_trees=20, max_depth=4)
    rows.append(("random_forest", tr.accuracy(m, train, NUM, "y"), tr.accuracy(m, test, NUM, "y")))
    gb = d.withColumn("is_val", F.col("split") == "test")
    m = tr.boosted_trees(gb, NUM, "y", max_iter=20, step=0.1, validation_col="is_val")
    rows.append(("boosted_trees", tr.accuracy(m, train, NUM, "y"), tr.accuracy(m, test, NUM, "y")))
    return spark.createDataFrame([(n, round(a, 6), round(b, 6)) for n, a, b in rows],
                                 "model string, train_accuracy double, test_accuracy double")


GRID_DEPTHS, GRID_SPLITS = (1, 2, 3), (2, 400, 1500)


def _grid_sql() -> str:
    k = len(FEATS)
    parts = ["r AS (SELECT " + ", ".join(f"CASE WHEN {sql} THEN 1 ELSE 0 END AS {n}" for n, (sql, _) in BIN.items())
             + f", CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN ('0x' || substr(md5({SPLIT_ID}), 1, 8))::BIGINT % 100 < 80 "
             "THEN 1 ELSE 0 END AS t FROM lineitem)",
             "tot AS (SELECT sum(t) AS n, sum(1 - t) AS vn FROM r)"]
    outs = []
    for ms in GRID_SPLITS:
        parts.append(f"r{ms}_0 AS (SELECT 1::BIGINT AS node, * FROM r)")
        for d in range(max(GRID_DEPTHS) + 1):
            sums = ", ".join(f"sum(t * {f}) AS l{j}, sum(t * {f} * y) AS l1_{j}" for j, f in enumerate(FEATS))
            parts.append(f"s{ms}_{d} AS (SELECT node, sum(t) AS n, sum(t * y) AS n1, sum(1 - t) AS vn, sum((1 - t) * y) AS vn1, {sums} FROM r{ms}_{d} GROUP BY node)")
            gains = ", ".join(f"CASE WHEN n >= {ms} THEN {_gain_sql(j)} ELSE 0 END AS g{j}" for j in range(k))
            parts.append(f"b{ms}_{d} AS MATERIALIZED (SELECT *, {_best_sql(k)} AS best, CASE WHEN 2 * n1 > n THEN n1 ELSE n - n1 END AS a, "
                         f"CASE WHEN 2 * n1 > n THEN vn1 ELSE vn - vn1 END AS b FROM (SELECT *, {gains} FROM s{ms}_{d}))")
            if d < max(GRID_DEPTHS):
                fval = "CASE b.best " + " ".join(f"WHEN {j} THEN r.{f}" for j, f in enumerate(FEATS)) + " END"
                parts.append(f"r{ms}_{d + 1} AS (SELECT 2 * r.node + CASE WHEN {fval} = 1 THEN 0 ELSE 1 END AS node, r.* EXCLUDE (node) "
                             f"FROM r{ms}_{d} r JOIN b{ms}_{d} b ON r.node = b.node WHERE b.best >= 0)")
        for depth in GRID_DEPTHS:
            met = " UNION ALL ".join([f"SELECT a, b FROM b{ms}_{d} WHERE best < 0" for d in range(depth)] + [f"SELECT a, b FROM b{ms}_{depth}"])
            outs.append(f"SELECT {depth}::BIGINT AS max_depth, {ms}::BIGINT AS min_split, round(sum(a) / any_value(n), 9) AS train_accuracy, "
                        f"round(sum(b) / any_value(vn), 9) AS test_accuracy FROM ({met}), tot")
    return "WITH " + ",\n".join(parts) + "\n" + " UNION ALL ".join(outs)


@query("tree_depth_split_grid", _grid_sql())
def tree_depth_split_grid(spark, sf):
    """E11 + D6: depth x least rows to split for the level-wise tree on binary features; train and test accuracy."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    d = tbl(spark, sf, "lineitem").select(*[F.when(c(), 1).otherwise(0).alias(n) for n, (_, c) in BIN.items()],
                                          F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("y"),
                                          split_label(key, [("train", 0.8), ("test", 0.2)]).alias("split"))
    rows = tr.depth_split_grid(d.where("split = 'train'"), d.where("split = 'test'"), FEATS, "y", GRID_DEPTHS, GRID_SPLITS)
    return spark.createDataFrame([(a, b, round(c, 9), round(e, 9)) for a, b, c, e in rows],
                                 "max_depth long, min_split long, train_accuracy double, test_accuracy double")


@query("forest_param_sweep")
def forest_param_sweep(spark, sf):
    """E11 + D7: forest size x depth x least child rows for the pyspark.ml forest; train and test accuracy per setting."""
    d = num_frame(spark, sf)
    rows = tr.forest_sweep(d.where("split = 'train'"), d.where("split = 'test'"), NUM, "y", (5, 20), (2, 4), (1, 50))
    return spark.createDataFrame([(a, b, c, round(e, 6), round(f, 6)) for a, b, c, e, f in rows],
                                 "n_trees long, max_depth long, min_instances long, train_accuracy double, test_accuracy double")


@query("tree_param_sweep")
def tree_param_sweep(spark, sf):
    """Max depth x min node size grid (ParamGridBuilder) for the pyspark.ml tree, fitted concurrently;
    train and test accuracy per setting."""
    d = num_frame(spark, sf)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    rows = [(a, b, round(c, 6), round(e, 6)) for a, b, c, e in tr.param_sweep(train, test, NUM, "y", (1, 2, 4, 8), (1, 50))]
    schema = T.StructType([T.StructField("max_depth", T.LongType()), T.StructField("min_instances", T.LongType()),
                           T.StructField("train_accuracy", T.DoubleType()), T.StructField("test_accuracy", T.DoubleType())])
    return spark.createDataFrame(rows, schema)
