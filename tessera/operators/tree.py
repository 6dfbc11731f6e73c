"""Decision trees on binary features.

Rows with the same features differ only in their labels, so they are first
grouped into patterns with counts; a hot pattern is one row per task.  The builder
then works level by level on the patterns.  A level's statistics are in long form, one
row per (node, feature), so neither plan nor driver grows with the number of
features; the best split of a node is the first row of a window, and patterns
are routed to children by a join with the (written) splits of the levels
above, so that no copy of the rows is kept per level.

Boosting (D8) runs such a tree per round over a running score column, with
the validation error of every round and patience.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def entropy(p: float) -> float:
    """F11 on the driver: binary entropy, 0 at p in {0, 1}."""
    if p <= 0.0 or p >= 1.0:
        return 0.0
    return -p * math.log2(p) - (1 - p) * math.log2(1 - p)


def information_gain(n: int, n1: int, nl: int, nl1: int) -> float:
    """D2/D3 from counts: H(node) - (wl H(left) + wr H(right)); an empty
    child weighs 0."""
    if n == 0:
        return 0.0
    nr, nr1 = n - nl, n1 - nl1
    hl = entropy(nl1 / nl) if nl else 0.0
    hr = entropy(nr1 / nr) if nr else 0.0
    return entropy(n1 / n) - (nl / n * hl + nr / n * hr)


def best_split(gains: Sequence[float]) -> int:
    """Strictly greater than the best so far (starting at 0), so the
    lowest feature index wins ties and -1 means no positive gain."""
    best, best_gain = -1, 0.0
    for j, g in enumerate(gains):
        if g > best_gain:
            best, best_gain = j, g
    return best


def patterns(df: DataFrame, features: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """One row per distinct combination of the features, as array ``f`` of 0 and 1, with sums over its rows."""
    f = F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in features])
    rows = df.select(f.alias("f"), *[c.cast("double").alias(n) for n, c in sums.items()])
    return rows.groupBy("f").agg(*[F.sum(n).alias(n) for n in sums])


def _entropy_col(part: Column, whole: Column) -> Column:
    p = part / whole
    return F.when((part <= 0) | (part >= whole), F.lit(0.0)).otherwise(-p * F.log2(p) - (1 - p) * F.log2(1 - p))


def entropy_gain(left: dict[str, Column], all_: dict[str, Column]) -> Column:
    """Information gain from the sums ``n`` and ``n1`` of the left child and the node; an empty child weighs 0."""
    n, n1, nl, nl1 = all_["n"], all_["n1"], left["n"], left["n1"]

    def child(part: Column, pos: Column) -> Column:
        return F.when(part > 0, part / n * _entropy_col(pos, part)).otherwise(F.lit(0.0))

    return _entropy_col(n1, n) - (child(nl, nl1) + child(n - nl, n1 - nl1))


def level_stats(rows: DataFrame, values: Sequence[str], gain: Callable) -> DataFrame:
    """(node_id, feature, t_<value>, gain): per node of ``rows`` (node_id, f, values) and feature that some row has,
    and with feature -1 and no gain the node itself.  One aggregate."""
    long = rows.select("node_id", *values, F.posexplode(F.concat(F.array(F.lit(1)), "f")).alias("at", "on")).where("on = 1")
    sums = long.groupBy("node_id", (F.col("at") - 1).alias("feature")).agg(*[F.sum(v).alias(f"l_{v}") for v in values])
    w = Window.partitionBy("node_id")
    whole = sums.withColumns({f"t_{v}": F.max(F.when(F.col("feature") < 0, F.col(f"l_{v}"))).over(w) for v in values})
    g = gain({v: F.col(f"l_{v}") for v in values}, {v: F.col(f"t_{v}") for v in values})
    return whole.select("node_id", "feature", *[f"t_{v}" for v in values], F.when(F.col("feature") >= 0, g).alias("gain"))


def best_splits(stats: DataFrame, values: Sequence[str]) -> DataFrame:
    """Per node the feature with the greatest positive gain (the lowest on ties), else -1 and no gain."""
    w = Window.partitionBy("node_id").orderBy(F.when(F.col("gain") > 0, F.col("gain")).desc_nulls_last(),
                                              F.when(F.col("gain") > 0, F.col("feature")))
    first = stats.withColumn("r", F.row_number().over(w)).where("r = 1")
    good = F.col("gain") > 0
    return first.select("node_id", F.when(good, F.col("feature")).otherwise(F.lit(-1)).cast("long").alias("feature"),
                        *[f"t_{v}" for v in values], F.when(good, F.col("gain")).alias("gain"))


def route(rows: DataFrame, splits: DataFrame) -> DataFrame:
    """Rows of a split node move to 2 * node (feature 1, left) or 2 * node + 1 (right); others are left out."""
    cuts = splits.where("feature >= 0").select("node_id", F.col("feature").alias("cut"))
    child = F.col("node_id") * 2 + F.when(F.element_at("f", F.col("cut").cast("int") + 1) == 1, 0).otherwise(1)
    return rows.join(cuts, "node_id").withColumn("node_id", child).drop("cut")


def grow(rows: DataFrame, values: Sequence[str], max_depth: int, gain: Callable) -> list[DataFrame]:
    """The nodes of each depth (node_id, depth, feature, t_<value>, gain), written.  ``rows``: f and values."""
    levels: list[DataFrame] = []
    here = rows.withColumn("node_id", F.lit(1).cast("long"))
    for depth in range(max_depth + 1):
        stats = level_stats(here, values, gain)
        if depth == max_depth:
            nodes = stats.where("feature < 0").withColumns({"gain": F.lit(None).cast("double"), "feature": F.lit(-1).cast("long")})
        else:
            nodes = best_splits(stats, values)
        levels.append(cut_lineage(nodes.withColumn("depth", F.lit(depth).cast("long"))))
        if depth == max_depth or not levels[-1].where("feature >= 0").limit(1).count():
            break
        here = route(here, levels[-1])
    return levels


def build_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int) -> DataFrame:
    """Level-wise tree to ``max_depth``.  Returns (node_id, depth, feature, n, n_pos, gain) for every node;
    feature = -1 marks a leaf.  A node without positive gain becomes a leaf (the reference would split it on
    its last column)."""
    rows = cut_lineage(patterns(df, features, {"n": F.lit(1), "n1": F.col(label)}))
    levels = grow(rows, ["n", "n1"], max_depth, entropy_gain)
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out.select("node_id", "depth", "feature", F.col("t_n").cast("long").alias("n"), F.col("t_n1").cast("long").alias("n_pos"), "gain")


def root_gains(df: DataFrame, features: Sequence[str], label: str) -> list[float]:
    """D3 for the root node: information gain of every feature."""
    rows = patterns(df, features, {"n": F.lit(1), "n1": F.col(label)}).withColumn("node_id", F.lit(1))
    got = {r["feature"]: r["gain"] for r in level_stats(rows, ["n", "n1"], entropy_gain).where("feature >= 0").collect()}
    return [float(got.get(j, 0.0)) for j in range(len(features))]


def depth_split_grid(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, depths: Sequence[int],
                     min_splits: Sequence[int]) -> list[tuple[int, int, float, float]]:
    """(max_depth, min_split, train accuracy, test accuracy) of the level-wise tree.

    A node of fewer than ``min_split`` train rows is not split.  One tree is grown per ``min_split``: its nodes carry the
    counts of both tables, so the accuracy at every smaller depth is a sum over its levels (a node predicts 1 if
    more than half of its train rows are 1), and no row is scored."""
    t, y = F.col("_t"), F.col("_y")
    both = train.select(*features, F.lit(1).alias("_t"), F.col(label).cast("double").alias("_y")).unionByName(
        test.select(*features, F.lit(0).alias("_t"), F.col(label).cast("double").alias("_y")))
    values = ["n", "n1", "vn", "vn1"]
    rows = cut_lineage(patterns(both, features, {"n": t, "n1": t * y, "vn": 1 - t, "vn1": (1 - t) * y}))
    out = []
    for least in min_splits:
        levels = grow(rows, values, max(depths), lambda left, all_: F.when(all_["n"] >= least, entropy_gain(left, all_)).otherwise(F.lit(0.0)))
        yes = 2 * F.col("t_n1") > F.col("t_n")
        sums = []
        for level in levels:
            right = [F.sum(F.when(yes, F.col(f"t_{v}n1")).otherwise(F.col(f"t_{v}n") - F.col(f"t_{v}n1"))) for v in ("", "v")]
            got = level.groupBy((F.col("feature") < 0).alias("leaf")).agg(right[0].alias("a"), right[1].alias("b"), F.sum("t_n").alias("n"), F.sum("t_vn").alias("vn")).collect()
            sums.append({r["leaf"]: r for r in got})
        total = [sum(r[c] for r in sums[0].values()) for c in ("n", "vn")]
        for depth in depths:
            met = [r for d, level in enumerate(sums) for leaf, r in level.items() if d == depth or (d < depth and leaf)]
            out.append((depth, least, sum(r["a"] for r in met) / total[0], sum(r["b"] for r in met) / total[1]))
    return out


# --- D8: boosting with a best round ------------------------------------------

def boost(train: DataFrame, valid: DataFrame, features: Sequence[str], label: str, rounds: int = 500, step: float = 0.1,
          max_depth: int = 6, lam: float = 1.0, min_child: float = 1.0, patience: int = 50):
    """Logistic gradient boosting on binary features with early stopping.

    Each round grows a tree on the gradients g = p - y and hessians h = p (1 - p) of the running score, a leaf adding
    -step G / (H + lam); a split's gain is (GL^2 / (HL + lam) + GR^2 / (HR + lam) - G^2 / (H + lam)) / 2, and both
    children need hessians of ``min_child``.  Rounds end when the validation log-loss has not improved for ``patience`` of
    them.  Returns (history, trees): history rows (round, train_loss, valid_loss), the best round being the first
    with the least valid_loss; trees (round, node_id, feature, value), value null but for leaves."""
    y = F.col(label).cast("double")
    both = train.select(*features, F.lit(1).alias("_t"), y.alias("_y")).unionByName(valid.select(*features, F.lit(0).alias("_t"), y.alias("_y")))
    t, yy = F.col("_t"), F.col("_y")
    state = patterns(both, features, {"n": t, "n1": t * yy, "vn": 1 - t, "vn1": (1 - t) * yy})
    state = cut_lineage(state.withColumn("score", F.lit(0.0)))

    def gain(left: dict, all_: dict) -> Column:
        gl, hl, g, h = left["g"], left["h"], all_["g"], all_["h"]
        value = 0.5 * (gl * gl / (hl + lam) + (g - gl) * (g - gl) / (h - hl + lam) - g * g / (h + lam))
        return F.when((hl >= min_child) & (h - hl >= min_child), value).otherwise(F.lit(0.0))

    def loss(n: str, pos: str) -> Column:
        s = F.col("score")  # -log p = log(1 + e^-s) for a positive label, log(1 + e^s) for another
        each = lambda z: F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
        return F.sum(F.col(pos) * each(-s) + (F.col(n) - F.col(pos)) * each(s)) / F.sum(n)

    history, trees, best, best_round = [], None, math.inf, 0
    for r in range(1, rounds + 1):
        p = 1.0 / (1.0 + F.exp(-F.col("score")))
        rows = state.withColumns({"g": F.col("n") * p - F.col("n1"), "h": F.col("n") * p * (1 - p)})
        levels = grow(rows.select("f", "g", "h"), ["g", "h"], max_depth, gain)
        here, moved = state.withColumn("node_id", F.lit(1).cast("long")), None
        value = F.lit(-step) * F.col("t_g") / (F.col("t_h") + lam)
        nodes = None
        for level in levels:
            leaves = level.where("feature < 0").select("node_id", value.alias("value"))
            part = here.join(leaves, "node_id").withColumn("score", F.col("score") + F.col("value")).select(*state.columns)
            moved = part if moved is None else moved.unionByName(part)
            here = route(here, level)
            tree = level.select(F.lit(r).alias("round"), "node_id", "feature", F.when(F.col("feature") < 0, value).alias("value"))
            nodes = tree if nodes is None else nodes.unionByName(tree)
        trees = nodes if trees is None else trees.unionByName(nodes)
        state = cut_lineage(moved)
        row = state.agg(loss("n", "n1").alias("train"), loss("vn", "vn1").alias("valid")).first()
        history.append((r, row["train"], row["valid"]))
        if row["valid"] is not None and row["valid"] < best:
            best, best_round = row["valid"], r
        if r - best_round >= patience:
            break
    return history, trees


def boost_scores(df: DataFrame, features: Sequence[str], trees: DataFrame, best_round: int, max_depth: int = 6,
                 out: str = "score") -> DataFrame:
    """Add the sum of the leaf values that the first ``best_round`` trees give a row (its log-odds)."""
    f = F.array(*[F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in features])
    kinds = df.select(f.alias("f")).distinct()
    use = trees.where(F.col("round") <= best_round)
    at = kinds.select("f", F.explode(F.sequence(F.lit(1), F.lit(best_round))).alias("round")).withColumn("node_id", F.lit(1).cast("long"))
    done = None
    for _ in range(max_depth + 1):
        met = at.join(use, ["round", "node_id"])
        leaf = met.where("feature < 0").select("f", "value")
        done = leaf if done is None else done.unionByName(leaf)
        child = F.col("node_id") * 2 + F.when(F.element_at("f", F.col("feature").cast("int") + 1) == 1, 0).otherwise(1)
        at = met.where("feature >= 0").select("f", "round", child.alias("node_id"))
    scores = done.groupBy("f").agg(F.sum("value").alias(out))
    return df.withColumn("_f", f).join(scores.withColumnRenamed("f", "_f"), "_f").drop("_f")


# --- pyspark.ml wrappers (D6-D8, E11) ---------------------------------------

def _assemble(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(
        df.select(*features, F.col(label).cast("double").alias(label), *[c for c in df.columns
                                                                         if c not in features and c != label]))


def decision_tree(df: DataFrame, features: Sequence[str], label: str, max_depth: int = 5,
                  min_instances: int = 1, seed: int = 55):
    """Pyspark.ml tree; minInstancesPerNode bounds child size, which only
    approximates a minimum parent size."""
    from pyspark.ml.classification import DecisionTreeClassifier
    return DecisionTreeClassifier(featuresCol="_features", labelCol=label, maxDepth=max_depth,
                                  minInstancesPerNode=min_instances, seed=seed).fit(_assemble(df, features, label))


def random_forest(df: DataFrame, features: Sequence[str], label: str, n_trees: int = 100, max_depth: int = 5,
                  seed: int = 55):
    """D7."""
    from pyspark.ml.classification import RandomForestClassifier
    return RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=n_trees, maxDepth=max_depth,
                                  seed=seed).fit(_assemble(df, features, label))


def boosted_trees(df: DataFrame, features: Sequence[str], label: str, max_iter: int = 500, step: float = 0.1,
                  validation_col: str | None = None, seed: int = 55):
    """Gradient boosting; with a validation indicator column training
    stops when validation error stops improving (validationTol)."""
    from pyspark.ml.classification import GBTClassifier
    kw = {"validationIndicatorCol": validation_col} if validation_col else {}
    return GBTClassifier(featuresCol="_features", labelCol=label, maxIter=max_iter, stepSize=step, seed=seed,
                         **kw).fit(_assemble(df, features, label))


#: Bins of a feature, and rows that its candidate splits are taken from (all rows if there are no more), as in pyspark.ml.
MAX_BINS = 32
SPLIT_ROWS = 10_000


def split_rows(train: DataFrame, features: Sequence[str], total: int, seed: int) -> list:
    """The rows that pyspark.ml looks at for its candidate splits with this seed: all, or about SPLIT_ROWS sampled ones."""
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in features])
    if total <= SPLIT_ROWS:
        return rows.collect()
    spark = train.sparkSession
    drawn = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
    some = rows._jdf.rdd().sample(False, SPLIT_ROWS / total, drawn)
    return DataFrame(spark._jsparkSession.createDataFrame(some.toJavaRDD(), rows._jdf.schema()), spark).collect()


def candidate_splits(values: Sequence[float], total: int) -> list[float]:
    """The thresholds that pyspark.ml tries for a feature of ``total`` rows with these values in ``split_rows``: between
    all values if they are few, else where the count of values comes closest to each MAX_BINS-th part.  As
    there, zeros are not counted but make up the rows expected."""
    counts = Counter(v for v in values if v is not None and v != 0)
    if not counts:
        return []
    met, expected, n_splits = sum(counts.values()), min(SPLIT_ROWS, total), min(MAX_BINS, total) - 1
    if expected > met:
        counts[0.0] = expected - met
    found = sorted(counts.items())
    between = [(x + y) / 2.0 for (x, _), (y, _) in zip(found, found[1:])]
    if len(between) <= n_splits:
        return between
    out, stride, so_far = [], expected / (n_splits + 1), found[0][1]
    target = stride
    for (_, n), cut in zip(found[1:], between):
        before, so_far = so_far, so_far + n
        if abs(before - target) < abs(so_far - target):
            out.append(cut)
            target += stride
    return out


def binned_patterns(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, splits: Sequence[Sequence[float]]) -> DataFrame:
    """One row per combination of the features' bins (1, 2, ..., a value at a split in the lower bin) and label, with
    the train rows ``n`` and test rows ``vn`` that have it.  A null or NaN feature is an error, as in VectorAssembler."""
    from pyspark.ml.feature import Bucketizer
    both = train.select(*features, F.col(label), F.lit(1).alias("_t")).unionByName(test.select(*features, F.col(label), F.lit(0).alias("_t")))
    # a bucket holds its lower bound, a bin its upper one: so the negatives are put into buckets
    x = [F.col(c).cast("double") for c in features]
    rows = both.select(*[F.when(v.isNull() | F.isnan(v), F.raise_error(F.lit(f"null or NaN in {c}")).cast("double")).otherwise(0.0 - v).alias(f"_x{i}")
                         for i, (c, v) in enumerate(zip(features, x, strict=True))], F.col(label).cast("double").alias(label), "_t")
    cut = [i for i, cuts in enumerate(splits) if cuts]
    if cut:
        rows = Bucketizer(inputCols=[f"_x{i}" for i in cut], outputCols=[f"_b{i}" for i in cut],
                          splitsArray=[[-math.inf, *[0.0 - t for t in reversed(splits[i])], math.inf] for i in cut]).transform(rows)
    # a feature without splits has one bin; its values are still looked at for nulls
    bins = [F.lit(len(cuts) + 1) - F.col(f"_b{i}").cast("int") if cuts else F.col(f"_x{i}").isNotNull().cast("int") for i, cuts in enumerate(splits)]
    rows = rows.select(*[b.alias(c) for b, c in zip(bins, features, strict=True)], label, "_t")
    return rows.groupBy(*features, label).agg(F.sum("_t").cast("double").alias("n"), F.sum(1 - F.col("_t")).cast("double").alias("vn"))


def param_sweep(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                max_depths: Sequence[int], min_instances: Sequence[int], parallelism: int = 4) -> list[tuple]:
    """A pyspark.ml parameter grid over tree depth and minimum node size,
    fitted concurrently (each setting's jobs are submitted from its own
    thread); returns (max_depth, min_instances, train_accuracy, test_accuracy).

    A tree sees a row only by the bins of its features, so every setting is fitted and scored on the distinct
    combinations of bins and label, weighted by their rows: at most MAX_BINS to the number of features for a label,
    however many rows there are.  The least rows of a child are its least weight there."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.tuning import ParamGridBuilder
    total = train.count()
    few = split_rows(train, features, total, seed=55)
    splits = [candidate_splits([r[c] for r in few], total) for c in features]
    rows = _assemble(cut_lineage(binned_patterns(train, test, features, label, splits)), features, label).cache()
    met = rows.where("n > 0")
    # this many bins allowed, pyspark.ml looks at all rows for its splits: one between each two bins
    bins = max(MAX_BINS, math.isqrt(met.count()) + 1)
    est = DecisionTreeClassifier(featuresCol="_features", labelCol=label, weightCol="n", maxBins=bins, seed=55)
    grid = ParamGridBuilder().addGrid(est.maxDepth, list(max_depths)).addGrid(
        est.minInstancesPerNode, list(min_instances)).build()

    def fit_one(pm):
        depth, least = int(pm[est.maxDepth]), int(pm[est.minInstancesPerNode])
        # fewer than twice the least rows: no split leaves both children enough
        can = total >= 2 * least
        model = est.copy({est.maxDepth: depth if can else 0, est.minInstancesPerNode: 1,
                          est.minWeightFractionPerNode: (least - 0.5) / total if can else 0.0}).fit(met)
        hit = F.col("prediction") == F.col(label)
        got = model.transform(rows).agg(*[(F.sum(F.when(hit, F.col(w)).otherwise(0.0)) / F.sum(w)).alias(w) for w in ("n", "vn")]).first()
        return depth, least, float(got["n"]), float(got["vn"])

    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            return list(pool.map(fit_one, grid))
    finally:
        rows.unpersist()


def forest_sweep(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, sizes: Sequence[int],
                 max_depths: Sequence[int], min_instances: Sequence[int]) -> list[tuple]:
    """Grid over forest size, depth and least rows of a child; (n_trees, max_depth, min_instances, train, test accuracy)."""
    from pyspark.ml.classification import RandomForestClassifier
    tr, te = _assemble(train, features, label).cache(), _assemble(test, features, label).cache()
    out = []
    for n in sizes:
        for depth in max_depths:
            for least in min_instances:
                model = RandomForestClassifier(featuresCol="_features", labelCol=label, numTrees=n, maxDepth=depth,
                                               minInstancesPerNode=least, seed=55).fit(tr)
                acc = [float(model.transform(d).agg(F.avg((F.col("prediction") == F.col(label)).cast("double"))).first()[0]) for d in (tr, te)]
                out.append((n, depth, least, *acc))
    tr.unpersist()
    te.unpersist()
    return out


def accuracy(model, df: DataFrame, features: Sequence[str], label: str) -> float:
    pred = model.transform(_assemble(df, features, label))
    return float(pred.agg(F.avg(F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0))).first()[0])
