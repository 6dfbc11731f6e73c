"""Feature preparation.

Fitting a scaler is one aggregate; applying it is a projection with the
fitted statistics inlined as literals, so scoring new rows never shuffles.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordering import cuts_before, global_position, order_key, order_statistics

# --- T1/T2: z-score with the population standard deviation -----------------


def zscore_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """T1 fit: {col: (mean, population sigma)} in one aggregate job.

    (pyspark.ml's StandardScaler divides by the sample sigma, n-1, which is
    not what the reference computes.)
    """
    exprs = []
    for c in cols:
        exprs += [F.avg(c).alias(f"{c}__mu"), F.stddev_pop(c).alias(f"{c}__sd")]
    row = df.agg(*exprs).first()
    return {c: (float(row[f"{c}__mu"]), float(row[f"{c}__sd"])) for c in cols}


def zscore_transform(df: DataFrame, stats: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """Apply stored (mean, sigma) to any rows (train statistics only)."""
    out = {f"{c}{suffix}": (F.col(c) - F.lit(mu)) / F.lit(sd) for c, (mu, sd) in stats.items()}
    return df.withColumns(out)


def zscore(df: DataFrame, cols: Sequence[str], suffix: str = "") -> tuple[DataFrame, dict]:
    stats = zscore_fit(df, cols)
    return zscore_transform(df, stats, suffix), stats


# --- T3: min-max to [lo, hi] and back ---------------------------------------


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    exprs = []
    for c in cols:
        exprs += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    row = df.agg(*exprs).first()
    return {c: (float(row[f"{c}__lo"]), float(row[f"{c}__hi"])) for c in cols}


def minmax_transform(df: DataFrame, stats: dict, lo: float = -1.0, hi: float = 1.0, suffix: str = "") -> DataFrame:
    out = {}
    for c, (mn, mx) in stats.items():
        span = (mx - mn) or 1.0
        out[f"{c}{suffix}"] = (F.col(c) - F.lit(mn)) / F.lit(span) * F.lit(hi - lo) + F.lit(lo)
    return df.withColumns(out)


def minmax_inverse(col: Column | str, stat: tuple[float, float], lo: float = -1.0, hi: float = 1.0) -> Column:
    mn, mx = stat
    c = F.col(col) if isinstance(col, str) else col
    return (c - F.lit(lo)) / F.lit(hi - lo) * F.lit((mx - mn) or 1.0) + F.lit(mn)


# --- T4/T5 -------------------------------------------------------------------


def range_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """{col: (mean, min, max)} in one job; peak-to-peak (T5) is max-min."""
    exprs = []
    for c in cols:
        exprs += [F.avg(c).alias(f"{c}__mu"), F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
    row = df.agg(*exprs).first()
    return {c: (float(row[f"{c}__mu"]), float(row[f"{c}__lo"]), float(row[f"{c}__hi"])) for c in cols}


def mean_normalize(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """T4: (x - mean) / (max - min)."""
    st = range_stats(df, cols)
    return df.withColumns({f"{c}{suffix}": (F.col(c) - F.lit(mu)) / F.lit((hi - lo) or 1.0)
                           for c, (mu, lo, hi) in st.items()})


def peak_to_peak(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T5 as a one-row table."""
    return df.agg(*[(F.max(c) - F.min(c)).alias(f"{c}_ptp") for c in cols])


# --- T6/T7/T8: polynomial maps ----------------------------------------------


def poly_one(df: DataFrame, col: str, degree: int, prefix: str | None = None) -> DataFrame:
    """X, x^2 .. x^d (no bias column)."""
    p = prefix or f"{col}_p"
    x = F.col(col)
    return df.withColumns({f"{p}{k}": F.pow(x, F.lit(float(k))) for k in range(1, degree + 1)})


def poly_terms(cols: Sequence[str], degree: int) -> list[tuple[str, ...]]:
    """T7/T8 term list in the usual degree-then-lexicographic order (no bias); of two columns that is
    x1^i, x1^(i-1) x2, ..., x2^i for each degree i (27 terms up to 6)."""
    terms = []
    for d in range(1, degree + 1):
        terms += list(itertools.combinations_with_replacement(cols, d))
    return terms


def poly_features(df: DataFrame, cols: Sequence[str], degree: int, prefix: str = "poly") -> tuple[DataFrame, list[str]]:
    """All monomials of degree 1..d of ``cols`` as generated columns."""
    names, exprs = [], {}
    for k, term in enumerate(poly_terms(cols, degree)):
        e = F.lit(1.0)
        for c in term:
            e = e * F.col(c)
        names.append(f"{prefix}{k}")
        exprs[names[-1]] = e
    return df.withColumns(exprs), names


# --- T9/T10/T11: reproducible splits ----------------------------------------


def hash_bucket(key: Column | str, buckets: int = 100) -> Column:
    """Portable bucket of a key: first 32 bits of md5(key as text) mod buckets.

    Independent of partitioning and of row order, so a split is the same on
    every run and in every engine that has md5.
    """
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return (h % F.lit(buckets)).cast("int")


def split_label(key: Column | str, fractions: Sequence[tuple[str, float]]) -> Column:
    """Label each row by cumulative percentage ranges of its bucket,
    e.g. [("train", .6), ("cv", .2), ("test", .2)]."""
    b = hash_bucket(key)
    expr = None
    acc = 0.0
    for name, frac in fractions:
        acc += frac * 100.0
        cond = b < F.lit(round(acc))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(fractions[-1][0]))


def train_test_split(df: DataFrame, key: str, test_size: float) -> tuple[DataFrame, DataFrame]:
    lab = df.withColumn("_split", split_label(key, [("train", 1 - test_size), ("test", test_size)]))
    return (lab.where(F.col("_split") == "train").drop("_split"),
            lab.where(F.col("_split") == "test").drop("_split"))


def _label_by_rank(df: DataFrame, order: list[str], cuts: list[tuple[str, int]], last: str, col: str) -> DataFrame:
    """Label the rows up to rank r in ``order`` by the first (label, r) that reaches them, the rest ``last``.

    The keys at the ranks are order statistics (no full sort); rows that tie in all of ``order`` are told apart by
    their place in the scan, so the counts are exact."""
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [*order, "_tie"]
    keys = order_statistics(rows, order, [r for _, r in cuts])
    reached = sorted((r, -i, name) for i, (name, r) in enumerate(cuts) if r in keys)
    rows = rows.withColumn("_key", order_key(order))
    before = cuts_before("_key", rows.schema["_key"].dataType, [keys[r] for r, _, _ in reached])
    names = []  # per count of cuts before a row: the first label in ``cuts`` that reaches it
    for j in range(len(reached)):
        names.append(max(reached[j:], key=lambda x: x[1])[2])
    label = F.element_at(F.array(*[F.lit(x) for x in [*names, last]]), before + 1)
    return rows.withColumn(col, label).drop("_tie", "_key")


def exact_split(df: DataFrame, key: Sequence[str], fractions: Sequence[tuple[str, float]], col: str = "split") -> DataFrame:
    """T9 with exact row counts: rows in order of a hash of ``key`` (then ``key``) are cut so that what is left after each
    label has ceil(n * its fraction) rows, as a two-way split with a test fraction leaves ceil(n * test)."""
    n, left, cuts = df.count(), 1.0, []
    for name, part in list(fractions)[:-1]:
        left -= part
        cuts.append((name, n - math.ceil(round(n * left, 9))))
    text = F.concat_ws("-", *[F.col(k) for k in key])
    rows = df.withColumn("_h", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"))
    return _label_by_rank(rows, ["_h", *key], cuts, fractions[-1][0], col).drop("_h")


def prefix_split(df: DataFrame, order_cols: Sequence[str], train_frac: float = 0.8,
                 col: str = "split") -> DataFrame:
    """The first ``train_frac`` of the rows in ``order_cols`` order are train, the rest eval."""
    cut = math.floor(float(train_frac) * df.count())
    return _label_by_rank(df, list(order_cols), [("train", cut)], "eval", col)


# --- P9-P13 --------------------------------------------------------------


def one_hot(df: DataFrame, cols: Sequence[str], max_levels: int = 1000) -> DataFrame:
    """get_dummies semantics.  Levels are sorted, all kept, prefix is the
    column name, originals dropped, other columns untouched.  The distinct
    level list is bounded by ``max_levels`` and checked."""
    out = df
    for c in cols:
        levels = [r[0] for r in df.select(c).distinct().limit(max_levels + 1).collect()]
        if len(levels) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        levels = sorted(v for v in levels if v is not None)
        out = out.withColumns({f"{c}_{v}": F.when(F.col(c) == F.lit(v), 1).otherwise(0) for v in levels}).drop(c)
    return out


def level_table(df: DataFrame, col: str) -> DataFrame:
    """The level dictionary of a column, from the data: (level, code), codes from 0 in sorted order, nulls left out."""
    levels = df.where(F.col(col).isNotNull()).select(F.col(col).alias("level")).distinct()
    return global_position(cut_lineage(levels), ["level"], "code")


def one_hot_long(df: DataFrame, id_col: str, col: str, levels: DataFrame) -> DataFrame:
    """P9 in long form for any number of levels: (id, level, code, flag = 1) of the one active level of each row;
    the other flags are 0 by absence.  A row whose value is no level of the dictionary has no row."""
    rows = df.select(id_col, F.col(col).alias("level"))
    return rows.join(levels, "level").select(id_col, "level", "code", F.lit(1).alias("flag"))


def explode_multi(df: DataFrame, col: str, sep_regex: str = r"[|]", out: str | None = None) -> DataFrame:
    """P10: "A|B" -> one row per value."""
    return df.withColumn(out or col, F.explode(F.split(F.col(col), sep_regex)))


def active_names(flags: Column | str, names: Sequence[str]) -> Column:
    """Names whose flag is 1."""
    f = F.col(flags) if isinstance(flags, str) else flags
    name_arr = F.array(*[F.lit(n) for n in names])
    z = F.arrays_zip(f.alias("flag"), name_arr.alias("name"))
    return F.transform(F.filter(z, lambda x: x["flag"] == 1), lambda x: x["name"])


def pick_where_flag(values: Column | str, flags: Column | str) -> Column:
    """Entries of ``values`` whose flag in ``flags`` is 1."""
    v = F.col(values) if isinstance(values, str) else values
    f = F.col(flags) if isinstance(flags, str) else flags
    z = F.arrays_zip(v.alias("v"), f.alias("f"))
    return F.transform(F.filter(z, lambda x: x["f"] == 1), lambda x: x["v"])


def take_at(arr: Column | str, idx: Column | str) -> Column:
    """arr[idx] with a 0-based index column (gather_nd)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    i = F.col(idx) if isinstance(idx, str) else idx
    return F.element_at(a, i + 1)


def threshold(score: Column | str, t: float = 0.5) -> Column:
    """P5: 1 when score >= t (inclusive) else 0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.when(s >= F.lit(t), 1).otherwise(0)


def exclude(cols: Sequence[str], target: str) -> list[str]:
    """Every column but the target, by exact name."""
    return [c for c in cols if c != target]
