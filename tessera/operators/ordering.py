"""Row order without hot tasks (shared by SURVEY T9, T11, W1-W3, B1, B6).

``Window.partitionBy(key).orderBy(ts)`` puts every row of a key into one
task; when one key holds a third of the data that task is the job.  Here only
keys with more rows than a block may hold are cut, at boundaries sampled from
their own order columns (as range partitioning does), into consecutive blocks:
``deal`` adds the block number, and windows run per (key, block).  What a row
needs from beyond its block is small and comes from the side:

* offsets of positions are sums of the blocks' row counts;
* windows over the last w rows get copies of the w - 1 rows before their block,
  windows that look ahead the rows after it (``with_carried``).

The number of blocks is bounded by the cluster's setting (four per shuffle
partition), so sampled boundaries and block counts are bounded too; results
do not depend on the sample.  Rows are shuffled once, by (key, block), and
nothing is written.  The frame is read more than once (row counts; for cut keys also a
sample and the block counts), so it must give the same rows each time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, isqrt

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLES = 32  # sampled rows per block boundary
PICKS = 65_536  # rows sampled from a stretch that holds an asked rank
BLOCK = "_block"
COPY = "_copy"


def _keys_list(keys) -> list[str]:
    if keys is None:
        return []
    if isinstance(keys, str):
        return [keys]
    return list(keys)


def _small(df: DataFrame, rows: list, fields: list[T.StructField]) -> DataFrame:
    """A broadcast frame of driver rows whose number is bounded by the number of blocks."""
    return F.broadcast(df.sparkSession.createDataFrame(rows, T.StructType(fields)))


def join_keys(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join that matches null keys too; the right side's key columns go."""
    on = F.lit(True)
    for a, b in pairs:
        on = on & left[a].eqNullSafe(right[b])
    return left.join(right, on, how).drop(*[b for _, b in pairs])


@dataclass
class Dealt:
    """A frame with its block column, and the row counts of the blocks of cut keys."""

    frame: DataFrame
    keys: list[str]
    order: list[str]
    sizes: dict[tuple, list[tuple[int, int]]]  # key -> [(block, rows)] in order of the block

    def window(self, descending: bool = False):
        cols = [F.col(c).desc() if descending else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*cols)

    def key_fields(self) -> list[T.StructField]:
        return [T.StructField(f"_k{i}", self.frame.schema[k].dataType) for i, k in enumerate(self.keys)]

    def key_pairs(self, block: str) -> list[tuple[str, str]]:
        return [(k, f"_k{i}") for i, k in enumerate(self.keys)] + [(BLOCK, block)]


def deal(df: DataFrame, keys, order: Sequence[str], per_block: int = 10_000) -> Dealt:
    """Add ``_block``: -1 for a key of at most ``per_block`` rows (or n / (4 shuffle partitions), if
    more), else 0, 1, ... along ``order``.  Rows that tie in all of ``order`` share a block, so
    it should end with a unique column."""
    ks, spark = _keys_list(keys), df.sparkSession
    blocks = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = df.count()
    limit = max(per_block, ceil(n / blocks))
    if ks:
        hot = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).collect()
    else:
        hot = [Row(_n=n)] if n > limit else []
    uncut = Dealt(df.withColumn(BLOCK, F.lit(-1)), ks, list(order), {})
    if not hot:
        return uncut
    kf = uncut.key_fields()
    pairs = [(k, f.name) for k, f in zip(ks, kf, strict=True)]
    row = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    marked = join_keys(df, _small(df, [(*r,) for r in hot], [*kf, T.StructField("_n", T.LongType())]), pairs) if ks else df
    sample = (marked.where(F.pmod(F.xxhash64(*order), F.lit(max(1, limit // SAMPLES))) == 0)
              .groupBy(*ks).agg(F.sort_array(F.collect_set(row)).alias("s"))
              .where(F.size("s") >= SAMPLES)
              .withColumn("s", F.transform(F.sequence(F.lit(1), F.floor(F.size("s") / SAMPLES).cast("int")),
                                           lambda i: F.col("s")[i * SAMPLES - 1])))
    kind = sample.schema["s"].dataType
    cuts = [(*r[:-1], r["s"], r["s"][isqrt(len(r["s"])) - 1::isqrt(len(r["s"]))], isqrt(len(r["s"])))
            for r in sample.collect()]
    if not cuts:
        return uncut
    fields = [*kf, T.StructField("_fine", kind), T.StructField("_coarse", kind), T.StructField("_step", T.IntegerType())]
    bounds = _small(df, cuts, fields)
    if ks:
        wide = join_keys(df, bounds, pairs, "left")
    else:
        wide = df.withColumns({f.name: bounds.select(f.name).scalar() for f in fields})
    skip = F.size(F.filter("_coarse", lambda b: b <= row)) * F.col("_step")  # two steps of about the root of the bounds
    block = skip + F.size(F.filter(F.slice("_fine", skip + 1, F.col("_step")), lambda b: b <= row))
    dealt = wide.withColumn(BLOCK, F.when(F.col("_fine").isNull(), F.lit(-1)).otherwise(block)).drop("_fine", "_coarse", "_step")
    sizes: dict[tuple, list[tuple[int, int]]] = {}
    for r in dealt.where(F.col(BLOCK) >= 0).groupBy(*ks, BLOCK).agg(F.count(F.lit(1)).alias("_n")).collect():
        sizes.setdefault(tuple(r[:-2]), []).append((r[BLOCK], r["_n"]))
    for found in sizes.values():
        found.sort()
    return Dealt(dealt, ks, list(order), sizes)


def with_carried(d: Dealt, before: int = 0, after: int = 0) -> DataFrame:
    """The dealt frame with ``_copy`` (false), and copies (true) of the up to ``before`` rows that precede and
    ``after`` rows that follow each block of a cut key, so that a window per (key, block) sees them."""
    out = d.frame.withColumn(COPY, F.lit(False))
    for count, descending in ((before, True), (after, False)):
        if not count or not d.sizes:
            continue
        goes = []  # rows of block a also go to block b, with ``gap`` rows of other blocks between
        for key, blocks in d.sizes.items():
            path = blocks if descending else blocks[::-1]
            for i, (a, _) in enumerate(path):
                gap = 0
                for b, n in path[i + 1:]:
                    goes.append((*key, a, b, gap))
                    gap += n
                    if gap >= count:
                        break
        fields = [*d.key_fields(), *[T.StructField(c, T.IntegerType()) for c in ("_from", "_to")], T.StructField("_gap", T.LongType())]
        edge = (d.frame.where(F.col(BLOCK) >= 0).withColumn("_r", F.row_number().over(d.window(descending)))
                .where(F.col("_r") <= count))
        moved = join_keys(edge, _small(d.frame, goes, fields), d.key_pairs("_from")).where(F.col("_r") + F.col("_gap") <= count)
        out = out.unionByName(moved.withColumn(BLOCK, F.col("_to")).withColumn(COPY, F.lit(True)).select(*out.columns))
    return out


def _positions(d: Dealt, rows: DataFrame, rn: str, total: str, copies: bool = False) -> DataFrame:
    w = d.window()
    every = Window.partitionBy(*d.keys, BLOCK)
    if copies:
        own = F.when(F.col(COPY), 0).otherwise(1)
        rows = rows.withColumns({rn: F.sum(own).over(w.rowsBetween(Window.unboundedPreceding, 0)), total: F.sum(own).over(every)})
    else:
        rows = rows.withColumns({rn: F.row_number().over(w).cast("long"), total: F.count(F.lit(1)).over(every)})
    if not d.sizes:
        return rows
    offsets = []
    for key, blocks in d.sizes.items():
        at, n = 0, sum(c for _, c in blocks)
        for b, c in blocks:
            offsets.append((*key, b, at, n))
            at += c
    fields = [*d.key_fields(), T.StructField("_b", T.IntegerType()), T.StructField("_off", T.LongType()), T.StructField("_tot", T.LongType())]
    return (join_keys(rows, _small(d.frame, offsets, fields), d.key_pairs("_b"), "left")
            .withColumns({rn: F.col(rn) + F.coalesce("_off", F.lit(0)), total: F.coalesce("_tot", F.col(total))})
            .drop("_off", "_tot"))


def keyed_index(df: DataFrame, keys, order_cols: Sequence[str], rn: str = "rn", total: str = "n_key",
                per_block: int = 10_000) -> DataFrame:
    """Add the 1-based position ``rn`` within ``keys`` in ``order_cols`` order and the key's row count
    ``total``.  Empty ``keys`` orders the whole table."""
    d = deal(df, keys, order_cols, per_block)
    return _positions(d, d.frame, rn, total).drop(BLOCK)


def global_position(df: DataFrame, order_cols: Sequence[str], name: str = "pos",
                    total: str | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (whole table);
    ``total`` also keeps the table's row count as a column of that name."""
    out = keyed_index(df, [], order_cols, rn="_rn1", total="_ntot")
    out = out.withColumn(name, F.col("_rn1") - F.lit(1)).drop("_rn1")
    return out.withColumnRenamed("_ntot", total) if total else out.drop("_ntot")


def following(df: DataFrame, keys, order_cols: Sequence[str], cols: Sequence[str], steps: int = 1, prefix: str = "next_",
              per_block: int = 10_000) -> DataFrame:
    """``cols`` of the row ``steps`` on within the key as ``<prefix><col>``, and ``left``: how many of the
    key's next ``steps`` + 1 rows exist (a null value in a next row is still a next row)."""
    d = deal(df, keys, order_cols, per_block)
    w = d.window()
    there = [F.coalesce(F.lead(F.lit(1), i).over(w), F.lit(0)) for i in range(1, steps + 2)]
    out = with_carried(d, after=steps + 1).withColumns(
        {f"{prefix}{c}": F.lead(c, steps).over(w) for c in cols} | {"left": sum(there[1:], there[0])})
    return out.where(~F.col(COPY)).drop(BLOCK, COPY)


# Running aggregates: the function over rows, and how a block's value meets what earlier blocks carry in.
RUNNING = {"sum": (F.sum, lambda a, b: a + b), "min": (F.min, lambda a, b: F.least(a, b)),
           "max": (F.max, lambda a, b: F.greatest(a, b)), "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}


def running(df: DataFrame, keys, order_cols: Sequence[str], outs: dict[str, tuple[str, str]],
            per_block: int = 10_000) -> DataFrame:
    """Add running aggregates within ``keys``, the current row included: {name: (kind, column)}, kind one of
    sum, min, max, xor.  NULLs are passed over."""
    d = deal(df, keys, order_cols, per_block)
    w = d.window().rowsBetween(Window.unboundedPreceding, 0)
    out = d.frame.withColumns({name: RUNNING[kind][0](col).over(w) for name, (kind, col) in outs.items()})
    if not d.sizes:
        return out.drop(BLOCK)
    before = (Window.partitionBy(*d.keys).orderBy(BLOCK) if d.keys else Window.partitionBy().orderBy(BLOCK))
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    chunks = d.frame.where(F.col(BLOCK) >= 0).groupBy(*d.keys, BLOCK).agg(
        *[RUNNING[kind][0](col).alias(f"_c_{name}") for name, (kind, col) in outs.items()])
    chunks = chunks.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(d.keys)], F.col(BLOCK).alias("_b"),
                           *[RUNNING[kind][0](f"_c_{name}").over(before).alias(f"_p_{name}") for name, (kind, _) in outs.items()])
    out = join_keys(out, F.broadcast(chunks), d.key_pairs("_b"), "left")  # a row a block: bounded
    return out.withColumns({name: F.coalesce(RUNNING[kind][1](F.col(f"_p_{name}"), F.col(name)), f"_p_{name}", name)
                            for name, (kind, _) in outs.items()}).drop(BLOCK, *[f"_p_{name}" for name in outs])


def rolling_mean(df: DataFrame, keys, order_cols: Sequence[str], value: str, window: int,
                 partial: bool = False, out: str = "rolling_mean", keep_index: bool = False,
                 with_sum: bool = False, per_block: int = 10_000) -> DataFrame:
    """Mean of ``value`` over the last ``window`` rows of the key.

    ``partial=False`` (W1) gives NULL unless all ``window`` rows are there and not NULL
    (pandas' default); ``partial=True`` (W2) averages the values seen so far.  A NULL value takes a
    place in the window but counts neither in the sum nor in the divisor.  Sums are of doubles over the
    window's own rows.  ``with_sum`` also returns the window's sum and its count of values
    (``window_sum``, ``window_rows``); ``keep_index`` the position ``rn`` and row count ``n_key``."""
    d = deal(df, keys, order_cols, per_block)
    w = d.window().rowsBetween(-(window - 1), 0)
    v = F.col(value).cast("double")
    rows = with_carried(d, before=window - 1).withColumns({"_sum": F.sum(v).over(w), "_cnt": F.count(v).over(w)})
    if keep_index:
        rows = _positions(d, rows, "rn", "n_key", copies=True)
    mean = F.when(F.col("_cnt") >= (1 if partial else window), F.col("_sum") / F.col("_cnt"))
    rows = rows.where(~F.col(COPY)).withColumn(out, mean)
    if with_sum:
        rows = rows.withColumns({"window_sum": F.coalesce("_sum", F.lit(0.0)), "window_rows": F.col("_cnt")})
    return rows.drop("_sum", "_cnt", BLOCK, COPY)


def latest_n(df: DataFrame, keys, order_cols: Sequence[str], n: int, position: str | None = None) -> DataFrame:
    """The last ``n`` rows of each key in order (a bounded buffer).  ``row_number() <= n`` keeps n rows
    per key and task before the shuffle, so a hot key is no hot task.  ``position`` names a column for the
    1-based place within the key, from the keys' row counts."""
    ks = _keys_list(keys)
    w = (Window.partitionBy(*ks) if ks else Window.partitionBy()).orderBy(*[F.col(c).desc() for c in order_cols])
    last = df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    if position:
        rows = df.withColumn("_all", F.lit(0)) if not ks else df
        last = last.withColumn("_all", F.lit(0)) if not ks else last
        names = ks or ["_all"]
        counts = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)]).agg(F.count(F.lit(1)).alias("_n"))
        last = join_keys(last, counts, [(k, f"_k{i}") for i, k in enumerate(names)])
        last = last.withColumn(position, F.col("_n") - F.col("_r") + F.lit(1)).drop("_n", "_all")
    return last.drop("_r")


# --- order statistics -----------------------------------------------------------

def order_key(order_cols: Sequence[str]) -> Column:
    """The row's ``order_cols`` as one value that compares as they sort."""
    return F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)])


def cuts_before(key: str, kind: T.StructType, cuts: Sequence[Sequence]) -> Column:
    """How many of the ascending ``cuts`` lie before the row, by halving.  ``key`` is a column of ``order_key`` (of type
    ``kind``): comparing it is a short call, where one condition on all columns per cut outgrows a compiled method."""
    def value(v, dt: T.DataType) -> Column:
        return F.lit(str(v) if v is not None and isinstance(dt, T.TimestampNTZType) else v).cast(dt)

    def at(cut) -> Column:
        return F.struct(*[value(v, f.dataType).alias(f.name) for v, f in zip(cut, kind.fields, strict=True)])

    def among(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(key) <= at(cuts[mid]), among(lo, mid)).otherwise(among(mid + 1, hi))

    return among(0, len(cuts))


def order_statistics(df: DataFrame, order_cols: Sequence[str], ranks: Sequence[int], per_block: int = 10_000,
                     picks: int = PICKS) -> dict[int, Row]:
    """rank (1-based) -> the values of ``order_cols`` of the row at that rank, without a full sort.

    Sampled keys around each asked rank (``picks`` of the rows, by hash) bracket it; one pass counts the rows between
    the brackets, and only the rows of the stretches that hold an asked rank are kept for the next round, for all
    ranks at once.  Stretches of at most ``per_block`` rows are ranked.  Ranks beyond the table are left out."""
    asked = sorted({int(r) for r in ranks if r >= 1})
    if not asked:
        return {}
    cols = [*order_cols, "_place"]  # rows that tie are told apart by their place in the scan
    rows = df.select(*order_cols, F.monotonically_increasing_id().alias("_place")).select(order_key(cols).alias("_key"))
    kind = rows.schema["_key"].dataType
    n = rows.count()
    # stretch -> (ranks within it, rows before it, its rows, one of how many rows is picked)
    open_ = {0: ([r for r in asked if r <= n], 0, n, max(1, n // picks))}
    rows, held, found = rows.select(F.lit(0).alias("_in"), "_key"), None, {}

    def per_stretch(values: dict[int, Column]) -> Column:
        out = F.lit(None)
        for i, v in values.items():
            out = F.when(F.col("_in") == i, v).otherwise(out)
        return out

    while True:
        small = {i: v for i, v in open_.items() if v[2] <= per_block}
        if any(v[0] for v in small.values()):
            rn = F.row_number().over(Window.partitionBy("_in").orderBy("_key"))
            near = rows.where(F.col("_in").isin(list(small))).select("_in", "_key", rn.alias("_rn"))
            wanted = per_stretch({i: F.col("_rn").isin([r - at for r in inside]) for i, (inside, at, _, _) in small.items()})
            found |= {r["_rn"] + small[r["_in"]][1]: Row(**dict(zip(order_cols, r["_key"]))) for r in near.where(wanted).collect()}
        big = {i: v for i, v in open_.items() if v[2] > per_block and v[0]}
        if not big:
            break
        step = per_stretch({i: F.lit(v[3]) for i, v in big.items()})
        sample = rows.where(F.col("_in").isin(list(big)) & (F.pmod(F.xxhash64("_key"), step) == 0)).groupBy("_in").agg(
            F.sort_array(F.collect_list("_key")).alias("s"))
        share = per_stretch({i: F.array(*[F.lit((r - at) / m) for r in inside]) for i, (inside, at, m, _) in big.items()})
        wide = F.when(step == 1, F.lit(0)).otherwise(F.ceil(F.sqrt(F.size("s"))) * 2 + 4)  # four standard deviations or more

        def bracket(f):
            mid = F.round(f * F.size("s")).cast("int") - 1  # of a whole stretch the very row
            return F.array(*[F.struct(p.alias("p"), F.get("s", p).alias("k")) for p in ((mid - wide - 1).cast("int"), (mid + wide).cast("int"))])

        chosen = {r["_in"]: {p: k for p, k in r["b"] if k is not None} for r in sample.select(
            "_in", F.flatten(F.transform(share, bracket)).alias("b")).collect()}
        # each stretch is cut at its own keys; what holds a rank goes on under a new number
        first, number = {}, 0
        for i in big:
            first[i], number = number, number + len(chosen.get(i, {})) + 1
        place = per_stretch({i: cuts_before("_key", kind, [k for _, k in sorted(chosen.get(i, {}).items())]) + f for i, f in first.items()})
        cut = rows.where(F.col("_in").isin(list(big))).select(place.alias("_in"), "_key")
        sizes = {r["_in"]: r["n"] for r in cut.groupBy("_in").agg(F.count(F.lit(1)).alias("n")).collect()}
        open_ = {}
        for i, (inside, at, m, every) in big.items():
            for j in range(first[i], first[i] + len(chosen.get(i, {})) + 1):
                here = sizes.get(j, 0)
                ours = [r for r in inside if at < r <= at + here]
                if ours:  # a stretch that was not cut is sampled more closely
                    open_[j] = (ours, at, here, max(1, min(here // picks, every // 4 if here == m else every)))
                at += here
        rows, old = cut.where(F.col("_in").isin(list(open_))).persist(StorageLevel.MEMORY_AND_DISK), held
        rows.count()
        if old is not None:
            old.unpersist()
        held = rows
    if held is not None:
        held.unpersist()
    return found


def at_or_before(order_cols: Sequence[str], cut: Row) -> Column:
    """Condition: the row's ``order_cols`` are not after ``cut`` (nulls first, as in sorting)."""
    cond: Column = F.lit(True)
    for c in reversed(list(order_cols)):
        v = cut[c]
        if v is None:
            cond = F.col(c).isNull() & cond
        else:
            cond = F.col(c).isNull() | (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & cond)
    return cond
