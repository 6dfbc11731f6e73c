"""Skew-safe ordering: positions, rolling means and neighbours equal the per-key window result."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import ordering as od
from tessera.operators import sequence as sq


@pytest.fixture(scope="module")
def skewed(spark):
    """events with a third of the rows moved onto one hot user."""
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))).cache()


def _pdf(df):
    return df.toPandas().sort_values(["user_id", "ts", "event_id"]).reset_index(drop=True)


def test_keyed_index_matches_cumcount(spark, skewed):
    got = od.keyed_index(skewed.repartition(7), "user_id", ["ts", "event_id"]).toPandas()
    want = _pdf(skewed)
    want["rn"] = want.groupby("user_id").cumcount() + 1
    m = want.merge(got[["event_id", "rn", "n_key"]], on="event_id", suffixes=("", "_got"))
    assert (m["rn"] == m["rn_got"]).all()
    assert (m.groupby("user_id")["rn"].transform("max") == m["n_key"]).all()


@pytest.mark.parametrize("window,partial", [(3, False), (4, True), (50, True)])
def test_rolling_mean_matches_pandas(skewed, window, partial):
    got = od.rolling_mean(skewed, "user_id", ["ts", "event_id"], "value", window, partial=partial).toPandas()
    want = _pdf(skewed)
    want["want"] = want.groupby("user_id")["value"].transform(
        lambda s: s.rolling(window, min_periods=1 if partial else window).mean())
    m = want.merge(got[["event_id", "rolling_mean"]], on="event_id")
    both = m["want"].isna() == m["rolling_mean"].isna()
    assert both.all()
    ok = m["want"].notna()
    assert np.allclose(m.loc[ok, "want"], m.loc[ok, "rolling_mean"], rtol=1e-12)


def test_global_position_is_a_permutation(spark, skewed):
    pos = od.global_position(skewed, ["ts", "event_id"], "pos").toPandas()
    want = _pdf(skewed).sort_values(["ts", "event_id"]).reset_index(drop=True)
    got = pos.sort_values("pos")
    assert list(got["event_id"]) == list(want["event_id"]) and list(got["pos"]) == list(range(len(want)))


def test_transitions_next_row_and_done(skewed):
    tr = sq.transitions(skewed, "user_id", ["ts", "event_id"], ["event_type"]).toPandas()
    want = _pdf(skewed)
    want["next"] = want.groupby("user_id")["event_type"].shift(-1)
    want["done"] = want.groupby("user_id")["event_type"].shift(-2).isna() & want["next"].notna()
    want = want[want["next"].notna()]
    m = want.merge(tr[["event_id", "next_event_type", "done"]], on="event_id", suffixes=("", "_got"))
    assert len(m) == len(want) and (m["next"] == m["next_event_type"]).all() and (m["done"] == m["done_got"]).all()


def test_latest_n(skewed):
    got = od.latest_n(skewed, "user_id", ["ts", "event_id"], 4).toPandas()
    want = _pdf(skewed).groupby("user_id").tail(4)
    assert sorted(got["event_id"]) == sorted(want["event_id"])


# --- cut keys: blocks of a few rows, so that every window crosses block borders -------

@pytest.fixture(scope="module")
def hot(spark):
    """One key with most rows, several small ones, a null key, NULL values, uneven values."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        key = None if i % 50 == 0 else int(rng.integers(1, 9)) if i % 3 == 0 else 0
        rows.append((key, int(rng.integers(0, 400)), i, None if i % 17 == 0 else float(rng.normal() * 10.0 ** rng.integers(-6, 7))))
    return spark.createDataFrame(rows, "k long, t long, i long, v double").repartition(5).cache()


def _sorted(hot):
    want = hot.toPandas().sort_values(["t", "i"]).reset_index(drop=True)
    want["k"] = want["k"].fillna(-1)
    return want


def test_deal_cuts_only_large_keys(hot):
    d = od.deal(hot, "k", ["t", "i"], per_block=100)
    assert set(d.sizes) == {(0,), *[k for k in d.sizes if k != (0,)]} and len(d.sizes[(0,)]) > 8
    got = d.frame.groupBy("k", "_block").agg(F.min(F.struct("t", "i")).alias("lo"), F.max(F.struct("t", "i")).alias("hi"),
                                             F.count("*").alias("n")).collect()
    per_key = {}
    for r in got:
        per_key.setdefault(r.k, []).append(r)
    for rows in per_key.values():
        rows.sort(key=lambda r: r._block)
        assert all(a.hi < b.lo for a, b in zip(rows, rows[1:]))
        assert all(r.n <= 500 for r in rows) and sum(r.n for r in rows) > 0


@pytest.mark.parametrize("window,partial", [(1, False), (7, False), (7, True), (250, True), (400, False)])
def test_rolling_mean_across_blocks_with_nulls(hot, window, partial):
    got = od.rolling_mean(hot, "k", ["t", "i"], "v", window, partial=partial, keep_index=True, per_block=100).toPandas()
    want = _sorted(hot)
    g = want.groupby("k")["v"]
    want["want"] = g.transform(lambda s: s.rolling(window, min_periods=1 if partial else window).apply(
        lambda x: float(np.sum(x[~np.isnan(x)], dtype=np.longdouble) / np.sum(~np.isnan(x))), raw=True))
    want["rn_want"] = want.groupby("k").cumcount() + 1
    want["n_want"] = want.groupby("k")["i"].transform("count")
    scale = g.transform(lambda s: s.abs().rolling(window, min_periods=1).max())
    m = want.assign(scale=scale).merge(got[["i", "rolling_mean", "rn", "n_key"]], on="i")
    assert len(m) == len(want) == len(got)
    assert (m["want"].isna() == m["rolling_mean"].isna()).all()
    ok = m["want"].notna()
    assert (np.abs(m.loc[ok, "want"] - m.loc[ok, "rolling_mean"]) <= 3e-13 * m.loc[ok, "scale"]).all()
    assert (m["rn"] == m["rn_want"]).all() and (m["n_key"] == m["n_want"]).all()


def test_small_values_are_not_rounded_away(spark):
    df = spark.createDataFrame([(1, i, 1e-20 * (i + 1)) for i in range(4)], "k int, t int, v double")
    got = [r.rolling_mean for r in od.rolling_mean(df, "k", ["t"], "v", 2, partial=True).orderBy("t").collect()]
    assert np.allclose(got, [1e-20, 1.5e-20, 2.5e-20, 3.5e-20], rtol=1e-14, atol=0)


def test_positions_and_neighbours_across_blocks(hot):
    want = _sorted(hot)
    got = od.keyed_index(hot, "k", ["t", "i"], per_block=100).toPandas()
    want["rn_want"] = want.groupby("k").cumcount() + 1
    m = want.merge(got[["i", "rn", "n_key"]], on="i")
    assert (m["rn"] == m["rn_want"]).all() and (m["n_key"] == m.groupby("k")["i"].transform("count")).all()
    nxt = od.following(hot, "k", ["t", "i"], ["i"], steps=2, per_block=100).toPandas()
    want["next_want"] = want.groupby("k")["i"].shift(-2)
    m = want.merge(nxt[["i", "next_i", "left"]], on="i")
    assert m["next_i"].equals(m["next_want"])
    n = m.groupby("k")["i"].transform("count")
    assert (m["left"] == (n - m["rn_want"]).clip(upper=3)).all()
    whole = od.keyed_index(hot, [], ["t", "i"], per_block=100).toPandas().sort_values("rn")
    assert list(whole["i"]) == list(want["i"]) and (whole["n_key"] == len(want)).all()


@pytest.mark.parametrize("per_block", [20, 100, 10_000])
def test_order_statistics(hot, per_block):
    want = _sorted(hot)
    ranks = [1, 2, 599, 600, 1500, 2999, 3000, 3001]
    got = od.order_statistics(hot, ["t", "i"], ranks, per_block)
    assert sorted(got) == ranks[:-1]
    for r in got:
        assert (got[r].t, got[r].i) == (want["t"][r - 1], want["i"][r - 1])
        assert hot.where(od.at_or_before(["t", "i"], got[r])).count() == r


def test_order_helpers_on_an_empty_table(hot):
    none = hot.where("false")
    assert od.keyed_index(none, "k", ["t"]).count() == 0
    assert od.rolling_mean(none, [], ["t"], "v", 3).count() == 0
    assert od.order_statistics(none, ["t"], [1, 5]) == {}


def test_running_aggregates_across_blocks(hot):
    df = hot.select("k", "t", "i", F.when(F.col("i") % 5 > 0, F.col("i") * 7919 % 1000).alias("x"))
    outs = {"s": ("sum", "x"), "lo": ("min", "x"), "hi": ("max", "x"), "b": ("xor", "x")}
    for keys in ("k", []):
        got = od.running(df, keys, ["t", "i"], outs, per_block=100).toPandas().sort_values(["t", "i"])
        got["k"] = got["k"].fillna(-1) if keys else 0
        for _, g in got.groupby("k"):
            seen, xor = [], 0
            for r in g.itertuples():
                if not np.isnan(r.x):
                    seen.append(int(r.x))
                    xor ^= int(r.x)
                if seen:
                    assert (r.s, r.lo, r.hi, r.b) == (sum(seen), min(seen), max(seen), xor)
                else:
                    assert np.isnan(r.s) and np.isnan(r.b)


@pytest.mark.parametrize("picks,per_block", [(300, 50)])
def test_order_statistics_look_for_all_ranks_at_once(spark, hot, picks, per_block):
    want = _sorted(hot)

    def jobs(ranks):
        group = f"ranks-{picks}-{len(ranks)}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            got = od.order_statistics(hot.select("t", "k"), ["t"], ranks, per_block, **({"picks": picks} if picks else {}))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {r: v.t for r, v in got.items()} == {r: want["t"][r - 1] for r in ranks}
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs([300 * k for k in range(1, 10)]) <= 2 * jobs([1500]) + 10


def test_cuts_before_counts_cuts_with_nulls(spark):
    rows = spark.createDataFrame([(None, 2), (1, None), (1, 3), (2, 1), (2, 9)], "a long, b int")
    keyed = rows.withColumn("_key", od.order_key(["a", "b"]))
    cuts = [(None, 2), (1, None), (1, 3), (1, 3), (2, 5)]
    got = {(r.a, r.b): r.n for r in keyed.withColumn("n", od.cuts_before("_key", keyed.schema["_key"].dataType, cuts)).collect()}
    assert got == {(None, 2): 0, (1, None): 1, (1, 3): 2, (2, 1): 4, (2, 9): 5}
