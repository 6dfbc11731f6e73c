"""Recommender goldens and properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import recommend as rc

# The literal collaborative-filtering cost case (4 items, 3 users, 4 factors, lambda 3).
X_R = [[0.36618032, 0.9075415, 0.8310605, 0.08590986], [0.62634721, 0.38234325, 0.85624346, 0.55183039],
       [0.77458727, 0.35704147, 0.31003294, 0.20100006], [0.34420469, 0.46103436, 0.88638208, 0.36175401]]
W_R = [[0.04786854, 0.61504665, 0.06633146, 0.38298908], [0.16515965, 0.22320207, 0.89826005, 0.14373251],
       [0.1274051, 0.22757303, 0.96865613, 0.70741111]]
B_R = [0.14246472, 0.30110933, 0.56141144]
Y_R = [[0.20651685, 0.60767914, 0.86344527], [0.82665019, 0.00944765, 0.4376798], [0.81623732, 0.26776794, 0.03757507],
       [0.37232161, 0.19890823, 0.13026598]]
R_R = [[1, 0, 1], [1, 0, 0], [1, 0, 0], [0, 1, 0]]


def _tables(spark):
    ratings = spark.createDataFrame([(u, i, float(Y_R[i][u])) for i in range(4) for u in range(3) if R_R[i][u]],
                                    "user_id long, item_id long, rating double")
    items = spark.createDataFrame([(i, *map(float, X_R[i])) for i in range(4)], ["item_id"] + [f"f_{j}" for j in range(4)])
    users = spark.createDataFrame([(u, *map(float, W_R[u]), float(B_R[u])) for u in range(3)],
                                  ["user_id"] + [f"f_{j}" for j in range(4)] + ["b"])
    return ratings, items, users


def test_cofi_cost_golden(spark):
    r, it, us = _tables(spark)
    assert rc.cofi_cost(r, it, us, "user_id", "item_id", "rating", 4, 3.0) == pytest.approx(13.621929978531858, abs=1e-8)


def _np_cost(x, w, b, y, r, lam):
    e = (x @ w.T + b - y) * r
    return 0.5 * np.sum(e * e) + lam / 2 * (np.sum(w * w) + np.sum(x * x))


def test_gradient_steps_lower_cost_and_match_numpy(spark):
    r, it, us = _tables(spark)
    it2, us2, hist = rc.train_factors(r, it, us, "user_id", "item_id", "rating", 4, 1.0, 0.01, 3, optimizer="gd",
                                      block_rows=2, piece_rows=1)
    x, w, b = np.array(X_R), np.array(W_R), np.array(B_R)
    y, m = np.array(Y_R), np.array(R_R)
    for _ in range(3):
        e = (x @ w.T + b - y) * m
        gx, gw, gb = e @ w + 1.0 * x, e.T @ x + 1.0 * w, e.sum(0)
        x, w, b = x - 0.01 * gx, w - 0.01 * gw, b - 0.01 * gb
    got_x = np.array([[row[f"f_{j}"] for j in range(4)] for row in it2.orderBy("item_id").collect()])
    got_b = np.array([row["b"] for row in us2.orderBy("user_id").collect()])
    assert np.allclose(got_x, x) and np.allclose(got_b, b)
    assert hist[0][1] == pytest.approx(_np_cost(np.array(X_R), np.array(W_R), np.array(B_R), y, m, 1.0))


@pytest.mark.parametrize("block_rows,piece_rows", [(16_384, 100_000), (7, 5)])
def test_blocked_training_matches_dense_adam(spark, block_rows, piece_rows):
    rng = np.random.default_rng(3)
    nu, ni, k, lam, lr = 30, 20, 4, 0.7, 0.05
    y = rng.normal(size=(ni, nu)) * 2
    m = rng.random((ni, nu)) < 0.2
    m[3], m[:, 7] = True, True  # a hot item, a hot user
    m[5], m[:, 9] = False, False  # and none
    x, w, b = rng.normal(size=(ni, k)), rng.normal(size=(nu, k)), rng.normal(size=nu)
    r = spark.createDataFrame([(u, f"i{i:02}", float(y[i, u])) for i in range(ni) for u in range(nu) if m[i, u]] + [(99, "i00", 1.0), (0, "zz", 1.0), (9, "i05", None)],
                              "user_id long, item_id string, rating double").repartition(3)
    it = spark.createDataFrame([(f"i{i:02}", *map(float, x[i])) for i in range(ni)], ["item_id"] + [f"f_{j}" for j in range(k)])
    us = spark.createDataFrame([(u, *map(float, w[u]), float(b[u])) for u in range(nu)], ["user_id"] + [f"f_{j}" for j in range(k)] + ["b"])
    it2, us2, hist = rc.train_factors(r, it, us, "user_id", "item_id", "rating", k, lam, lr, 6, block_rows=block_rows, piece_rows=piece_rows)
    state = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in (("x", x), ("w", w), ("b", b))}
    for t in range(1, 7):
        assert hist[t - 1][1] == pytest.approx(_np_cost(x, w, b, y, m, lam), rel=1e-12)
        e = (x @ w.T + b - y) * m
        grads = {"x": e @ w + lam * x, "w": e.T @ x + lam * w, "b": e.sum(0)}
        new = {}
        for n, v in (("x", x), ("w", w), ("b", b)):
            a, s = state[n]
            a = a + (grads[n] - a) * 0.1
            s = s + (grads[n] ** 2 - s) * (1 - 0.999)
            state[n] = (a, s)
            new[n] = v - lr * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t) * a / (np.sqrt(s) + 1e-7)
        x, w, b = new["x"], new["w"], new["b"]
    got = np.array([[row[f"f_{j}"] for j in range(k)] for row in it2.orderBy("item_id").collect()])
    assert np.allclose(got, x, rtol=1e-9, atol=1e-9)
    assert np.allclose([row["b"] for row in us2.orderBy("user_id").collect()], b, rtol=1e-9, atol=1e-9)


def test_recommend_all_matches_dense_scores(spark):
    rng = np.random.default_rng(5)
    x, w, b = rng.integers(0, 3, (40, 2)).astype(float), rng.integers(-1, 2, (25, 2)).astype(float), rng.integers(0, 2, 25).astype(float)
    off = [None if i % 7 == 0 else float(i % 3) for i in range(40)]
    rated = {(u, i) for u in range(25) for i in range(40) if u == 4 or i == 6 or (u * i) % 5 == 1}
    it = spark.createDataFrame([(i, *map(float, x[i]), off[i]) for i in range(40)], "item_id long, f_0 double, f_1 double, off double")
    us = spark.createDataFrame([(u, *map(float, w[u]), float(b[u])) for u in range(25)], "user_id long, f_0 double, f_1 double, b double")
    r = spark.createDataFrame(list(rated), "user_id long, item_id long")
    for block_rows in (6, 1000):
        got = rc.recommend_all(r, it, us, "user_id", "item_id", 2, 5, "off", block_rows=block_rows, step=3).collect()
        have = {(g.user_id, g.rank): (g.item_id, g.score) for g in got}
        want = {}
        for u in range(25):
            scores = sorted((-(x[i] @ w[u] + b[u] + (off[i] or 0.0)), i) for i in range(40) if (u, i) not in rated)
            want |= {(u, n + 1): (i, -s) for n, (s, i) in enumerate(scores[:5])}
        assert have == want and not any(u == 4 for u, _ in have)


def test_nearest_items_blocked_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 4, size=(60, 3)).astype(float)  # integer grid: many exact ties
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(v)], ["id", "a", "b", "c"])
    got = {r.id: (r.nearest_id, r.sq_dist) for r in rc.nearest_items(df, "id", ["a", "b", "c"], block_rows=7).collect()}
    d = ((v[:, None] - v[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    for i in range(60):
        j = int(np.argmin(d[i]))  # lowest id on ties
        assert got[i] == (j, d[i, j])


def test_top_k_and_anti_join(spark):
    sc = spark.createDataFrame([(1, i, float(i % 5)) for i in range(20)], "user_id long, item_id long, score double")
    rated = spark.createDataFrame([(1, 4), (1, 9)], "user_id long, item_id long")
    top = rc.recommend_unseen(sc, rated, "user_id", "item_id", 3).orderBy("rank").collect()
    assert [r.item_id for r in top] == [14, 19, 3]


def test_score_users_adds_mean(spark):
    items = spark.createDataFrame([(1, 1.0, 2.0, 0.5)], "item_id long, f_0 double, f_1 double, item_mean double")
    out = rc.score_users(items, "item_id", [{"user_id": 7, "f_0": 1.0, "f_1": 1.0, "b": 0.25}], 2, "item_mean")
    assert out.first().score == pytest.approx(3.75)


def test_normalize_ratings(spark):
    r = spark.createDataFrame([(1, 1, 4.0), (2, 1, 2.0), (1, 2, 5.0)], "user_id long, item_id long, rating double")
    out = {(x.user_id, x.item_id): x.rating_norm for x in rc.normalize_ratings(r, "item_id", "rating").collect()}
    assert out == {(1, 1): 1.0, (2, 1): -1.0, (1, 2): 0.0}


def test_hash_init_is_stable(spark):
    ids = spark.range(50).withColumnRenamed("id", "item_id")
    a = rc.init_factors(ids, "item_id", 3, "x").orderBy("item_id").collect()
    b = rc.init_factors(ids.repartition(5), "item_id", 3, "x").orderBy("item_id").collect()
    assert a == b and all(-0.5 <= r.f_0 < 0.5 for r in a)
    assert ids.select(F.countDistinct("item_id")).first()[0] == 50


def test_user_profile_keeps_users_without_genres(spark):
    from tessera.operators import recommend as rc
    ratings = spark.createDataFrame([("u", 1, 4.0), ("v", 2, 2.0)], "user string, item int, rating double")
    tags = spark.createDataFrame([(1, "a")], "item int, genre string")
    out = {r.user: (r.rating_count, r.a) for r in rc.user_profile(ratings, tags, "user", "item", "genre", "rating", ["a"]).collect()}
    assert out == {"u": (1, 4.0), "v": (1, 0.0)}


def test_a_seventh_level_survives(spark):
    from tessera.operators import prepare as pr
    part = spark.createDataFrame([(i, f"T{i % 7}") for i in range(21)] + [(99, None)], "item_id long, kind string")
    ratings = spark.createDataFrame([(u, i, float(u + i)) for u in range(3) for i in range(u, 21, 2)] + [(8, 99, 1.0)], "user_id long, item_id long, rating double")
    levels = pr.level_table(part, "kind")
    assert [(r.level, r.code) for r in levels.orderBy("code").collect()] == [(f"T{i}", i) for i in range(7)]
    got = {(r.user_id, r.level): (r.mean, r.n) for r in rc.user_level_means(ratings, part, levels, "user_id", "item_id", "kind", "rating").collect()}
    assert len(got) == 4 * 7 and all(got[8, f"T{i}"] == (0.0, 0) for i in range(7))  # a user without any level keeps rows
    assert got[0, "T6"] == (np.mean([6.0, 20.0]), 2) and got[1, "T6"] == (14.0, 1)
    hot = pr.one_hot_long(part, "item_id", "kind", levels)
    assert hot.count() == 21 and hot.where("level = 'T6' AND code = 6 AND flag = 1").count() == 3


@pytest.mark.parametrize("head", [1, 6, 17, 39, 40])
def test_recommend_all_with_a_small_head_equals_dense_scores(spark, head):
    """Users whose best lie in the head are done there, the others meet every item; rated, tied and repeated rows."""
    rng = np.random.default_rng(8)
    x, w, b = rng.normal(size=(40, 2)).round(1), rng.normal(size=(25, 2)).round(1), rng.normal(size=25).round(1)
    off = [None if i % 9 == 0 else float(i % 8) for i in range(40)]
    rated = {(u, i) for u in range(25) for i in range(40) if u == 4 or (u * i) % 5 == 1 or (u == 7 and i % 8 > 1)}
    it = spark.createDataFrame([(i, *map(float, x[i]), off[i]) for i in range(40)], "item_id int, f_0 double, f_1 double, off double")
    us = spark.createDataFrame([(u or None, *map(float, w[u]), float(b[u])) for u in range(25)], "user_id long, f_0 double, f_1 double, b double")
    r = spark.createDataFrame([*rated, (3, 1000), (1, 2), (1, 2)], "user_id long, item_id int")
    got = rc.recommend_all(r, it, us, "user_id", "item_id", 2, 5, "off", block_rows=9, step=3, head=head).collect()
    have = {(g.user_id, g.rank): (g.item_id, round(g.score, 9)) for g in got}
    want = {}
    for u in range(25):
        mine = rated | {(3, 1000), (1, 2)} if u else set()  # a null user has no ratings
        scores = sorted((-(x[i, 0] * w[u, 0] + x[i, 1] * w[u, 1] + b[u] + (off[i] or 0.0)), i) for i in range(40) if (u, i) not in mine)
        want |= {(u or None, n + 1): (i, round(-s, 9)) for n, (s, i) in enumerate(scores[:5])}
    assert have == want


def test_cofi_cost_of_several_lambdas_reads_ratings_once(spark):
    it = spark.createDataFrame([(i, 0.1 * i, 0.2) for i in range(6)], "item_id long, f_0 double, f_1 double")
    us = spark.createDataFrame([(u, 0.3, 0.1 * u, 0.5) for u in range(5)], "user_id long, f_0 double, f_1 double, b double")
    seen = spark.sparkContext.accumulator(0)

    def mark(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = [(u, i, float(u + i)) for u in range(5) for i in range(6)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating double").mapInArrow(mark, "user_id long, item_id long, rating double")
    both = rc.cofi_cost(r, it, us, "user_id", "item_id", "rating", 2, (0.0, 1.5))
    assert seen.value == len(rows)
    assert both == pytest.approx([rc.cofi_cost(r, it, us, "user_id", "item_id", "rating", 2, v) for v in (0.0, 1.5)])


def test_training_blocks_do_not_multiply_with_the_rows(spark, monkeypatch):
    """A factor block travels to every block of the other side: their number is held while blocks are small."""
    from tessera.operators import factors
    fac = spark.range(3000).selectExpr("id AS item_id", "0.1D AS f_0", "0.2D AS f_1")
    blocks, n = factors._blocks(fac, "item_id", ["f_0", "f_1"], 10, factors.BLOCKS)
    assert n == factors.BLOCKS and blocks.selectExpr("explode(ids) AS i").distinct().count() == 3000
    monkeypatch.setattr(factors, "BLOCK_BYTES", 4000)  # 250 rows of two factors
    assert factors._blocks(fac, "item_id", ["f_0", "f_1"], 10, factors.BLOCKS)[1] == 12


def _odd_tables(spark):
    rng = np.random.default_rng(6)
    it = spark.createDataFrame([(f"i{i % 14}" if i else None, *map(float, rng.normal(size=2))) for i in range(17)], "item_id string, f_0 double, f_1 double")
    us = spark.createDataFrame([(u % 10 if u else None, *map(float, rng.normal(size=3))) for u in range(13)], "user_id int, f_0 double, f_1 double, b double")
    rows = [(u, f"i{i}", float(u - i)) for u in range(13) for i in range(16) if (u + i) % 3] + [(2, "i3", 4.0), (None, "i1", 1.0), (1, None, 1.0), (1, "i1", None)]
    return spark.createDataFrame(rows, "user_id long, item_id string, rating double"), it, us


def test_cost_in_blocks_equals_joined_cost(spark, monkeypatch):
    """Repeated, absent and NULL users and items."""
    r, it, us = _odd_tables(spark)
    joined = rc.cofi_cost(r, it, us, "user_id", "item_id", "rating", 2, 0.7)
    it2, us2, hist = rc.train_factors(r, it, us, "user_id", "item_id", "rating", 2, 0.7, 0.1, 2, block_rows=3, piece_rows=4)
    assert hist[0][1] == pytest.approx(joined, rel=1e-12) and it2.schema["item_id"] == it.schema["item_id"] and us2.schema["user_id"] == us.schema["user_id"]
    assert it2.count() == 17 and us2.count() == 13
    monkeypatch.setattr(rc, "BLOCK_BYTES", 0)
    monkeypatch.setattr(rc, "joined_predictions", None)
    assert rc.cofi_cost(r, it, us, "user_id", "item_id", "rating", 2, 0.7) == pytest.approx(joined, rel=1e-12)
    assert rc.cofi_cost(r.limit(0), it, us.limit(0), "user_id", "item_id", "rating", 2, 0.0) == 0.0


def test_training_keeps_no_tables_of_its_steps(spark):
    from tessera.session import ensure_checkpoint_dir
    top = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    held = lambda: fs.getContentSummary(top).getDirectoryCount()
    r, it, us = _odd_tables(spark)
    added = []
    for steps in (1, 4):
        was = held()
        rc.train_factors(r, it, us, "user_id", "item_id", "rating", 2, 0.7, 0.1, steps, block_rows=50)
        added.append(held() - was)
    assert added[0] == added[1]
