"""Bellman operators against a numpy solve, with terminal states and unknown actions."""

import numpy as np
import pytest

from tessera.operators import sequence as sq

# The six-state line world (terminal rewards 100 and 40, gamma 0.5, no misstep).
REWARDS = [100.0, 0.0, 0.0, 0.0, 0.0, 40.0]
GAMMA = 0.5


def line_world(spark):
    rows = []
    for s in range(6):
        if s in (0, 5):
            continue  # terminal: no outgoing transitions
        rows.append((s, 0, s - 1, 1.0))  # left
        rows.append((s, 1, s + 1, 1.0))  # right
    trans = spark.createDataFrame(rows, "s int, a int, sp int, p double")
    rew = spark.createDataFrame(list(enumerate(REWARDS)), "s int, r double")
    return trans, rew


def test_bellman_backup(spark):
    trans, rew = line_world(spark)
    q = {(r.s, r.a): r.q for r in sq.bellman_backup(trans, rew, rew.withColumnRenamed("r", "v"), GAMMA).collect()}
    assert q[(1, 0)] == 50.0 and q[(4, 1)] == 20.0 and q[(2, 1)] == 0.0


def test_policy_iteration_line_world(spark):
    trans, rew = line_world(spark)
    pol, val = sq.policy_iteration(trans, rew, GAMMA)
    v = {r.s: r.v for r in val.collect()}
    assert v[0] == 100.0 and v[5] == 40.0
    assert v[1] == pytest.approx(50.0) and v[2] == pytest.approx(25.0)
    assert v[3] == pytest.approx(12.5) and v[4] == pytest.approx(20.0)
    p = {r.s: r.a for r in pol.collect()}
    assert p == {0: 0, 1: 0, 2: 0, 3: 0, 4: 1, 5: 0}  # terminal states keep the initial action


def test_policy_limits_and_unknown_actions(spark):
    trans, rew = line_world(spark)
    policy = spark.createDataFrame([(s, 7) for s in range(6)], "s int, a int")
    v, _ = sq.evaluate_policy(trans, rew, policy, GAMMA)
    assert {r.s: r.v for r in v.collect()} == dict(enumerate(REWARDS))
    pol, _ = sq.policy_iteration(trans, rew, GAMMA, initial_action=7)
    assert {r.s: r.a for r in pol.collect()} == {0: 7, 1: 0, 2: 0, 3: 0, 4: 1, 5: 7}
    with pytest.raises(RuntimeError):
        sq.evaluate_policy(trans, rew, policy.withColumn("a", policy.a * 0), GAMMA, max_sweeps=1)
    with pytest.raises(RuntimeError):
        sq.policy_iteration(trans, rew, GAMMA, max_rounds=1)


def test_transitions_keep_a_null_next_row(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 2, None), ("u", 3, "c")], "k string, at int, x string")
    out = {(r.at, r.next_x, r.done) for r in sq.transitions(df, "k", ["at"], ["x"]).collect()}
    assert out == {(1, None, False), (2, "c", True)}


def test_policy_evaluation_equals_linear_solve(spark):
    trans, rew = line_world(spark)
    policy = spark.createDataFrame([(s, 1) for s in range(6)], "s int, a int")
    v, _ = sq.evaluate_policy(trans, rew, policy, GAMMA)
    got = {r.s: r.v for r in v.collect()}
    p = np.zeros((6, 6))
    for s in range(1, 5):
        p[s, s + 1] = 1.0
    want = np.linalg.solve(np.eye(6) - GAMMA * p, np.array(REWARDS))
    assert all(got[s] == pytest.approx(want[s], abs=1e-8) for s in range(6))


def test_td_loss_golden_shape(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([([1.0, 2.0], 1, 1.0, [0.0, 3.0], False), ([0.5, 0.0], 0, 0.0, [1.0, 1.0], True)],
                               "q array<double>, a int, r double, qn array<double>, done boolean")
    out = sq.td_loss(df, F.col("q"), F.col("a"), F.col("r"), F.col("qn"), F.col("done"), 0.9).first()
    y1, y2 = 1.0 + 0.9 * 3.0, 0.0
    assert out.loss == pytest.approx(((y1 - 2.0) ** 2 + (y2 - 0.5) ** 2) / 2)
