"""Sequences and decision arithmetic on logged data.

Ordered work goes through ``ordering.deal`` (windows over blocks of a key, with
copies of the few rows a block needs from its neighbours), so neither a hot
user nor a single global order ever lands in one task.

The Bellman operators work on tables: ``transitions(s, a, sp, p)``,
``rewards(s, r)`` and ``values(s, v)``.  A backup is a join of transitions
with values on sp, a grouped sum per (s, a) and a join with rewards; its
size is the model's state-action space, estimated from the log by grouped
counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fits_broadcast
from .ordering import following, latest_n, rolling_mean  # noqa: F401  (re-exported)


def transitions(df: DataFrame, keys, order_cols: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Consecutive pairs within each key: every row with the next row's
    ``cols`` as ``next_<col>`` and ``done`` = the next row is the key's last."""
    nxt = following(df, keys, order_cols, cols).where(F.col("left") > 0)
    return nxt.withColumn("done", F.col("left") == F.lit(1)).drop("left")


def td_targets(reward: Column, q_next: Column, done: Column, gamma: float) -> Column:
    """B1: y = r + gamma * max_a Q_hat(s', a) * (1 - done)."""
    return reward + F.lit(gamma) * F.array_max(q_next) * (F.lit(1.0) - done.cast("double"))


def td_loss(df: DataFrame, q: Column, action: Column, reward: Column, q_next: Column, done: Column,
            gamma: float) -> DataFrame:
    """B1: mean squared TD error, one aggregate; Q(s, a) picked with element_at."""
    y = td_targets(reward, q_next, done, gamma)
    qa = F.element_at(q, action + 1)
    return df.agg(F.avg((y - qa) * (y - qa)).alias("loss"), F.count(F.lit(1)).alias("n"), F.avg(y).alias("mean_target"))


# --- MDP tables ---------------------------------------------------------------

def estimate_mdp(pairs: DataFrame, s: str, a: str, sp: str, reward_rows: DataFrame, rs: str, r: str):
    """Empirical p(sp | s, a) = count(s, a, sp) / count(s, a) and rewards
    r(s) = mean reward of the state, both grouped aggregates over the log."""
    c = pairs.groupBy(s, a, sp).agg(F.count(F.lit(1)).alias("c"))
    tot = c.groupBy(s, a).agg(F.sum("c").alias("t"))
    trans = c.join(tot, [s, a]).select(F.col(s).alias("s"), F.col(a).alias("a"), F.col(sp).alias("sp"),
                                       (F.col("c") / F.col("t")).alias("p"))
    rew = reward_rows.groupBy(rs).agg(F.avg(r).alias("r")).select(F.col(rs).alias("s"), "r")
    # both tables are the size of the state-action space; materialise them once
    # so that the sweeps below never re-read the log
    return cut_lineage(trans), cut_lineage(rew)


def bellman_backup(trans: DataFrame, rew: DataFrame, values: DataFrame, gamma: float) -> DataFrame:
    """B2: Q(s, a) = r(s) + gamma * sum_sp p(sp | s, a) V(sp) for all (s, a)."""
    ev = (trans.join(values.select(F.col("s").alias("sp"), "v"), "sp", "left")
          .groupBy("s", "a").agg(F.sum(F.col("p") * F.coalesce("v", F.lit(0.0))).alias("ev")))
    return ev.join(rew, "s").select("s", "a", (F.col("r") + F.lit(gamma) * F.col("ev")).alias("q"))


def evaluate_policy(trans: DataFrame, rew: DataFrame, policy: DataFrame, gamma: float, tol: float = 1e-10,
                    max_sweeps: int = 10_000, sweeps_per_job: int = 5,
                    start: DataFrame | None = None) -> tuple[DataFrame, int]:
    """Synchronous sweeps V <- r(s) + gamma * sum_sp p V(sp) under the policy, from ``start`` (default 0).

    ``sweeps_per_job`` sweeps are one plan, written as a table that cuts the lineage; it ends when such a
    round changes no value by ``tol`` and raises if ``max_sweeps`` pass before.  A state without
    transitions under its action (terminal, or an action the model lacks) has V = r.  Returns the
    values and the number of sweeps."""
    tp = trans.join(policy.select("s", "a"), ["s", "a"]).select("s", "sp", "p").persist(StorageLevel.MEMORY_AND_DISK)
    values = start.select("s", "v") if start is not None else rew.select("s", F.lit(0.0).alias("v"))
    # a row per state: counted, and broadcast if that size allows; a sweep is then one exchange, of partial sums
    small = F.broadcast if fits_broadcast(rew.count(), 2) else lambda df: df
    sweeps, change = 0, None
    while sweeps < max_sweeps:
        new = values
        known = rew.join(values.withColumnRenamed("v", "old"), "s", "left")
        count = min(sweeps_per_job, max_sweeps - sweeps)
        for i in range(count):
            ev = small(tp.join(small(new.select(F.col("s").alias("sp"), "v")), "sp", "left")
                       .groupBy("s").agg(F.sum(F.col("p") * F.coalesce("v", F.lit(0.0))).alias("ev")))
            last = i == count - 1  # the written round carries its own change
            extra = [F.abs(F.col("r") + F.lit(gamma) * F.coalesce("ev", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))).alias("change")] if last else []
            new = (known if last else rew).join(ev, "s", "left").select(
                "s", (F.col("r") + F.lit(gamma) * F.coalesce("ev", F.lit(0.0))).alias("v"), *extra)
            sweeps += 1
        new = cut_lineage(new)
        change = new.agg(F.max("change")).first()[0]
        values = new.drop("change")
        if change is None or change < tol:
            tp.unpersist()
            return values, sweeps
    tp.unpersist()
    raise RuntimeError(f"values still change by {change} after {sweeps} sweeps")


def greedy_policy(q: DataFrame, current: DataFrame | None = None, margin: float = 0.0) -> DataFrame:
    """B4 improvement: best action per state, the lowest of equals.  With a current policy the action
    only changes where another is better by more than ``margin``, and states without any action keep theirs."""
    best = q.groupBy("s").agg(F.max_by("a", F.struct("q", (-F.col("a")).alias("na"))).alias("a"),
                              F.max("q").alias("qmax"))
    if current is None:
        return best.select("s", "a")
    cur = current.select("s", F.col("a").alias("a_cur")).join(
        q.select("s", F.col("a").alias("a_cur"), F.col("q").alias("q_cur")), ["s", "a_cur"], "left")
    better = F.col("a").isNotNull() & (F.col("q_cur").isNull() | (F.col("qmax") > F.col("q_cur") + F.lit(margin)))
    return cur.join(best, "s", "left").select("s", F.when(better, F.col("a")).otherwise(F.col("a_cur")).alias("a"))


def policy_iteration(trans: DataFrame, rew: DataFrame, gamma: float, initial_action: int = 0,
                     max_rounds: int = 10_000, tol: float = 1e-10, max_sweeps: int = 10_000):
    """Evaluate, improve greedily, repeat until the policy is stable; raises if it is not after ``max_rounds``.

    One policy row per state of ``rew``; a terminal state keeps ``initial_action``.  Each evaluation goes on from
    the values before; an action changes only for a gain above ten times ``tol``, so that what an
    evaluation leaves open cannot flip equal actions for ever."""
    policy = cut_lineage(rew.select("s", F.lit(initial_action).cast(trans.schema["a"].dataType).alias("a")))
    values = None
    for _ in range(max_rounds):
        values, _ = evaluate_policy(trans, rew, policy, gamma, tol, max_sweeps, start=values)
        q = bellman_backup(trans, rew, values, gamma)
        new = cut_lineage(greedy_policy(q, policy, 10 * tol))
        changed = new.join(policy.withColumnRenamed("a", "old"), "s").where(F.col("a") != F.col("old")).count()
        policy = new
        if changed == 0:
            return policy, values
    raise RuntimeError(f"the policy still changes after {max_rounds} rounds")


# --- B6 -----------------------------------------------------------------------

def episode_returns(df: DataFrame, episode_cols: Sequence[str], reward: str) -> DataFrame:
    """Total reward per episode (grouped sum, map-side combined)."""
    return df.groupBy(*episode_cols).agg(F.sum(reward).alias("episode_return"))


def solved_rule(returns: DataFrame, order_cols: Sequence[str], window: int = 100, threshold: float = 200.0):
    """Trailing mean of the last <= ``window`` episode returns in order, and
    the first episode where it reaches ``threshold`` (flag 1 on that row only)."""
    rm = rolling_mean(returns, [], order_cols, "episode_return", window, partial=True, out="trailing_mean",
                      keep_index=True, with_sum=True)
    first = rm.where(F.col("trailing_mean") >= F.lit(threshold)).agg(F.min("rn")).first()[0]
    flag = F.when(F.col("rn") == F.lit(first), 1).otherwise(0) if first is not None else F.lit(0)
    return rm.withColumn("solved", flag).drop("n_key")
