"""Sequence and decision queries over the events log (per user, ordered by ts then event_id)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.core import dot_sql
from ..operators import ordering as od
from ..operators import sequence as sq
from .common import rnd, tbl
from .registry import query

ORDER = ["ts", "event_id"]
WIN_SQL = "PARTITION BY user_id ORDER BY ts, event_id"


def events(spark, sf):
    return tbl(spark, sf, "events")


# --- W1 / W2 / W3 ---------------------------------------------------------------

ROLL_SQL = f"""
SELECT event_id, user_id,
       CASE WHEN row_number() OVER ({WIN_SQL}) >= 5
            THEN round(sum(value) OVER ({WIN_SQL} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), 6) / 5.0 END AS rolling_mean
FROM events
"""


@query("rolling_mean_events", ROLL_SQL)
def rolling_mean_events(spark, sf):
    """Mean of the last 5 values per user, NULL for the first 4 rows (windows over blocks of a user, with the 4 rows before each block)."""
    out = od.rolling_mean(events(spark, sf).select("event_id", "user_id", "ts", "value"), "user_id", ORDER, "value", 5,
                          with_sum=True)
    return out.select("event_id", "user_id", F.when(F.col("rolling_mean").isNotNull(), rnd("window_sum", 6)
                                                    / F.col("window_rows").cast("double")).alias("rolling_mean"))


TRAIL_SQL = f"""
SELECT event_id, user_id, round(sum(value) OVER ({WIN_SQL} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6)
       / count(*) OVER ({WIN_SQL} ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS trailing_mean
FROM events
"""


@query("trailing_mean_events", TRAIL_SQL)
def trailing_mean_events(spark, sf):
    """Mean of the last <= 100 values per user, partial at the start."""
    out = od.rolling_mean(events(spark, sf).select("event_id", "user_id", "ts", "value"), "user_id", ORDER, "value",
                          100, partial=True, out="trailing_mean", with_sum=True)
    return out.select("event_id", "user_id", (rnd("window_sum", 6) / F.col("window_rows").cast("double"))
                      .alias("trailing_mean"))


LATEST_SQL = f"""
SELECT user_id, event_id, CAST(rn AS BIGINT) AS position FROM (
  SELECT user_id, event_id, row_number() OVER ({WIN_SQL}) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events)
WHERE rn > n - 10
"""


@query("latest_events", LATEST_SQL)
def latest_events(spark, sf):
    """The latest 10 events of every user (bounded buffer), with their position."""
    out = od.latest_n(events(spark, sf).select("event_id", "user_id", "ts"), "user_id", ORDER, 10, "position")
    return out.select("user_id", "event_id", "position")


# --- B1: TD loss ------------------------------------------------------------------

TYPES = ["click", "error", "purchase", "signup", "view"]
GAMMA_TD = 0.995
WQ = [[round(math.sin(1 + 2 * i + 3 * a) * 0.5, 4) for a in range(5)] for i in range(6)]
BQ = [0.1 * a for a in range(5)]
WT = [[round(math.cos(2 + i + 2 * a) * 0.5, 4) for a in range(5)] for i in range(6)]


def _state_cols(t, v):
    return [F.when(t == x, 1.0).otherwise(0.0) for x in TYPES] + [v / 100.0]


def _q(prefix: str, w, b):
    """Q values of the 5 actions: fixed linear maps of the named state columns."""
    names = [f"{prefix}{i}" for i in range(6)]
    return F.expr("array(" + ", ".join(dot_sql(names, [w[i][a] for i in range(6)], b[a]) for a in range(5)) + ")")


def _state_sql(t: str, v: str) -> list[str]:
    return [f"CASE WHEN {t} = '{x}' THEN 1.0 ELSE 0.0 END" for x in TYPES] + [f"{v} / 100.0"]


def _q_sql(state: list[str], w, b) -> list[str]:
    return [f"({float(b[a])!r} + " + " + ".join(f"({state[i]}) * {w[i][a]!r}" for i in range(6)) + ")"
            for a in range(5)]


def _td_sql() -> str:
    s = _state_sql("event_type", "value")
    ns = _state_sql("nt", "nv")
    q = _q_sql(s, WQ, BQ)
    qn = _q_sql(ns, WT, [0.0] * 5)
    act = "CASE nt " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(TYPES)) + " END"
    qa = "CASE a " + " ".join(f"WHEN {i} THEN {q[i]}" for i in range(5)) + " END"
    y = f"(nv / 100.0 + {GAMMA_TD!r} * greatest({', '.join(qn)}) * (1.0 - CASE WHEN rn + 1 = n THEN 1.0 ELSE 0.0 END))"
    return f"""
WITH e AS (SELECT *, lead(event_type) OVER ({WIN_SQL}) AS nt, lead(value) OVER ({WIN_SQL}) AS nv,
                  row_number() OVER ({WIN_SQL}) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM events),
t AS (SELECT *, {act} AS a FROM e WHERE nt IS NOT NULL)
SELECT round(avg(power({y} - {qa}, 2)), 8) AS loss, count(*) AS n, round(avg({y}), 8) AS mean_target FROM t
"""


@query("td_loss", _td_sql())
def td_loss_q(spark, sf):
    """B1: logged transitions (next event per user), Q and target-Q from fixed linear maps, TD targets and MSE; P13 gather."""
    e = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    tr = sq.transitions(e, "user_id", ORDER, ["event_type", "value"])
    tr = tr.withColumns({f"s{i}": c for i, c in enumerate(_state_cols(F.col("event_type"), F.col("value")))}
                        | {f"ns{i}": c for i, c in enumerate(_state_cols(F.col("next_event_type"), F.col("next_value")))})
    action = F.array_position(F.array(*[F.lit(x) for x in TYPES]), F.col("next_event_type")).cast("int") - 1
    out = sq.td_loss(tr, _q("s", WQ, BQ), action, F.col("next_value") / 100.0, _q("ns", WT, [0.0] * 5), F.col("done"),
                     GAMMA_TD)
    return out.select(rnd("loss", 8).alias("loss"), "n", rnd("mean_target", 8).alias("mean_target"))


# --- B2 / B3 / B4: MDP estimated from the log -------------------------------------

GAMMA = 0.5
HIGH = 35.0


def mdp(spark, sf):
    e = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    tr = sq.transitions(e, "user_id", ORDER, ["event_type"])
    pairs = tr.select(F.col("event_type").alias("s"), F.when(F.col("value") >= HIGH, 1).otherwise(0).alias("a"),
                      F.col("next_event_type").alias("sp"))
    return sq.estimate_mdp(pairs, "s", "a", "sp", e.select("event_type", (F.col("value") / 100.0).alias("r")),
                           "event_type", "r")


MDP_SQL = f"""e AS (SELECT *, lead(event_type) OVER ({WIN_SQL}) AS nt FROM events),
c AS (SELECT event_type AS s, CASE WHEN value >= {HIGH!r} THEN 1 ELSE 0 END AS a, nt AS sp, count(*) AS c
      FROM e WHERE nt IS NOT NULL GROUP BY 1, 2, 3),
tr AS (SELECT s, a, sp, c / sum(c) OVER (PARTITION BY s, a) AS p FROM c),
rw AS (SELECT event_type AS s, avg(value / 100.0) AS r FROM events GROUP BY event_type)"""

BACKUP_SQL = f"""
WITH {MDP_SQL},
ev AS (SELECT tr.s, tr.a, sum(tr.p * v.r) AS ev FROM tr JOIN rw v ON v.s = tr.sp GROUP BY tr.s, tr.a)
SELECT ev.s, CAST(ev.a AS INTEGER) AS a, round(rw.r + {GAMMA!r} * ev.ev, 8) AS q FROM ev JOIN rw ON rw.s = ev.s
"""


@query("bellman_backup", BACKUP_SQL)
def bellman_backup_q(spark, sf):
    """B2: one backup Q(s,a) = r(s) + gamma * sum p(s'|s,a) V(s') with V = r, on the MDP estimated from the log."""
    trans, rew = mdp(spark, sf)
    q = sq.bellman_backup(trans, rew, rew.select("s", F.col("r").alias("v")), GAMMA)
    return q.select("s", "a", rnd("q", 8).alias("q"))


SWEEPS_SQL = 80


def _eval_sql() -> str:
    return f"""
WITH RECURSIVE {MDP_SQL},
tp AS (SELECT * FROM tr WHERE a = 0),
it(k, s, v) AS (
  SELECT 0, s, 0.0::DOUBLE FROM rw
  UNION ALL
  SELECT it.k + 1, tp.s, (SELECT r FROM rw WHERE rw.s = tp.s) + {GAMMA!r} * sum(tp.p * it.v)
  FROM tp JOIN it ON it.s = tp.sp WHERE it.k < {SWEEPS_SQL} GROUP BY it.k, tp.s)
SELECT s, round(v, 8) AS v FROM it WHERE k = {SWEEPS_SQL}
"""


@query("policy_evaluation", _eval_sql())
def policy_evaluation_q(spark, sf):
    """Evaluate the policy 'always action 0' by synchronous sweeps until max change < 1e-10."""
    trans, rew = mdp(spark, sf)
    policy = rew.select("s", F.lit(0).alias("a"))
    v, _ = sq.evaluate_policy(trans, rew, policy, GAMMA)
    return v.select("s", rnd("v", 8).alias("v"))


def _vi_sql() -> str:
    return f"""
WITH RECURSIVE {MDP_SQL},
it(k, s, v) AS (
  SELECT 0, s, 0.0::DOUBLE FROM rw
  UNION ALL
  SELECT k + 1, s, max(q) FROM (
    SELECT it.k, tr.s, tr.a, (SELECT r FROM rw WHERE rw.s = tr.s) + {GAMMA!r} * sum(tr.p * it.v) AS q
    FROM tr JOIN it ON it.s = tr.sp WHERE it.k < {SWEEPS_SQL} GROUP BY it.k, tr.s, tr.a) GROUP BY k, s),
vf AS (SELECT s, v FROM it WHERE k = {SWEEPS_SQL}),
q AS (SELECT tr.s, tr.a, rw.r + {GAMMA!r} * sum(tr.p * vf.v) AS q FROM tr JOIN vf ON vf.s = tr.sp
      JOIN rw ON rw.s = tr.s GROUP BY tr.s, tr.a, rw.r)
SELECT q.s, CAST(q.a AS INTEGER) AS a, round(vf.v, 8) AS v FROM q JOIN vf ON vf.s = q.s
QUALIFY row_number() OVER (PARTITION BY q.s ORDER BY q.q DESC, q.a) = 1
"""


@query("policy_iteration", _vi_sql())
def policy_iteration_q(spark, sf):
    """Policy iteration (evaluate, strict greedy improvement) to a stable policy; best action and value per state."""
    trans, rew = mdp(spark, sf)
    policy, values = sq.policy_iteration(trans, rew, GAMMA)
    return policy.join(values, "s").select("s", F.col("a").cast("int"), rnd("v", 8).alias("v"))


# --- B6 -------------------------------------------------------------------------

EPISODE_SQL = """
WITH ep AS (SELECT user_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, sum(value) AS ret
            FROM events GROUP BY 1, 2),
w AS (SELECT *, row_number() OVER (ORDER BY day, user_id) AS rn,
             avg(ret) OVER (ORDER BY day, user_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS tm,
             round(sum(ret) OVER (ORDER BY day, user_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW), 6)
             / count(*) OVER (ORDER BY day, user_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) AS tm_out FROM ep),
f AS (SELECT min(rn) AS first FROM w WHERE tm >= 200.0)
SELECT user_id, CAST(day AS BIGINT) AS day, round(ret, 6) AS episode_return, tm_out AS trailing_mean,
       CAST(CASE WHEN rn = f.first THEN 1 ELSE 0 END AS INTEGER) AS solved FROM w, f
"""


@query("episode_solved", EPISODE_SQL)
def episode_solved(spark, sf):
    """episode = (user, day); return = summed value; trailing mean of the last <= 100 returns in (day, user)
    order and the first episode reaching 200 (whole-log order by a distributed sort)."""
    e = events(spark, sf).withColumn("day", F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long"))
    ret = sq.episode_returns(e, ["user_id", "day"], "value")
    out = sq.solved_rule(ret, ["day", "user_id"], 100, 200.0)
    return out.select("user_id", "day", rnd("episode_return", 6).alias("episode_return"),
                      (rnd("window_sum", 6) / F.col("window_rows").cast("double")).alias("trailing_mean"),
                      F.col("solved").cast("int"))
