"""Registered bandit queries of two features, whose every round SQL repeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision, unit_uniform_sql
from upshot.operators import bandit, effects, policy
from upshot.plans.bandit_sql import choice, rounds_cte
from upshot.plans.q_policy import KPI_CTE, POLICIES_SQL, _policy_rows, classified
from upshot.plans.registry import COST, R, SCORED_CTE, VALUE, memo, register, rnd, scored

PAIR, ROUNDS, POINTS = ["f0", "f1"], 10, 2000


def _replay(spark, sf):
    def build():
        events = scored(spark, sf)
        agent = bandit.BatchedLinUCB(PAIR, alpha=1.0, value=VALUE, cost=COST)
        stream = agent.prepare(events, n_rounds=ROUNDS, standardize=True, hash_kind="md5")
        return agent.run(stream), stream, events
    return memo(spark, ("linucb-pair", sf), build)


def _recursive(cte: str) -> str:
    return cte.replace("WITH ", "WITH RECURSIVE ", 1)


REPLAY = f"""
, mo AS (SELECT avg(f0) AS m0, stddev_pop(f0) AS s0, avg(f1) AS m1, stddev_pop(f1) AS s1 FROM scored)
, e AS (SELECT unit_id, order_key, least(CAST(floor(order_key * {ROUNDS}) AS INTEGER), {ROUNDS - 1}) AS round, treatment AS arm,
          (f0 - m0) / s0 AS x0, (f1 - m1) / s1 AS x1, conversion * {VALUE} - treatment * {COST} AS r
        FROM (SELECT *, {unit_uniform_sql('unit_id', 42)} AS order_key FROM scored) q, mo)
""" + rounds_cte(ROUNDS) + f"""
, de AS (SELECT e.*, {choice()} AS chosen FROM e JOIN s ON s.round = e.round - 1)
, bl AS (SELECT avg(conversion) * {VALUE} - avg(treatment) * {COST} AS base FROM scored)
"""


@register("linucb_pair", _recursive(SCORED_CTE) + REPLAY + f"""
, f AS (SELECT matched, reward, reward / matched AS av FROM s WHERE round = {ROUNDS - 1})
SELECT matched AS aligned_events, {R('reward')} AS cumulative_reward, {R('av')} AS avg_profit, CAST({ROUNDS} AS BIGINT) AS n_rounds,
  {R('base')} AS baseline_profit_per_user, {R('reward - base * matched')} AS incremental_value,
  {R('(av - base) / abs(base)')} AS relative_gain FROM f, bl
""")
def q_pair(spark, sf):
    agent, _, events = _replay(spark, sf)
    base = effects.baseline_profit(events, value=VALUE, cost=COST).select(F.col("baseline_profit_per_user").alias("_b"))
    s = agent.summary(spark).crossJoin(base)
    s = s.select("*", *policy.incremental_value(F.col("cumulative_reward"), F.col("_b"), F.col("aligned_events")))
    return rnd(s.withColumn("n_rounds", F.col("n_rounds").cast("long")).withColumnRenamed("_b", "baseline_profit_per_user"), 6)


@register("bandit_trajectory_pair", _recursive(SCORED_CTE) + REPLAY + f"""
, t AS (SELECT row_number() OVER w - 1 AS idx, sum(r) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
        FROM de WHERE chosen = arm WINDOW w AS (ORDER BY round, order_key, unit_id))
, n AS (SELECT count(*) AS n FROM t)
, g AS (SELECT DISTINCT (k * (n - 1)) // {POINTS - 1} AS idx FROM n, range({POINTS}) p(k))
SELECT CAST(idx AS INTEGER) AS impression_index, {R('cum', 4)} AS cumulative_profit_bandit,
  {R('(idx + 1) * base', 4)} AS cumulative_profit_baseline, {R('cum - (idx + 1) * base', 4)} AS profit_delta
FROM g JOIN t USING (idx), bl
""")
def q_pair_trajectory(spark, sf):
    agent, stream, events = _replay(spark, sf)
    base = effects.baseline_profit(events, value=VALUE, cost=COST).first()[0]
    return rnd(agent.trajectory(stream, base, n_points=POINTS), 4)


_BANDIT_ROW = f"""SELECT 5 AS policy_id, '{policy.BANDIT[0]}' AS policy_name,
  {R('coalesce(avg(r) FILTER (chosen = arm), 0.0)')} AS avg_profit_per_user, {R('avg(CAST(chosen AS DOUBLE)) * 100')} AS bid_rate_pct,
  '{policy.BANDIT[1]}' AS description FROM de"""


@register("policy_comparison_bandit", _recursive(POLICIES_SQL) + REPLAY + _policy_rows() + "\nUNION ALL\n" + _BANDIT_ROW)
def q_policies_bandit(spark, sf):
    """The policy table with the bandit's replay as its last row."""
    agent, stream, events = _replay(spark, sf)
    s = policy.greedy_decision(events, top=0.15)
    specs = [(1, policy.AS_LOGGED[0], F.col("treatment") == 1, policy.AS_LOGGED[1]),
             (2, policy.TOP_SHARE[0], F.col("greedy_bid"), policy.TOP_SHARE[1].format(0.15)),
             (3, policy.WORTH_IT[0], bid_decision("score", VALUE, COST), policy.WORTH_IT[1]),
             (4, policy.NOBODY[0], F.lit(False), policy.NOBODY[1])]
    table = policy.policy_table(s, specs, value=VALUE, cost=COST)
    return rnd(table.unionByName(agent.policy_row(stream, 5, *policy.BANDIT)))


@register("kpi_bandit", _recursive(KPI_CTE) + REPLAY + f"""
, b AS (SELECT reward / matched AS bp FROM s WHERE round = {ROUNDS - 1})
SELECT {R(f'treatment_cr * {VALUE} - {COST}')} AS net_profit_ab, {R('bp')} AS net_profit_bandit,
  {R(f'bp - (treatment_cr * {VALUE} - {COST})')} AS profit_delta FROM k2, b
""")
def q_kpi_bandit(spark, sf):
    agent, _, _ = _replay(spark, sf)
    profit = agent.summary(spark).first()["avg_profit"]
    k = policy.kpi_measures(classified(spark, sf), value=VALUE, cost=COST, threshold=0.10, bandit_profit=profit)
    return rnd(k.select("net_profit_ab", "net_profit_bandit", "profit_delta"))
