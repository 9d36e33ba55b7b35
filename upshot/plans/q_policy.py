"""Registered queries: replay policies, cost sensitivity, planning grids, KPI measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision
from upshot.operators import effects, policy, segments, validation
from upshot.functions.dist import chi2_1dof_critical
from upshot.plans.catalog import BALANCE_SQL
from upshot.plans.registry import COST, R, SCORED_CTE, VALUE, register, rnd, scored
from upshot.plans.q_segments import CLASSIFIED_CTE, classified
from upshot.sources.experiment import EXPECTED_RATIO, FEATURES, experiment

COSTS = policy.DEFAULT_COSTS
PROFIT = f"CAST(conversion AS DOUBLE) * {VALUE} - treatment * {COST}"
STUDENT = "floor(f0 / 50000) / 10.0 - 0.3"   # a coarse, tie-heavy student score


def _replay_sql(decision: str, cost: float = COST) -> str:
    prof = f"CAST(conversion AS DOUBLE) * {VALUE} - treatment * {cost}"
    return f"avg(CASE WHEN CAST({decision} AS INTEGER) = treatment THEN {prof} END)"


@register("replay_policy_value", SCORED_CTE + f"""
SELECT count(*) AS n, count(CASE WHEN CAST(score * {VALUE} > {COST} AS INTEGER) = treatment THEN 1 END) AS n_matched,
  {R(f"coalesce({_replay_sql(f'score * {VALUE} > {COST}')}, 0.0)")} AS profit_per_user,
  {R(f'avg(CAST(score * {VALUE} > {COST} AS DOUBLE))')} AS bid_rate
FROM scored
""")
def q_replay(spark, sf):
    return rnd(policy.score_policy_value(scored(spark, sf), value=VALUE, cost=COST))


def _cost_sql() -> str:
    rows = []
    for c in COSTS:
        dec = f"score * {VALUE} > {c}"
        rows.append(f"""SELECT {c!r} AS cost_per_ad, {R(f"coalesce({_replay_sql(dec, c)}, 0.0)")} AS profit_per_user,
  count(CASE WHEN CAST({dec} AS INTEGER) = treatment THEN 1 END) AS n_matched,
  {R(f'avg(CAST({dec} AS DOUBLE)) * 100')} AS bid_share_pct FROM scored""")
    return SCORED_CTE + "\nUNION ALL\n".join(rows)


@register("cost_sensitivity", _cost_sql())
def q_costs(spark, sf):
    return rnd(policy.cost_sensitivity(scored(spark, sf), costs=COSTS, value=VALUE), keep=("cost_per_ad",))


POLICIES_SQL = SCORED_CTE + f"""
, th AS (SELECT quantile_cont(score, 0.85) AS thr FROM scored)
, p AS (SELECT s.*, s.treatment = 1 AS d1, s.score >= th.thr AS d2, s.score * {VALUE} > {COST} AS d3, false AS d4
        FROM scored s, th)
"""


def _policy_rows() -> str:
    texts = [(n, d.format(0.15)) for n, d in (policy.AS_LOGGED, policy.TOP_SHARE, policy.WORTH_IT, policy.NOBODY)]
    spec = [(i, n, f"d{i}", d) for i, (n, d) in enumerate(texts, 1)]
    return "\nUNION ALL\n".join(
        f"""SELECT {i} AS policy_id, '{n}' AS policy_name, {R(f"coalesce({_replay_sql(d)}, 0.0)")} AS avg_profit_per_user,
  {R(f'avg(CAST({d} AS DOUBLE)) * 100')} AS bid_rate_pct, '{desc}' AS description FROM p""" for i, n, d, desc in spec)


@register("policy_comparison", POLICIES_SQL + _policy_rows())
def q_policies(spark, sf):
    s = policy.greedy_decision(scored(spark, sf), top=0.15)
    specs = [(1, policy.AS_LOGGED[0], F.col("treatment") == 1, policy.AS_LOGGED[1]),
             (2, policy.TOP_SHARE[0], F.col("greedy_bid"), policy.TOP_SHARE[1].format(0.15)),
             (3, policy.WORTH_IT[0], bid_decision("score", VALUE, COST), policy.WORTH_IT[1]),
             (4, policy.NOBODY[0], F.lit(False), policy.NOBODY[1])]
    return rnd(policy.policy_table(s, specs, value=VALUE, cost=COST))


@register("compare_policies", SCORED_CTE + f"""
, s AS (SELECT *, {STUDENT} AS student FROM scored)
, a AS (SELECT coalesce({_replay_sql(f'score * {VALUE} > {COST}')}, 0.0) AS pt,
               coalesce({_replay_sql(f'student * {VALUE} > {COST}')}, 0.0) AS ps,
               avg(CAST(conversion AS DOUBLE)) * {VALUE} - avg(CAST(treatment AS DOUBLE)) * {COST} AS pb FROM s)
SELECT {R('pt')} AS profit_teacher, {R('ps')} AS profit_student, {R('pb')} AS profit_baseline,
  {R('ps / pt')} AS profit_retention, ps > pb AS go FROM a
""")
def q_compare(spark, sf):
    s = scored(spark, sf).withColumn("student", F.floor(F.col("f0") / 50000) / 10.0 - 0.3)
    return rnd(policy.compare_policies(s, "score", "student", value=VALUE, cost=COST))


_TS = [(j + 1) / 100 for j in range(100)]


def _returns_sql() -> str:
    probs = ", ".join(repr(1.0 - t) for t in _TS)
    ths = ", ".join(repr(t) for t in _TS)
    return SCORED_CTE + f"""
, e AS (SELECT quantile_cont(score, [{probs}]) AS edges, count(*) AS n,
          avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END) AS tcr FROM scored)
, g AS (SELECT j, [{ths}][j] AS threshold, edges[j] AS cate_at, n, tcr FROM e, range(1, 101) t(j))
, a AS (SELECT g.j, avg(s.score) AS cate_avg FROM g JOIN scored s ON s.score >= g.cate_at GROUP BY g.j)
, c AS (SELECT g.*, a.cate_avg, threshold * n AS aud FROM g LEFT JOIN a USING (j))
"""


RETURNS_CTE = _returns_sql()


@register("returns_curve", RETURNS_CTE + f"""
SELECT threshold, {R('aud')} AS audience_size, {R('cate_at')} AS cate_at, {R('cate_avg')} AS cate_avg,
  {R(f'aud * {COST}')} AS projected_cost, {R(f'aud * tcr * (1 + cate_at) * {VALUE}')} AS projected_revenue,
  {R(f'aud * tcr * (1 + cate_at) * {VALUE} - aud * {COST}')} AS net_profit
FROM c
""")
def q_returns(spark, sf):
    return rnd(policy.returns_curve(scored(spark, sf), value=VALUE, cost=COST), keep=("threshold",))


@register("optimal_threshold", RETURNS_CTE + f"""
, r AS (SELECT threshold, aud * tcr * (1 + cate_at) * {VALUE} - aud * {COST} AS net_profit FROM c)
SELECT arg_min(threshold, (-net_profit, threshold)) AS optimal_threshold, {R('max(net_profit)')} AS max_net_profit FROM r
""")
def q_optimal(spark, sf):
    return rnd(policy.optimal_threshold(policy.returns_curve(scored(spark, sf), value=VALUE, cost=COST)),
               keep=("optimal_threshold",))


@register("breakeven_grid", SCORED_CTE + f"""
, u AS (SELECT avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END)
             - avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS avg_uplift FROM scored)
, g AS (SELECT 0.01 + i * {(0.50 - 0.01) / 19!r} AS cost_per_ad, 1.0 + k * {(20.0 - 1.0) / 19!r} AS conversion_value
        FROM range(0, 20) a(i), range(0, 20) b(k))
SELECT {R('cost_per_ad')} AS cost_per_ad, {R('conversion_value')} AS conversion_value, {R('avg_uplift')} AS avg_uplift,
  {R('avg_uplift * conversion_value - cost_per_ad')} AS profit_per_user, avg_uplift * conversion_value - cost_per_ad > 0 AS profitable
FROM g, u
""")
def q_breakeven(spark, sf):
    a = effects.ate(experiment(spark, sf), "conversion").select(F.col("absolute_effect").alias("avg_uplift"))
    return rnd(policy.breakeven_grid(a))


KPI_CTE = CLASSIFIED_CTE + f"""
, k AS (SELECT avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END) AS treatment_cr,
          avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS control_cr, count(*) AS total_users,
          count(CASE WHEN archetype_label = 'Persuadable' THEN 1 END) AS persuadable_count,
          avg(CASE WHEN archetype_label = 'Persuadable' THEN score END) AS avg_cate_persuadables FROM cl)
, k2 AS (SELECT *, total_users * 0.1 AS aud,
           total_users * 0.1 * treatment_cr * (1 + coalesce(avg_cate_persuadables, 0.0)) AS conv FROM k)
"""


@register("kpi_measures", KPI_CTE + f"""
SELECT {R('treatment_cr')} AS treatment_cr, {R('control_cr')} AS control_cr, total_users, persuadable_count,
  {R('avg_cate_persuadables')} AS avg_cate_persuadables,
  {R(f'treatment_cr * {VALUE}')} AS revenue_per_user_treatment, {R(f'control_cr * {VALUE}')} AS revenue_per_user_control,
  {R(f'treatment_cr * {VALUE} - {COST}')} AS net_profit_ab, {R(f'treatment_cr * {VALUE}')} AS break_even_cost,
  {R('persuadable_count / total_users')} AS persuadable_share, {R('aud')} AS projected_audience,
  {R(f'aud * {COST}')} AS projected_cost, {R('conv')} AS projected_conversions, {R(f'conv * {VALUE}')} AS projected_revenue,
  {R(f'conv * {VALUE} - aud * {COST}')} AS projected_net_profit,
  {R(f'CASE WHEN aud * {COST} = 0 THEN NULL ELSE (conv * {VALUE} - aud * {COST}) / (aud * {COST}) END')} AS roi_at_scale,
  {R(f'aud * {COST} / conv')} AS cost_per_conversion
FROM k2
""")
def q_kpis(spark, sf):
    return rnd(policy.kpi_measures(classified(spark, sf), value=VALUE, cost=COST, threshold=0.10))


@register("audience_at_threshold", KPI_CTE + f"""
SELECT share, {R('share * total_users')} AS audience_size,
  {R('share * total_users * treatment_cr * (1 + coalesce(avg_cate_persuadables, 0.0))')} AS projected_conversions
FROM k, (VALUES (0.05), (0.10), (0.15), (0.20)) v(share)
""")
def q_audience(spark, sf):
    k = policy.kpi_measures(classified(spark, sf), value=VALUE, cost=COST)
    return rnd(policy.audience_at_threshold(k), keep=("share",))


@register("scale_projection", SCORED_CTE + f"""
, p AS (SELECT coalesce({_replay_sql(f'score * {VALUE} > {COST}')}, 0.0) AS profit_per_user FROM scored)
SELECT impressions, {R('profit_per_user')} AS profit_per_user, {R('impressions * profit_per_user', 4)} AS projected_profit
FROM p, (VALUES (1000000::BIGINT), (10000000::BIGINT), (100000000::BIGINT)) v(impressions)
""")
def q_scale(spark, sf):
    pv = policy.score_policy_value(scored(spark, sf), value=VALUE, cost=COST)
    out = policy.scale_projection(pv)
    return out.select("impressions", F.col("profit_per_user").cast("decimal(38,6)").cast("double").alias("profit_per_user"),
                      F.col("projected_profit").cast("decimal(38,4)").cast("double").alias("projected_profit"))


@register("budget_allocation", CLASSIFIED_CTE + f"""
, g AS (SELECT archetype_label, count(*) AS cnt, avg(score) AS u FROM cl GROUP BY 1)
, w AS (SELECT archetype_label, greatest(CASE WHEN archetype_label = 'Persuadable' THEN u * {VALUE} - {COST} ELSE 0.0 END, 0.0) * cnt AS weight FROM g)
, t AS (SELECT sum(weight) AS tw FROM w)
SELECT archetype_label, {R('weight')} AS weight, {R('CASE WHEN tw > 0 THEN 50000.0 * weight / tw ELSE 0.0 END')} AS budget FROM w, t
""")
def q_budget(spark, sf):
    summ = segments.archetype_summary(classified(spark, sf), value=VALUE, cost=COST)
    return rnd(policy.budget_allocation(summ, 50000.0))


@register("experiment_health", BALANCE_SQL + f"""
, c AS (SELECT count(CASE WHEN treatment = 0 THEN 1 END) AS nc, count(CASE WHEN treatment = 1 THEN 1 END) AS nt FROM experiment)
, v AS (SELECT power(nc - (nc + nt) * {1 - EXPECTED_RATIO!r}, 2) / ((nc + nt) * {1 - EXPECTED_RATIO!r})
             + power(nt - (nc + nt) * {EXPECTED_RATIO!r}, 2) / ((nc + nt) * {EXPECTED_RATIO!r}) < {chi2_1dof_critical(0.001)!r} AS valid FROM c)
, b AS (SELECT max(abs(smd)) < 0.1 AS bal FROM s)
SELECT CASE WHEN valid THEN 'PASS' ELSE 'FAIL' END AS srm_status, CASE WHEN bal THEN 'PASS' ELSE 'FAIL' END AS balance_status,
  CASE WHEN valid AND bal THEN 'PASS' ELSE 'FAIL' END AS experiment_health FROM v, b
""")
def q_health(spark, sf):
    exp = experiment(spark, sf)
    srm = validation.check_srm(exp, expected_ratio=EXPECTED_RATIO)
    bal = validation.max_abs_smd(validation.covariate_balance(exp, FEATURES))
    return policy.health_status(srm, bal)
