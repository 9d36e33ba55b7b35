"""Core registered queries: validation, effects and ranking over the whole driver tables.

Other families live in ``q_*.py``; ``all_queries`` imports them all. See
``registry.py`` for the registry and the shared helpers.

The model-free score used where no learner is involved is
``f0 / 500000.0 - 0.3`` (rank-correct for the planted effect).
"""

from __future__ import annotations

from upshot.functions.dist import chi2_1dof_critical
from upshot.operators import effects, ranking, validation
from upshot.plans.registry import (COST, ORACLE, QUERIES, R, SCORED_CTE, VALUE, Z95, register, rnd,  # noqa: F401
                                   scored)
from upshot.sources.experiment import EXPECTED_RATIO, FEATURES, experiment, experiment_cte

# ----------------------------------------------------------------- validation

SRM_SQL = experiment_cte() + f"""
, c AS (SELECT count(CASE WHEN treatment = 0 THEN 1 END) AS n_control,
               count(CASE WHEN treatment = 1 THEN 1 END) AS n_treatment FROM experiment)
, s AS (SELECT *, n_control + n_treatment AS n_total,
          power(n_control - (n_control + n_treatment) * {1 - EXPECTED_RATIO!r}, 2) / ((n_control + n_treatment) * {1 - EXPECTED_RATIO!r})
        + power(n_treatment - (n_control + n_treatment) * {EXPECTED_RATIO!r}, 2) / ((n_control + n_treatment) * {EXPECTED_RATIO!r}) AS chi2
        FROM c)
"""


@register("srm_check", SRM_SQL + f"""
SELECT n_control, n_treatment, n_total, {EXPECTED_RATIO!r} AS expected_ratio,
  {R('n_treatment / n_total')} AS observed_ratio, {R('chi2')} AS chi2,
  chi2 < {chi2_1dof_critical(0.001)!r} AS valid
FROM s
""")
def q_srm(spark, sf):
    return rnd(validation.check_srm(experiment(spark, sf), expected_ratio=EXPECTED_RATIO, alpha=0.001),
               keep=("expected_ratio",))


def _balance_sql() -> str:
    parts = []
    for i, f in enumerate(FEATURES):
        parts.append(f"""SELECT {i} AS feature_idx, '{f}' AS feature,
  avg(CASE WHEN treatment = 1 THEN {f} END) AS mt, avg(CASE WHEN treatment = 0 THEN {f} END) AS mc,
  var_samp(CASE WHEN treatment = 1 THEN {f} END) AS vt, var_samp(CASE WHEN treatment = 0 THEN {f} END) AS vc
FROM experiment""")
    return experiment_cte() + ", m AS (" + "\nUNION ALL\n".join(parts) + """)
, s AS (SELECT feature_idx, feature,
          CASE WHEN sqrt((vt + vc) / 2) = 0 THEN 0.0 ELSE (mt - mc) / sqrt((vt + vc) / 2) END AS smd FROM m)
"""


BALANCE_SQL = _balance_sql()


@register("covariate_balance", BALANCE_SQL + f"""
SELECT feature_idx, feature, {R('smd')} AS smd, {R('abs(smd)')} AS abs_smd, abs(smd) < 0.1 AS is_balanced FROM s
""")
def q_balance(spark, sf):
    return rnd(validation.covariate_balance(experiment(spark, sf), FEATURES))


@register("max_abs_smd", BALANCE_SQL + f"SELECT {R('max(abs(smd))')} AS max_smd FROM s")
def q_max_smd(spark, sf):
    return rnd(validation.max_abs_smd(validation.covariate_balance(experiment(spark, sf), FEATURES)))


@register("imbalanced_features", BALANCE_SQL + f"""
SELECT feature_idx, feature, {R('smd')} AS smd, {R('abs(smd)')} AS abs_smd, abs(smd) < 0.01 AS is_balanced
FROM s WHERE NOT (abs(smd) < 0.01) ORDER BY abs(smd) DESC, feature LIMIT 5
""")
def q_imbalanced(spark, sf):
    # A strict 0.01 threshold so the fixture has offenders to rank (top-5 is the feature).
    bal = validation.covariate_balance(experiment(spark, sf), FEATURES, threshold=0.01)
    return rnd(validation.imbalanced_features(bal, 5))


# ------------------------------------------------------------------- effects

_MOMENTS_SQL = """
, m AS (SELECT
    count(CASE WHEN treatment = 0 THEN {y} END) AS n_c, avg(CASE WHEN treatment = 0 THEN {y} END) AS mu_c,
    var_samp(CASE WHEN treatment = 0 THEN {y} END) AS var_c,
    count(CASE WHEN treatment = 1 THEN {y} END) AS n_t, avg(CASE WHEN treatment = 1 THEN {y} END) AS mu_t,
    var_samp(CASE WHEN treatment = 1 THEN {y} END) AS var_t
  FROM {src})
, e AS (SELECT *, mu_t - mu_c AS eff, sqrt(var_c / n_c + var_t / n_t) AS se FROM m)
"""


def _effect_select(metric: str, variant: str, d: int = 6) -> str:
    z = repr(Z95)
    return f"""SELECT '{metric}' AS metric, '{variant}' AS variant, n_c, n_t,
  {R('mu_c', d)} AS control_mean, {R('mu_t', d)} AS treatment_mean, {R('eff', d)} AS absolute_effect,
  {R('CASE WHEN mu_c = 0 THEN 0.0 ELSE eff / mu_c END', d)} AS relative_effect,
  {R(f'eff - {z} * se', d)} AS ci_lower, {R(f'eff + {z} * se', d)} AS ci_upper,
  {R('se', d)} AS std_error, {R('eff / se', d)} AS z_stat, abs(eff / se) > {z} AS significant
FROM e"""


@register("ate", experiment_cte() + _MOMENTS_SQL.format(y="CAST(conversion AS DOUBLE)", src="experiment")
          + _effect_select("conversion", "Simple Difference"))
def q_ate(spark, sf):
    return rnd(effects.ate(experiment(spark, sf), "conversion"))


@register("arm_stats", experiment_cte() + f"""
SELECT treatment, count(conversion) AS n, {R('avg(conversion)')} AS mean, {R('var_samp(conversion)')} AS var
FROM experiment GROUP BY treatment
""")
def q_arm_stats(spark, sf):
    return rnd(effects.arm_stats(experiment(spark, sf), "conversion"))


@register("cuped_f1", experiment_cte() + """
, k AS (SELECT regr_slope(CAST(conversion AS DOUBLE), f1) AS theta, avg(f1) AS mx FROM experiment)
, adj AS (SELECT treatment, CAST(conversion AS DOUBLE) - (f1 - mx) * theta AS y FROM experiment, k)
""" + _MOMENTS_SQL.format(y="y", src="adj") + _effect_select("conversion_cuped", "CUPED Adjusted", 6))
def q_cuped_f1(spark, sf):
    return rnd(effects.cuped_single(experiment(spark, sf), "conversion", "f1"), 6)


@register("baseline_ab", experiment_cte() + f"""
, a AS (SELECT treatment, count(*) AS n_obs, sum(conversion) AS conversions,
          avg(CAST(conversion AS DOUBLE)) AS conversion_rate FROM experiment GROUP BY treatment)
, l AS (SELECT max(CASE WHEN treatment = 1 THEN conversion_rate END) - max(CASE WHEN treatment = 0 THEN conversion_rate END) AS ate,
          (max(CASE WHEN treatment = 1 THEN conversion_rate END) - max(CASE WHEN treatment = 0 THEN conversion_rate END))
            / max(CASE WHEN treatment = 0 THEN conversion_rate END) * 100 AS relative_lift_pct FROM a)
SELECT treatment, n_obs, {R('CAST(conversions AS DOUBLE)')} AS conversions, {R('conversion_rate')} AS conversion_rate,
  {R('1.96 * sqrt(conversion_rate * (1 - conversion_rate) / n_obs)')} AS ci_margin,
  {R('conversion_rate - 1.96 * sqrt(conversion_rate * (1 - conversion_rate) / n_obs)')} AS ci_lower,
  {R('conversion_rate + 1.96 * sqrt(conversion_rate * (1 - conversion_rate) / n_obs)')} AS ci_upper,
  {R('ate')} AS ate, {R('relative_lift_pct')} AS relative_lift_pct
FROM a, l
""")
def q_baseline_ab(spark, sf):
    return rnd(effects.baseline_ab(experiment(spark, sf)))


@register("unit_economics", experiment_cte() + f"""
, a AS (SELECT avg(CAST(conversion AS DOUBLE)) AS global_cr, avg(CAST(treatment AS DOUBLE)) AS treated_share,
          avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END) AS treatment_cr,
          avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS control_cr FROM experiment)
SELECT {R('global_cr')} AS global_cr, {R('treated_share')} AS treated_share, {R('treatment_cr')} AS treatment_cr,
  {R('control_cr')} AS control_cr, {R(f'global_cr * {VALUE}')} AS revenue_per_user, {COST} AS cost_per_user,
  {R(f'global_cr * {VALUE} - {COST}')} AS net_profit_per_user,
  {R(f'global_cr * {VALUE} - {COST} * treated_share')} AS baseline_profit_as_run,
  {R(f'global_cr * {VALUE} - {COST}')} AS baseline_profit_treat_all_global,
  {R(f'treatment_cr * {VALUE} - {COST}')} AS baseline_profit_treat_all_arm,
  {R(f'(treatment_cr * {VALUE} - {COST}) - control_cr * {VALUE}')} AS incremental_profit_per_user
FROM a
""")
def q_economics(spark, sf):
    return rnd(effects.economics(experiment(spark, sf), value=VALUE, cost=COST), keep=("cost_per_user",))


# ------------------------------------------------------------------- ranking

@register("decile_stats", SCORED_CTE + f"""
, q AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM scored)
, b AS (SELECT s.*, CAST(len(list_filter(q.edges, lambda e: e < s.score)) + 1 AS INTEGER) AS decile FROM scored s, q)
, g AS (SELECT decile, count(*) AS n_obs,
          count(CASE WHEN treatment = 0 THEN 1 END) AS n_control, count(CASE WHEN treatment = 1 THEN 1 END) AS n_treatment,
          avg(score) AS mean_pred_uplift,
          avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS mean_y_control,
          avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END) AS mean_y_treatment
        FROM b GROUP BY decile)
SELECT decile, n_obs, n_control, n_treatment, {R('mean_pred_uplift')} AS mean_pred_uplift,
  {R('mean_y_control')} AS mean_y_control, {R('mean_y_treatment')} AS mean_y_treatment,
  {R('mean_y_treatment - mean_y_control')} AS actual_lift
FROM g
""")
def q_deciles(spark, sf):
    return rnd(ranking.decile_stats(scored(spark, sf)))


_QINI_ROWS_SQL = SCORED_CTE + """
, r AS (SELECT unit_id, score,
          sum(CAST(conversion AS DOUBLE) * treatment) OVER w AS yt, sum(treatment) OVER w AS nt,
          sum(CAST(conversion AS DOUBLE) * (1 - treatment)) OVER w AS yc, sum(1 - treatment) OVER w AS nc
        FROM scored
        WINDOW w AS (ORDER BY score DESC, unit_id ASC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, c AS (SELECT unit_id, nt + nc - 1 AS idx,
          (yt / greatest(nt, 1) - yc / greatest(nc, 1)) * (nt + nc) AS qini FROM r)
, s AS (SELECT count(*) AS n, sum(qini) AS sq, arg_min(qini, idx) AS q0, arg_max(qini, idx) AS q1 FROM c)
, a AS (SELECT n, CASE WHEN n <= 1 THEN 0.0 ELSE (sq - (q0 + q1) / 2.0) / (n - 1) END AS auuc FROM s)
"""


@register("qini_curve", _QINI_ROWS_SQL + f"""
, g AS (SELECT k AS point, CAST(floor(k * (a.n - 1) / 999) AS BIGINT) AS idx, a.n, a.auuc
        FROM a, range(0, 1000) t(k))
SELECT CAST(g.point AS INTEGER) AS point, g.idx,
  {R('CASE WHEN g.n <= 1 THEN 0.0 ELSE g.idx / (g.n - 1) END')} AS population_pct,
  {R('c.qini')} AS qini, {R('g.auuc')} AS auuc, g.n
FROM g JOIN c ON c.idx = g.idx
""")
def q_qini(spark, sf):
    return rnd(ranking.qini_curve(scored(spark, sf), n_points=1000))


@register("qini_auuc", _QINI_ROWS_SQL + f"SELECT n, {R('auuc')} AS auuc FROM a")
def q_auuc(spark, sf):
    curve = ranking.qini_curve(scored(spark, sf), n_points=1)
    return rnd(curve.select("n", "auuc"))

