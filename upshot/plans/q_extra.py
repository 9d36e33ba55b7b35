"""Registered queries: samples, bands, ROI, model age, sample-size status, segment dimension, random line."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.functions.columns import srm_band, unit_uniform_sql
from upshot.functions.dist import chi2_1dof_critical
from upshot.operators import learners, monitor, policy, ranking, segments, validation
from upshot.plans.catalog import _QINI_ROWS_SQL
from upshot.plans.registry import COST, R, SCORED_CTE, VALUE, register, rnd, scored
from upshot.plans.q_segments import TOP_SHARE
from upshot.sources.experiment import EXPECTED_RATIO, FEATURES, experiment, experiment_cte

SAMPLE_UNITS = 2000


@register("sample_n", experiment_cte() + f"""
SELECT unit_id, treatment, conversion FROM experiment
ORDER BY {unit_uniform_sql('unit_id', 42)}, unit_id LIMIT {SAMPLE_UNITS}
""")
def q_sample_n(spark, sf):
    return segments.sample_n(experiment(spark, sf).select("unit_id", "treatment", "conversion"), SAMPLE_UNITS)


@register("sample_frac", experiment_cte() + f"""
SELECT treatment, count(*) AS n, CAST(sum(conversion) AS BIGINT) AS conversions
FROM experiment WHERE {unit_uniform_sql('unit_id', 7)} < 0.1 GROUP BY treatment
""")
def q_sample_frac(spark, sf):
    s = segments.sample_frac(experiment(spark, sf), 0.1, seed=7)
    return s.groupBy("treatment").agg(F.count(F.lit(1)).alias("n"), F.sum("conversion").cast("long").alias("conversions"))


@register("srm_status_bands", experiment_cte() + f"""
, c AS (SELECT count(CASE WHEN treatment = 0 THEN 1 END) AS nc, count(CASE WHEN treatment = 1 THEN 1 END) AS nt FROM experiment)
, x AS (SELECT nc, nt, power(nc - (nc + nt) * {1 - EXPECTED_RATIO!r}, 2) / ((nc + nt) * {1 - EXPECTED_RATIO!r})
             + power(nt - (nc + nt) * {EXPECTED_RATIO!r}, 2) / ((nc + nt) * {EXPECTED_RATIO!r}) AS chi2 FROM c)
SELECT nc AS n_control, nt AS n_treatment, {R('chi2')} AS chi2,
  CASE WHEN chi2 > {chi2_1dof_critical(0.01)!r} THEN 'RED' WHEN chi2 > {chi2_1dof_critical(0.05)!r} THEN 'AMBER'
       ELSE 'GREEN' END AS srm_band
FROM x
""")
def q_srm_bands(spark, sf):
    """Display bands from the p-value (erfc); the oracle derives them from chi-square critical values."""
    srm = validation.check_srm(experiment(spark, sf), expected_ratio=EXPECTED_RATIO, with_p=True)
    return rnd(srm.select("n_control", "n_treatment", "chi2", srm_band("p_value").alias("srm_band")))


@register("qini_random_line", _QINI_ROWS_SQL + f"""
, g AS (SELECT k AS point, CAST(floor(k * (a.n - 1) / 999) AS BIGINT) AS idx, a.n FROM a, range(0, 1000) t(k))
, l AS (SELECT arg_max(qini, idx) AS q_last FROM c)
SELECT CAST(g.point AS INTEGER) AS point, {R('CASE WHEN g.n <= 1 THEN 0.0 ELSE g.idx / (g.n - 1) END')} AS population_pct,
  {R('c.qini')} AS qini, {R('CASE WHEN g.n <= 1 THEN 0.0 ELSE g.idx / (g.n - 1) END * l.q_last')} AS random_qini
FROM g JOIN c ON c.idx = g.idx, l
""")
def q_random_line(spark, sf):
    curve = ranking.random_line(ranking.qini_curve(scored(spark, sf), n_points=1000))
    return rnd(curve.select("point", "population_pct", "qini", "random_qini"))


@register("roi_calculator", SCORED_CTE + f"""
, th AS (SELECT quantile_cont(score, 0.8) AS thr FROM scored)
, a AS (SELECT count(*) AS total_users,
          avg(CASE WHEN score >= thr AND treatment = 1 THEN CAST(conversion AS DOUBLE) END) AS conversion_rate FROM scored, th)
, b AS (SELECT *, total_users * 0.2 AS aud FROM a)
SELECT 0.2 AS share, {R('aud')} AS audience_size, {R('conversion_rate')} AS conversion_rate,
  {R(f'aud * {COST}')} AS projected_cost, {R(f'aud * conversion_rate * {VALUE}')} AS projected_revenue,
  {R(f'aud * conversion_rate * {VALUE} - aud * {COST}')} AS projected_profit,
  {R(f'CASE WHEN aud * {COST} = 0 THEN 0.0 ELSE (aud * conversion_rate * {VALUE} - aud * {COST}) / (aud * {COST}) * 100 END')} AS roi_pct
FROM b
""")
def q_roi(spark, sf):
    return rnd(policy.roi_from_top_share(scored(spark, sf), share=0.20, value=VALUE, cost=COST), keep=("share",))


RUN_DATE = "2001-06-01"


@register("model_age", experiment_cte() + f"""
SELECT date_diff('day', DATE '{RUN_DATE}', CAST(max(ts) AS DATE)) AS model_age_days,
  date_diff('day', DATE '{RUN_DATE}', CAST(max(ts) AS DATE)) > 30 AS retrain_recommended FROM experiment
""")
def q_model_age(spark, sf):
    today = experiment(spark, sf).agg(F.max(F.col("ts").cast("date")).alias("_today"))
    return today.select(*monitor.model_age(RUN_DATE, F.col("_today")))


@register("sample_size_status", experiment_cte() + """
SELECT count(CASE WHEN treatment = 0 THEN 1 END) AS n_control, count(CASE WHEN treatment = 1 THEN 1 END) AS n_treatment,
  1000 AS min_n,
  CASE WHEN count(CASE WHEN treatment = 0 THEN 1 END) >= 1000 AND count(CASE WHEN treatment = 1 THEN 1 END) >= 1000
       THEN 'GREEN' ELSE 'RED' END AS sample_size_status
FROM experiment
""")
def q_sample_status(spark, sf):
    return policy.sample_size_status(experiment(spark, sf), min_n=1000)


@register("segment_dim")
def q_segment_dim(spark, sf):
    rows = scored(spark, sf)
    tree = learners.surrogate_tree(rows, FEATURES, score="score", max_depth=5)
    prof = segments.segment_profile(rows, FEATURES, top=TOP_SHARE)
    return rnd(segments.segment_dim(prof, learners.feature_importance(tree, FEATURES)))


@register("qini_tie_aware", experiment_cte() + f"""
, s AS (SELECT floor(f0 / 50000) / 10.0 - 0.3 AS score, treatment, CAST(conversion AS DOUBLE) AS y FROM experiment)
, per AS (SELECT score, sum(y * treatment) AS yt, CAST(sum(treatment) AS BIGINT) AS nt,
            sum(y * (1 - treatment)) AS yc, CAST(sum(1 - treatment) AS BIGINT) AS nc FROM s GROUP BY score)
, cum AS (SELECT score, sum(yt) OVER w AS yt, sum(nt) OVER w AS nt, sum(yc) OVER w AS yc, sum(nc) OVER w AS nc
          FROM per WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, tot AS (SELECT sum(nt) + sum(nc) AS n FROM per)
, pts AS (SELECT score, CAST(nt + nc AS BIGINT) AS n_cum, (nt + nc) / n AS population_pct,
            (yt / greatest(nt, 1) - yc / greatest(nc, 1)) * (nt + nc) AS qini FROM cum, tot)
, lg AS (SELECT *, coalesce(lag(population_pct) OVER (ORDER BY score DESC), 0.0) AS px,
            coalesce(lag(qini) OVER (ORDER BY score DESC), 0.0) AS py FROM pts)
, ar AS (SELECT sum((population_pct - px) * (qini + py) / 2) AS auuc FROM lg)
SELECT score, n_cum, {R('population_pct')} AS population_pct, {R('qini')} AS qini, {R('auuc')} AS auuc FROM pts, ar
""")
def q_qini_ties(spark, sf):
    s = experiment(spark, sf).withColumn("score", F.floor(F.col("f0") / 50000) / 10.0 - 0.3)
    return rnd(ranking.qini_tie_aware(s), keep=("score",))
