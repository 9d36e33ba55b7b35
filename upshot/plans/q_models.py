"""Registered queries without a SQL oracle: learners, trees, distillation, bandit, bootstrap, p-values.

Plus the two effect summaries that combine ATE and CUPED rows (those keep an oracle).
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from upshot.functions.materialize import checkpointed
from upshot.functions.columns import unit_uniform_sql
from upshot.functions.dist import chi2_1dof_critical, chi2_1dof_p_sql, normal_two_sided_p_sql, poisson_quantile_sql
from upshot.operators import bandit, effects, learners, policy, ranking, segments, validation
from upshot.plans.catalog import _MOMENTS_SQL, SRM_SQL, _effect_select
from upshot.plans.registry import COST, R, SCORED_CTE, VALUE, memo, register, rnd, scored, with_p
from upshot.plans.q_segments import SPLIT_SQL, split_flag
from upshot.session import scratch_path
from upshot.sources.experiment import EXPECTED_RATIO, FEATURES, experiment, experiment_cte

GBT = dict(n_estimators=100, max_depth=5)


def _split(spark, sf):
    s = scored(spark, sf)
    return s.where(split_flag()), s.where(~split_flag())


_CUPED_MOMENTS = """
, mc AS (SELECT
    count(CASE WHEN treatment = 0 THEN y END) AS n_c, avg(CASE WHEN treatment = 0 THEN y END) AS mu_c,
    var_samp(CASE WHEN treatment = 0 THEN y END) AS var_c,
    count(CASE WHEN treatment = 1 THEN y END) AS n_t, avg(CASE WHEN treatment = 1 THEN y END) AS mu_t,
    var_samp(CASE WHEN treatment = 1 THEN y END) AS var_t
  FROM adj)
, ec AS (SELECT *, mu_t - mu_c AS eff, sqrt(var_c / n_c + var_t / n_t) AS se FROM mc)
"""

_ATE_CUPED_SQL = experiment_cte() + """
, k AS (SELECT regr_slope(CAST(conversion AS DOUBLE), f1) AS theta, avg(f1) AS mx FROM experiment)
, adj AS (SELECT treatment, CAST(conversion AS DOUBLE) - (f1 - mx) * theta AS y FROM experiment, k)
""" + _CUPED_MOMENTS + _MOMENTS_SQL.format(y="CAST(conversion AS DOUBLE)", src="experiment")


@register("statistics_results", _ATE_CUPED_SQL + f"""
, ab AS (SELECT 'ATE (Raw)' AS method, mu_c, mu_t, eff, se FROM e
           UNION ALL SELECT 'CUPED (Adjusted)', mu_c, mu_t, eff, se FROM ec)
SELECT method, {R('mu_c', 6)} AS control_mean, {R('mu_t', 6)} AS treatment_mean, {R('eff', 6)} AS absolute_effect,
  {R('CASE WHEN mu_c = 0 THEN 0.0 ELSE eff / mu_c END', 6)} AS relative_effect,
  {R('eff - 1.959963984540054 * se', 6)} AS ci_lower, {R('eff + 1.959963984540054 * se', 6)} AS ci_upper,
  {R('se', 6)} AS std_error, {R('2 * 1.959963984540054 * se', 6)} AS ci_width
FROM ab
""")
def q_stats_results(spark, sf):
    return rnd(effects.statistics_results(*effects.ate_and_cuped(experiment(spark, sf), "conversion", ["f1"])), 6)


@register("variance_reduction", _ATE_CUPED_SQL + f"""
SELECT {R('e.se', 6)} AS se_ate, {R('ec.se', 6)} AS se_cuped, {R('(e.se - ec.se) / e.se', 6)} AS variance_reduction FROM e, ec
""")
def q_var_red(spark, sf):
    return rnd(effects.variance_reduction(*effects.ate_and_cuped(experiment(spark, sf), "conversion", ["f1"])), 6)


def _normal_equations_sql(y: str, source: str, name: str = "") -> str:
    """CTEs that solve the normal equations of all features by elimination; the last, ``e6``, holds a{i}_6, m{i} and my."""
    d = len(FEATURES)
    first = [f"covar_pop({a}, {b}) AS a{i}_{j}" for i, a in enumerate(FEATURES) for j, b in enumerate([*FEATURES, y])]
    means = [f"avg({f}) AS m{i}" for i, f in enumerate(FEATURES)] + [f"avg({y}) AS my"]
    parts = [f", {name}e0 AS (SELECT {', '.join(first + means)} FROM {source})"]
    for p in range(d):
        cells = [f"a{p}_{j} / a{p}_{p} AS a{i}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * a{p}_{j} / a{p}_{p} AS a{i}_{j}"
                 for i in range(d) for j in range(d + 1)]
        parts.append(f", {name}e{p + 1} AS (SELECT {', '.join(cells)}, {', '.join(f'm{i}' for i in range(d))}, my FROM {name}e{p})")
    return "\n".join(parts)


def _adjusted_sql() -> str:
    d, y = len(FEATURES), "CAST(conversion AS DOUBLE)"
    shift = " - ".join(f"({f} - m{i}) * a{i}_{d}" for i, f in enumerate(FEATURES))
    return _normal_equations_sql(y, "experiment") + f"\n, adj AS (SELECT treatment, {y} - {shift} AS y FROM experiment, e{d})\n"


def _with_p_sql(moments: str, select: str) -> str:
    """An effect row's SQL with the two-sided p-value of its z statistic."""
    body = select.removesuffix("FROM e")
    return moments + ", z AS (SELECT *, eff / se AS zz FROM e)\n" + body + f", {R(normal_two_sided_p_sql('zz'), 12)} AS p_value FROM z"


@register("cuped_all_features", experiment_cte() + _adjusted_sql() + _with_p_sql(
    _MOMENTS_SQL.format(y="y", src="adj"), _effect_select("conversion_cuped", "CUPED Adjusted")))
def q_cuped_all(spark, sf):
    return with_p(effects.cuped(experiment(spark, sf), "conversion", FEATURES, with_p=True))


@register("ate_pvalue", experiment_cte() + _with_p_sql(
    _MOMENTS_SQL.format(y="CAST(conversion AS DOUBLE)", src="experiment"), _effect_select("conversion", "Simple Difference")))
def q_ate_p(spark, sf):
    return with_p(effects.ate(experiment(spark, sf), "conversion", with_p=True))


@register("srm_pvalue", SRM_SQL + f"""
SELECT n_control, n_treatment, n_total, {EXPECTED_RATIO!r} AS expected_ratio,
  {R('n_treatment / n_total')} AS observed_ratio, {R('chi2')} AS chi2,
  chi2 < {chi2_1dof_critical(0.001)!r} AS valid, {R(chi2_1dof_p_sql('chi2'), 12)} AS p_value
FROM s
""")
def q_srm_p(spark, sf):
    return with_p(validation.check_srm(experiment(spark, sf), expected_ratio=EXPECTED_RATIO, with_p=True), keep=("expected_ratio",))


BOOT = dict(n_bootstraps=20, n_points=1000, n_buckets=200)


def _bootstrap_sql(n_bootstraps: int, n_points: int, n_buckets: int, seed: int = 42) -> str:
    probs = ", ".join(repr(i / n_buckets) for i in range(1, n_buckets))
    u = unit_uniform_sql("(bucket || ':' || arm || ':' || y || ':' || b)", seed) + f" + {0.5 ** 53!r}"
    point = "CASE WHEN g = 0 THEN {'x': x, 'y': y} END IGNORE NULLS"
    return SCORED_CTE + f"""
, ed AS (SELECT quantile_cont(score, [{probs}]) AS edges FROM scored)
, cells AS (SELECT {n_buckets} - len(list_filter(edges, lambda e: e < score)) AS bucket, treatment AS arm,
              CAST(conversion AS DOUBLE) AS y, count(*) AS n FROM scored, ed GROUP BY ALL)
, dr AS (SELECT *, {poisson_quantile_sql('n', 'u')} AS w FROM (SELECT c.*, r.b, {u} AS u FROM cells c, range({n_bootstraps}) r(b)))
, ag AS (SELECT b, bucket, sum(w * y * arm) AS yt, sum(w * arm) AS nt, sum(w * y * (1 - arm)) AS yc, sum(w * (1 - arm)) AS nc
         FROM dr WHERE w > 0 GROUP BY b, bucket)
, cm AS (SELECT b, bucket, sum(yt) OVER c AS yt, sum(nt) OVER c AS nt, sum(yc) OVER c AS yc, sum(nc) OVER c AS nc
         FROM ag WINDOW c AS (PARTITION BY b ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
, pt AS (SELECT b, bucket, CAST(nt + nc AS DOUBLE) / max(nt + nc) OVER (PARTITION BY b) AS x,
           (yt / greatest(nt, 1) - yc / greatest(nc, 1)) * (nt + nc) AS y FROM cm
         UNION ALL SELECT DISTINCT b, 0, 0.0::DOUBLE, 0.0::DOUBLE FROM cm)
, sg AS (SELECT *, lag(x) OVER s AS px, lag(y) OVER s AS py FROM pt WINDOW s AS (PARTITION BY b ORDER BY x, bucket))
, st AS (SELECT avg(auuc) AS auuc_mean, stddev_pop(auuc) AS auuc_std
         FROM (SELECT b, sum(coalesce((x - px) * (y + py) / 2, 0.0)) AS auuc FROM sg GROUP BY b))
, mg AS (SELECT b, x, y, 0 AS g, NULL AS point FROM pt
         UNION ALL SELECT b, CAST(point AS DOUBLE) / {n_points - 1}, NULL, 1, point
         FROM range({n_points}) p(point), (SELECT DISTINCT b FROM pt))
, ip AS (SELECT b, x, g, point,
           last_value({point}) OVER (PARTITION BY b ORDER BY x, g ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l,
           first_value({point}) OVER (PARTITION BY b ORDER BY x, g ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS r FROM mg)
, cu AS (SELECT point, x, CASE WHEN r IS NULL THEN l.y WHEN l IS NULL THEN r.y WHEN r.x = l.x THEN l.y
                          ELSE l.y + (r.y - l.y) * (x - l.x) / (r.x - l.x) END AS y FROM ip WHERE g = 1)
SELECT point, {R('x')} AS population_pct, {R('avg(y)')} AS y_mean, {R('quantile_cont(y, 0.025)')} AS y_lower_95ci,
  {R('quantile_cont(y, 0.975)')} AS y_upper_95ci, {R('auuc_mean')} AS auuc_mean, {R('auuc_std')} AS auuc_std
FROM cu, st GROUP BY point, x, st.auuc_mean, st.auuc_std
"""


@register("bootstrap_qini", _bootstrap_sql(**BOOT))
def q_bootstrap(spark, sf):
    return rnd(ranking.bootstrap_qini(scored(spark, sf), **BOOT), 6)


@register("tlearner_deciles")
def q_tlearner(spark, sf):
    train, test = _split(spark, sf)
    m = learners.TLearner(FEATURES, **GBT).fit(train)
    scored_test = checkpointed(m.predict(test, "cate"))   # scoring runs once for the quantile passes
    return rnd(ranking.decile_stats(scored_test, score="cate"), 6)


def _xlearner_scored(spark, sf):
    def build():
        train, test = _split(spark, sf)
        m = learners.XLearner(FEATURES, **GBT).fit(train)
        return m, checkpointed(m.predict(test, "uplift_score", keep_baseline=True))  # scored once, read by every pass
    return memo(spark, ("xlearner", sf), build)   # trained once per application for the three queries using it


@register("xlearner_deciles")
def q_xlearner(spark, sf):
    _, s = _xlearner_scored(spark, sf)
    return rnd(ranking.decile_stats(s, score="uplift_score"), 6)


@register("propensity_by_arm")
def q_propensity(spark, sf):
    train, test = _split(spark, sf)
    p = learners.PropensityModel(FEATURES, **GBT).fit(train).predict(test)
    return rnd(p.groupBy("treatment").agg(F.avg("propensity").alias("mean_propensity"),
                                          F.count(F.lit(1)).alias("n")), 6)


def _surrogate(spark, sf, depth=5):
    def build():
        return learners.surrogate_tree(scored(spark, sf), FEATURES, score="score", max_depth=depth, min_samples_leaf=50)
    return memo(spark, ("surrogate", sf, depth), build)


@register("surrogate_tree_rules")
def q_tree_rules(spark, sf):
    return rnd(learners.tree_rules(_surrogate(spark, sf), FEATURES), 6)


@register("feature_importance")
def q_importance(spark, sf):
    return rnd(learners.feature_importance(_surrogate(spark, sf), FEATURES), 6)


@register("segment_rules_text")
def q_rules_text(spark, sf):
    text = learners.rules_text(_surrogate(spark, sf, depth=3), FEATURES)
    return spark.createDataFrame([(line,) for line in text.splitlines()], "rule string")


@register("distillation_fidelity")
def q_distill(spark, sf):
    """Students judged on the units of the fold they were not fitted on."""
    _, s = _xlearner_scored(spark, sf)
    rows = []
    for kind in ("tree", "linear"):
        judged = learners.out_of_fold(s, FEATURES, "uplift_score", kind, max_depth=5)
        rows.append(learners.regression_fidelity(judged, "uplift_score", "student_score").select(F.lit(kind).alias("student_type"), "*"))
    return rnd(rows[0].unionByName(rows[1]), 6)


TEACHER = "CASE WHEN f0 > 250000 THEN 0.10 WHEN f0 <= 50000 THEN -0.04 ELSE f1 / 100000.0 END"


def _distil_linear_sql(folds: int = 2) -> str:
    """A linear student by the normal equations of the other fold, scored on its own."""
    fold = f"least(CAST(floor({unit_uniform_sql('unit_id', 5)} * {folds}) AS INTEGER), {folds - 1})"
    parts = [f", d AS (SELECT *, {TEACHER} AS teacher, {fold} AS fold FROM experiment)"]
    scored = []
    for k in range(folds):
        parts.append(_normal_equations_sql("teacher", f"(SELECT * FROM d WHERE fold <> {k})", f"k{k}_"))
        line = " + ".join(f"({f} - m{i}) * a{i}_{len(FEATURES)}" for i, f in enumerate(FEATURES))
        scored.append(f"SELECT teacher, my + {line} AS student FROM d, k{k}_e{len(FEATURES)} WHERE fold = {k}")
    return "\n".join(parts) + f"""
, s AS ({' UNION ALL '.join(scored)})
SELECT {R('1 - sum((teacher - student) * (teacher - student)) / (var_pop(teacher) * count(*))')} AS r2,
  {R('sqrt(sum((teacher - student) * (teacher - student)) / count(*))')} AS rmse, count(*) AS n FROM s
"""


@register("distillation_linear", experiment_cte() + _distil_linear_sql())
def q_distil_linear(spark, sf):
    """Out-of-fold fidelity of a linear student to a teacher that is known in closed form."""
    rows = experiment(spark, sf).withColumn("teacher", F.expr(TEACHER))
    judged = learners.out_of_fold(rows, FEATURES, "teacher", "linear")
    return rnd(learners.regression_fidelity(judged, "teacher", "student_score"), 6)


@register("model_roundtrip", SCORED_CTE + f"""
SELECT count(*) AS n, 0 AS n_changed, 0.0::DOUBLE AS max_change FROM scored WHERE NOT ({SPLIT_SQL})
""")
def q_roundtrip(spark, sf):
    """The trained learner saved as a pipeline, loaded again, and scored: no unit may change."""
    model, s = _xlearner_scored(spark, sf)
    path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    stage = learners.UpliftModel(model).setParams(predictionCol="again")
    PipelineModel([stage]).write().overwrite().save(path)
    change = F.abs(F.col("again") - F.col("uplift_score"))
    return PipelineModel.load(path).transform(s).agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(change > 0, 1)).cast("int").alias("n_changed"), F.max(change).alias("max_change"))


@register("leaf_rules_checked", SCORED_CTE + f"""
SELECT count(*) AS n_rows, count(*) AS n_trained, count(*) AS n_by_model, count(*) AS n_by_rule, 0 AS leaves_off,
  {R('avg(score)')} AS mean_score FROM scored
""")
def q_leaf_rules(spark, sf):
    """Leaves of the surrogate tree recounted on all rows, by the model and by the rules' predicates."""
    rows = scored(spark, sf)
    leaves = learners.leaf_check(_surrogate(spark, sf), rows, FEATURES, "score")
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1e-9
    good = F.coalesce((F.col("n_samples") == F.col("n_rule")) & (F.col("n_model") == F.col("n_rule"))
                      & near("mean_model", "mean_rule") & near("predicted", "mean_rule"), F.lit(False))
    total = F.sum("n_rule")
    return rnd(leaves.agg(total.alias("n_rows"), F.sum("n_samples").alias("n_trained"), F.sum("n_model").alias("n_by_model"),
                          F.sum("n_rule").alias("n_by_rule"), F.count(F.when(~good, 1)).cast("int").alias("leaves_off"),
                          (F.sum(F.col("mean_rule") * F.col("n_rule")) / total).alias("mean_score")))


@register("score_and_bid")
def q_score_bid(spark, sf):
    rows = scored(spark, sf)
    student = learners.Distiller(FEATURES, "tree", max_depth=5).fit(rows, "score")
    out = learners.score_and_bid(rows, student, VALUE, COST)
    return rnd(out.groupBy("decision", "uplift_band").agg(F.count(F.lit(1)).alias("n"),
                                                          F.avg("expected_profit").alias("avg_expected_profit")), 6)


@register("score_and_bid_linear", SCORED_CTE + f"""
SELECT CASE WHEN score * {VALUE} - {COST} > 0 THEN 'BID' ELSE 'NO BID' END AS decision,
  CASE WHEN score > 0.05 THEN 'High Persuadability' ELSE 'Low Persuadability' END AS uplift_band, count(*) AS n,
  {R(f'avg(score * {VALUE} - {COST})')} AS avg_expected_profit FROM scored GROUP BY 1, 2
""")
def q_score_bid_linear(spark, sf):
    """The same with a linear student: the score is linear, so SQL knows what the student says."""
    rows = scored(spark, sf)
    out = learners.score_and_bid(rows, learners.Distiller(["f0"], "linear").fit(rows, "score"), VALUE, COST)
    return rnd(out.groupBy("decision", "uplift_band").agg(F.count(F.lit(1)).alias("n"),
                                                          F.avg("expected_profit").alias("avg_expected_profit")), 6)


def _bandit(spark, sf):
    def build():
        events = scored(spark, sf)
        agent = bandit.BatchedLinUCB(FEATURES, alpha=1.0, value=VALUE, cost=COST)
        stream = agent.prepare(events, n_rounds=10, standardize=True)
        return agent.run(stream), stream, events
    return memo(spark, ("linucb", sf), build)


@register("linucb_replay")
def q_linucb(spark, sf):
    agent, _, events = _bandit(spark, sf)
    base = effects.baseline_profit(events, value=VALUE, cost=COST).select(F.col("baseline_profit_per_user").alias("_b"))
    s = agent.summary(spark).crossJoin(base)
    s = s.select("*", *policy.incremental_value(F.col("cumulative_reward"), F.col("_b"),
                                                F.col("aligned_events"))).withColumnRenamed("_b", "baseline_profit_per_user")
    return rnd(s, 6)


@register("bandit_trajectory")
def q_trajectory(spark, sf):
    agent, stream, events = _bandit(spark, sf)
    base = effects.baseline_profit(events, value=VALUE, cost=COST).first()[0]
    return rnd(agent.trajectory(stream, base, n_points=2000), 4)


@register("uplift_archetypes_model")
def q_arch_model(spark, sf):
    _, s = _xlearner_scored(spark, sf)
    control_rate = effects.ate(experiment(spark, sf), "conversion").select("control_mean").first()[0]
    c = segments.classify(s, score="uplift_score", control_rate=control_rate)
    return rnd(segments.archetype_summary(c, score="uplift_score", value=VALUE, cost=COST), 6)
