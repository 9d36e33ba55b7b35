"""The end-to-end experiment report: validate, estimate, learn, evaluate, target, monitor, export.

Every report table is a DataFrame built from the experiment; only bounded
artefacts (model coefficients, bandit state) cross to the driver. The scored
test split is checkpointed once to the shared checkpoint folder and feeds all
downstream tables, so model scoring is not recomputed and lineage stays short.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision, unit_uniform
from upshot.functions.materialize import checkpointed
from upshot.operators import bandit, effects, learners, monitor, policy, ranking, segments, validation
from upshot.plans.report_format import format_table
from upshot.session import ensure_checkpoint_dir
from upshot.sources import sinks


@dataclass
class ReportConfig:
    features: list[str]
    value: float = 10.0
    cost: float = 0.10
    expected_ratio: float = 0.85
    train_share: float = 0.8
    seed: int = 1
    n_estimators: int = 100
    max_depth: int = 5
    surrogate_depth: int = 5
    student_depth: int = 5
    bootstraps: int = 20
    bandit_rounds: int = 10
    top_share: float = 0.15
    sample_size: int = 50000
    periods: int = 8
    run_date: str = "1970-01-01"
    quantile_method: str = "exact"     # "approx" = one percentile_approx pass per quantile set
    profile_features: list[str] = field(default_factory=list)


class ExperimentReport:
    """Builds the report tables lazily; ``build()`` materialises the shared scored split once."""

    def __init__(self, spark: SparkSession, experiment: DataFrame, cfg: ReportConfig):
        self.spark, self.exp, self.cfg = spark, experiment, cfg
        ensure_checkpoint_dir(spark)
        train_flag = unit_uniform("unit_id", cfg.seed) < cfg.train_share
        self.train = experiment.where(train_flag)
        self.test = experiment.where(~train_flag)
        self.scored: DataFrame | None = None

    # -- shared artefacts ----------------------------------------------------------
    def build(self) -> "ExperimentReport":
        c = self.cfg
        self.learner = learners.XLearner(c.features, n_estimators=c.n_estimators, max_depth=c.max_depth).fit(self.train)
        scored = self.learner.predict(self.test, "uplift_score", keep_baseline=True)
        self.scored = checkpointed(scored)         # reliable checkpoint: scoring happens once
        # one scan, one materialised row for both integrity checks
        self.srm, self.balance = validation.integrity(self.exp, c.features, expected_ratio=c.expected_ratio)
        self.ate, self.cuped = effects.ate_and_cuped(self.exp, "conversion", c.features, with_p=True)
        self.surrogate = learners.surrogate_tree(self.scored, c.features, max_depth=c.surrogate_depth)
        self.student = learners.Distiller(c.features, "tree", max_depth=c.student_depth).fit(self.scored)
        judged = learners.out_of_fold(self.scored, c.features, "uplift_score", "tree", max_depth=c.student_depth)
        self.student_r2 = learners.regression_fidelity(judged, "uplift_score", "student_score").first()["r2"]
        self.baseline_profit = effects.baseline_profit(self.exp, value=c.value, cost=c.cost).first()[0]
        self.agent = bandit.BatchedLinUCB(c.features, value=c.value, cost=c.cost)
        self.stream = self.agent.prepare(self.scored, n_rounds=c.bandit_rounds, standardize=True)
        self.agent.run(self.stream)
        self.bandit_summary = self.agent.summary(self.spark).first()
        # Sure Thing split: the control conversion rate of the whole experiment (the ATE's control mean)
        control_rate = self.ate.select("control_mean").first()[0]
        self.classified = segments.classify(self.scored, score="uplift_score", control_rate=control_rate)
        if "ts" in self.scored.columns:
            self.periods = monitor.assign_periods(self.scored, "ts", c.periods)
        else:   # no timestamps: equal hash slices
            self.periods = monitor.assign_periods_by_hash(self.scored, "unit_id", c.periods)
        return self

    # -- report tables -----------------------------------------------------------------
    def experiment_summary(self) -> DataFrame:
        s = self.srm.select("n_control", "n_treatment", "n_total", F.col("expected_ratio").alias("traffic_split_expected"),
                            F.col("p_value").alias("srm_p_value"), F.col("valid").cast("int").alias("srm_valid"))
        a = self.ate.select(F.col("control_mean").alias("control_cr"), F.col("treatment_mean").alias("treatment_cr"),
                            F.col("absolute_effect").alias("ate_absolute"), F.col("relative_effect").alias("ate_relative"),
                            F.col("ci_lower").alias("ate_ci_lower"), F.col("ci_upper").alias("ate_ci_upper"),
                            F.col("p_value").alias("ate_p_value"), F.col("std_error").alias("ate_std_error"))
        cu = self.cuped.select(F.col("absolute_effect").alias("cuped_ate_absolute"), F.col("ci_lower").alias("cuped_ci_lower"),
                               F.col("ci_upper").alias("cuped_ci_upper"), F.col("std_error").alias("cuped_std_error"),
                               F.col("p_value").alias("cuped_p_value"))
        m = validation.max_abs_smd(self.balance)
        b = self.bandit_summary
        econ = self.spark.createDataFrame(
            [(self.cfg.run_date, self.cfg.value, self.cfg.cost, float(self.baseline_profit), float(b["avg_profit"]),
              int(b["aligned_events"]), float(self.student_r2))],
            "run_date string, conversion_value double, cost_per_ad double, baseline_profit_per_user double, "
            "bandit_profit_per_user double, bandit_aligned_events long, student_r2 double")
        return sinks.summary_row([econ, s, a, cu, m])

    def covariate_balance(self) -> DataFrame:
        return self.balance.select("feature", "smd", "abs_smd", F.col("is_balanced").cast("tinyint").alias("is_balanced"))

    def statistics_results(self) -> DataFrame:
        return effects.statistics_results(self.ate, self.cuped)

    def decile_stats(self) -> DataFrame:
        d = ranking.decile_stats(self.scored, score="uplift_score", method=self.cfg.quantile_method)
        return d.fillna(0.0, ["mean_y_control", "mean_y_treatment", "actual_lift"])

    def qini_curve_data(self) -> DataFrame:
        return ranking.bootstrap_qini(self.scored, score="uplift_score", n_bootstraps=self.cfg.bootstraps)

    def feature_importance(self) -> DataFrame:
        return learners.feature_importance(self.surrogate, self.cfg.features)

    def tree_rules(self) -> DataFrame:
        return learners.tree_rules(self.surrogate, self.cfg.features)

    def segment_profile(self) -> DataFrame:
        return segments.segment_profile(self.scored, self.cfg.features, score="uplift_score", top=self.cfg.top_share,
                                        method=self.cfg.quantile_method)

    def archetype_summary(self) -> DataFrame:
        return segments.archetype_summary(self.classified, score="uplift_score", value=self.cfg.value, cost=self.cfg.cost)

    def uplift_sample(self) -> DataFrame:
        keep = ["unit_id", "treatment", "conversion", "visit", *self.cfg.profile_features, "uplift_score",
                "baseline_conversion_prob", "archetype_label", "persuadable_flag"]
        # the scored split is already a checkpoint: read it again rather than persist a copy
        return segments.stratified_sample(self.classified.select(*keep), n=self.cfg.sample_size, persist_input=False)

    def policy_comparison(self) -> DataFrame:
        c = self.cfg
        s = policy.greedy_decision(self.scored, "uplift_score", top=c.top_share, method=c.quantile_method)
        specs = [(1, policy.AS_LOGGED[0], F.col("treatment") == 1, policy.AS_LOGGED[1]),
                 (2, policy.TOP_SHARE[0], F.col("greedy_bid"), policy.TOP_SHARE[1].format(c.top_share)),
                 (3, policy.WORTH_IT[0], bid_decision("uplift_score", c.value, c.cost), policy.WORTH_IT[1])]
        table = policy.policy_table(s, specs, value=c.value, cost=c.cost)
        return table.unionByName(self.agent.policy_row(self.stream, 4, *policy.BANDIT))

    def bandit_trajectory(self) -> DataFrame:
        return self.agent.trajectory(self.stream, self.baseline_profit, n_points=2000)

    def distillation_benchmark(self) -> DataFrame:
        c = self.cfg
        return self.spark.createDataFrame(
            [("teacher", "X-learner: five boosted ensembles", None, c.n_estimators, 1.0, 0, "Scores the student is fitted to."),
             ("student", "one decision tree", c.student_depth, 1, float(self.student_r2), 1,
              "Judged on units it was not fitted on.")],
            "model_name string, model_type string, depth int, n_estimators int, fidelity_r2 double, "
            "is_production int, notes string")

    def monitoring_timeseries(self) -> DataFrame:
        return monitor.monitor_periods(self.periods, score="uplift_score", value=self.cfg.value, cost=self.cfg.cost)

    def psi_scores(self) -> DataFrame:
        p = monitor.psi(self.train, self.periods, self.cfg.features, by=["period"], method=self.cfg.quantile_method)
        return p.select(F.col("period").alias("week"), "feature", "psi", "rag_status")

    def drift_simulation(self) -> DataFrame:
        return monitor.drift_sample(self.periods, score="uplift_score").select("week", "uplift_score")

    def segment_rules(self) -> DataFrame:
        """The surrogate tree as indented rule text, one line per row (written as text)."""
        text = learners.rules_text(self.surrogate, self.cfg.features)
        return self.spark.createDataFrame([(line,) for line in text.splitlines()], "value string")

    def segment_dim(self) -> DataFrame:
        return segments.segment_dim(self.segment_profile(), self.feature_importance())

    def tables(self) -> dict:
        names = ["experiment_summary", "bandit_trajectory", "uplift_sample", "decile_stats", "covariate_balance",
                 "statistics_results", "qini_curve_data", "feature_importance", "segment_profile",
                 "policy_comparison", "archetype_summary", "tree_rules", "distillation_benchmark",
                 "monitoring_timeseries", "psi_scores", "drift_simulation"]
        return {n: (lambda n=n: format_table(n, getattr(self, n)())) for n in names}

    def export(self, out_dir: str, fmt: str = "parquet") -> DataFrame:
        if self.scored is None:
            self.build()
        sinks.write_report(self.segment_rules(), f"{out_dir}/segment_rules", "text")
        sinks.write_report(self.segment_dim(), f"{out_dir}/segment_dim", fmt)
        return sinks.export_all(self.spark, self.tables(), out_dir, self.cfg.run_date, fmt)
