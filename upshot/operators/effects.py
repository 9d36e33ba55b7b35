"""Average treatment effects: Welch difference, CUPED, proportion baselines.

Moments come from one aggregate over the rows, arm by arm; the adjusted
effects follow from the arms' moment matrices, so plain and adjusted effects
share a single read. All statistics are column expressions over one row.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upshot.functions.columns import safe_div
from upshot.functions.dist import normal_two_sided_p, z_critical

RESULT_COLUMNS = ["control_mean", "treatment_mean", "absolute_effect", "relative_effect",
                  "ci_lower", "ci_upper", "std_error"]


def arm_stats(df: DataFrame, outcome: str, treatment: str = "treatment") -> DataFrame:
    """Per arm: non-null count, mean and sample variance of the outcome."""
    y = F.col(outcome).cast("double")
    return (df.groupBy(treatment)
            .agg(F.count(y).alias("n"), F.avg(y).alias("mean"), F.var_samp(y).alias("var")))


def _moments(df: DataFrame, y, treatment: str) -> DataFrame:
    t = F.col(treatment)
    return df.agg(
        F.count(F.when(t == 0, y)).alias("n_c"), F.avg(F.when(t == 0, y)).alias("mu_c"),
        F.var_samp(F.when(t == 0, y)).alias("var_c"),
        F.count(F.when(t == 1, y)).alias("n_t"), F.avg(F.when(t == 1, y)).alias("mu_t"),
        F.var_samp(F.when(t == 1, y)).alias("var_t"))


def _effect_row(moments: DataFrame, alpha: float, metric: str, variant: str, with_p: bool) -> DataFrame:
    z = z_critical(alpha)
    eff = F.col("mu_t") - F.col("mu_c")
    se = F.sqrt(safe_div(F.col("var_c"), F.col("n_c")) + safe_div(F.col("var_t"), F.col("n_t")))
    out = moments.select(
        F.lit(metric).alias("metric"), F.lit(variant).alias("variant"),
        "n_c", "n_t",
        F.col("mu_c").alias("control_mean"), F.col("mu_t").alias("treatment_mean"),
        eff.alias("absolute_effect"),
        F.when(F.col("mu_c") == 0, F.lit(0.0)).otherwise(safe_div(eff, F.col("mu_c"))).alias("relative_effect"),
        (eff - F.lit(z) * se).alias("ci_lower"), (eff + F.lit(z) * se).alias("ci_upper"),
        se.alias("std_error"), safe_div(eff, se).alias("z_stat"))
    out = out.withColumn("significant", F.abs("z_stat") > F.lit(z))
    if with_p:
        out = out.withColumn("p_value", normal_two_sided_p("z_stat"))
    return out


def ate(df: DataFrame, outcome: str, treatment: str = "treatment", alpha: float = 0.05,
        with_p: bool = False, variant: str = "Simple Difference") -> DataFrame:
    """Welch difference in means with a normal-approximation CI (one row)."""
    y = F.col(outcome).cast("double")
    return _effect_row(_moments(df, y, treatment), alpha, outcome, variant, with_p)


def _pairs(d: int) -> list[tuple[int, int]]:
    """Upper triangle of the moment matrix over (outcome, covariates)."""
    return [(i, j) for i in range(d + 1) for j in range(i, d + 1)]


def arm_moments(df: DataFrame, outcome: str, covariates: list[str], treatment: str = "treatment") -> DataFrame:
    """One row per arm: raw outcome moments, and the moment matrix of (outcome, covariates) over complete rows.

    Columns: arm, n, mean, var (outcome as it is), n_x, means (outcome first)
    and moments (population co-moments, upper triangle by rows). One read;
    partial aggregates merge, so the result does not depend on how rows are dealt.
    """
    cols = [F.col(c).cast("double") for c in (outcome, *covariates)]
    complete = cols[0].isNotNull()
    for c in cols[1:]:
        complete = complete & c.isNotNull()
    full = [F.when(complete, c) for c in cols]
    d = len(covariates)
    out = df.groupBy(F.col(treatment).alias("arm")).agg(
        F.count(cols[0]).alias("n"), F.avg(cols[0]).alias("mean"), F.var_samp(cols[0]).alias("var"),
        F.count(full[0]).alias("n_x"), *[F.avg(c).alias(f"_m{i}") for i, c in enumerate(full)],
        *[F.covar_pop(full[i], full[j]).alias(f"_s{i}_{j}") for i, j in _pairs(d)])
    return out.select("arm", "n", "mean", "var", "n_x", F.array(*[f"_m{i}" for i in range(d + 1)]).alias("means"),
                      F.array(*[f"_s{i}_{j}" for i, j in _pairs(d)]).alias("moments"))


class Moments:
    """Moment matrices of the arms on the driver (two small rows), and what follows from them without another read."""

    def __init__(self, rows: list, d: int) -> None:
        self.arms = {}
        for r in rows:
            if r["arm"] is None or not r["n_x"]:
                continue
            cov = np.zeros((d + 1, d + 1))
            for (i, j), v in zip(_pairs(d), r["moments"], strict=True):
                cov[i, j] = cov[j, i] = v
            self.arms[int(r["arm"])] = (r["n_x"], np.array(r["means"], dtype=float), cov)
        self.n, self.means, self.cov = 0, np.zeros(d + 1), np.zeros((d + 1, d + 1))
        for n, means, cov in self.arms.values():     # pooled moments by pairwise merging
            total, gap = self.n + n, means - self.means
            self.cov = (self.cov * self.n + cov * n + np.outer(gap, gap) * self.n * n / total) / total
            self.means = self.means + gap * n / total
            self.n = total

    def theta(self) -> np.ndarray:
        """Pooled OLS slope of the outcome on the covariates (least norm when they are collinear)."""
        return np.linalg.pinv(self.cov[1:, 1:]) @ self.cov[1:, 0]

    def adjusted(self, theta: np.ndarray, centre: np.ndarray) -> dict:
        """n, mean and sample variance of ``y - (x - centre) . theta`` in both arms: var(y) + t'St - 2 t's."""
        found = {}
        for arm, key in ((0, "c"), (1, "t")):
            n, means, cov = self.arms.get(arm, (0, None, None))
            mean = var = None
            if n:
                mean = float(means[0] - (means[1:] - centre) @ theta)
                if n > 1:
                    var = float(max(cov[0, 0] + theta @ cov[1:, 1:] @ theta - 2 * theta @ cov[1:, 0], 0.0) * n / (n - 1))
            found |= {f"n_{key}": n, f"mu_{key}": mean, f"var_{key}": var}
        return found


_MOMENT_ROW = "n_c long, mu_c double, var_c double, n_t long, mu_t double, var_t double"


def _row(df: DataFrame, found: dict) -> DataFrame:
    return df.sparkSession.createDataFrame([tuple(found[k] for k in ("n_c", "mu_c", "var_c", "n_t", "mu_t", "var_t"))], _MOMENT_ROW)


def cuped_theta(df: DataFrame, outcome: str, covariates: list[str], treatment: str = "treatment") -> tuple[np.ndarray, np.ndarray]:
    """Pooled OLS slope of the outcome on centred covariates, and the covariates' means; rows with nulls take no part."""
    treatment = treatment if treatment in df.columns else None
    src = df if treatment else df.withColumn("treatment", F.lit(0))
    m = Moments(arm_moments(src, outcome, covariates, treatment or "treatment").collect(), len(covariates))
    return m.theta(), m.means[1:]


def ate_and_cuped(df: DataFrame, outcome: str, covariates: list[str], treatment: str = "treatment",
                  alpha: float = 0.05, with_p: bool = False, theta_sample: int | None = None,
                  unit: str = "unit_id") -> tuple[DataFrame, DataFrame]:
    """The plain and the variance-reduced effect (one row each) from a single read of the rows.

    The adjusted outcome is never written down: its mean and variance in each
    arm follow from the arm's moment matrix. With ``theta_sample`` the slope
    comes from an exact-size unit-hash sample of that many rows (a second, narrow read).
    """
    rows = arm_moments(df, outcome, covariates, treatment).collect()     # one row per arm
    m = Moments(rows, len(covariates))
    theta, centre = m.theta(), m.means[1:]
    if theta_sample is not None:
        from upshot.operators.segments import sample_n
        theta, centre = cuped_theta(sample_n(df, theta_sample, unit=unit, hash_kind="xxhash"), outcome, covariates, treatment)
    raw = {"n_c": 0, "mu_c": None, "var_c": None, "n_t": 0, "mu_t": None, "var_t": None}
    for r in rows:
        if r["arm"] in (0, 1):
            key = "ct"[int(r["arm"])]
            raw |= {f"n_{key}": r["n"], f"mu_{key}": r["mean"], f"var_{key}": r["var"]}
    return (_effect_row(_row(df, raw), alpha, outcome, "Simple Difference", with_p),
            _effect_row(_row(df, m.adjusted(theta, centre)), alpha, f"{outcome}_cuped", "CUPED Adjusted", with_p))


def cuped(df: DataFrame, outcome: str, covariates: list[str], treatment: str = "treatment",
          alpha: float = 0.05, with_p: bool = False, theta_sample: int | None = None,
          unit: str = "unit_id") -> DataFrame:
    """Variance-reduced effect (one row): theta from all rows or a sample, Welch on the adjusted outcome of all rows."""
    return ate_and_cuped(df, outcome, covariates, treatment, alpha, with_p, theta_sample, unit)[1]


def cuped_single(df: DataFrame, outcome: str, covariate: str, treatment: str = "treatment",
                 alpha: float = 0.05, with_p: bool = False) -> DataFrame:
    """One-covariate CUPED, lazy and in one aggregate: theta and the adjusted moments are expressions of it."""
    x, y, t = F.col(covariate).cast("double"), F.col(outcome).cast("double"), F.col(treatment)
    pair = x.isNotNull() & y.isNotNull()
    aggs = [F.regr_slope(y, x).alias("theta"), F.avg(F.when(pair, x)).alias("mx")]
    for arm, key in ((0, "c"), (1, "t")):
        xa, ya = F.when(pair & (t == arm), x), F.when(pair & (t == arm), y)
        aggs += [F.count(ya).alias(f"n_{key}"), F.avg(ya).alias(f"my_{key}"), F.avg(xa).alias(f"mx_{key}"),
                 F.var_samp(ya).alias(f"vy_{key}"), F.var_samp(xa).alias(f"vx_{key}"), F.covar_samp(xa, ya).alias(f"s_{key}")]
    m, th = df.agg(*aggs), F.col("theta")
    cols = []
    for key in "ct":
        var = F.col(f"vy_{key}") + th * th * F.col(f"vx_{key}") - 2 * th * F.col(f"s_{key}")
        cols += [F.col(f"n_{key}"), (F.col(f"my_{key}") - (F.col(f"mx_{key}") - F.col("mx")) * th).alias(f"mu_{key}"),
                 F.greatest(var, F.lit(0.0)).alias(f"var_{key}")]
    return _effect_row(m.select(*cols), alpha, f"{outcome}_cuped", "CUPED Adjusted", with_p)


def statistics_results(ate_row: DataFrame, cuped_row: DataFrame) -> DataFrame:
    """ATE and CUPED rows side by side with the CI width."""
    cols = ["method", *RESULT_COLUMNS]
    a = ate_row.withColumn("method", F.lit("ATE (Raw)"))
    c = cuped_row.withColumn("method", F.lit("CUPED (Adjusted)"))
    both = a.select(*cols, *(["p_value"] if "p_value" in ate_row.columns else [])).unionByName(
        c.select(*cols, *(["p_value"] if "p_value" in cuped_row.columns else [])))
    return both.withColumn("ci_width", F.col("ci_upper") - F.col("ci_lower"))


def variance_reduction(ate_row: DataFrame, cuped_row: DataFrame) -> DataFrame:
    """``(SE_ate - SE_cuped) / SE_ate`` (a standard-error ratio)."""
    a = ate_row.select(F.col("std_error").alias("se_ate"))
    c = cuped_row.select(F.col("std_error").alias("se_cuped"))
    return a.crossJoin(F.broadcast(c)).withColumn("variance_reduction",
                                     safe_div(F.col("se_ate") - F.col("se_cuped"), F.col("se_ate")))


def baseline_ab(df: DataFrame, outcome: str = "conversion", treatment: str = "treatment",
                z: float = 1.96) -> DataFrame:
    """Per arm: rows, conversions, rate and the normal CI of the rate, plus ATE and relative lift %."""
    y = F.col(outcome).cast("double")
    per_arm = (df.groupBy(treatment)
               .agg(F.count(F.lit(1)).alias("n_obs"), F.sum(y).alias("conversions"),
                    F.avg(y).alias("conversion_rate")))
    per_arm = (per_arm.withColumn("ci_margin", proportion_ci("conversion_rate", "n_obs", z))
               .withColumn("ci_lower", F.col("conversion_rate") - F.col("ci_margin"))
               .withColumn("ci_upper", F.col("conversion_rate") + F.col("ci_margin")))
    lift = per_arm.agg(F.max(F.when(F.col(treatment) == 0, F.col("conversion_rate"))).alias("_cr_c"),
                       F.max(F.when(F.col(treatment) == 1, F.col("conversion_rate"))).alias("_cr_t"))
    lift = lift.select((F.col("_cr_t") - F.col("_cr_c")).alias("ate"),
                       (safe_div(F.col("_cr_t") - F.col("_cr_c"), F.col("_cr_c")) * 100).alias("relative_lift_pct"))
    return per_arm.crossJoin(lift)


def proportion_ci(p, n, z: float = 1.96):
    """Margin ``z*sqrt(p(1-p)/n)`` as a column expression."""
    pc = F.col(p) if isinstance(p, str) else p
    nc = F.col(n) if isinstance(n, str) else n
    return F.lit(z) * F.sqrt(pc * (1 - pc) / nc)


def economics(df: DataFrame, outcome: str = "conversion", treatment: str = "treatment",
              value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """Unit economics and the three baseline-profit variants in one aggregate.

    ``as_run``: mean(y)*value - cost*mean(t) (cost only for treated share);
    ``treat_all_global``: mean(y)*value - cost;
    ``treat_all_arm``: mean(y | treated)*value - cost.
    Incremental profit = treated profit - control revenue.
    """
    y = F.col(outcome).cast("double")
    t = F.col(treatment)
    agg = df.agg(F.avg(y).alias("global_cr"), F.avg(t.cast("double")).alias("treated_share"),
                 F.avg(F.when(t == 1, y)).alias("treatment_cr"), F.avg(F.when(t == 0, y)).alias("control_cr"))
    v, c = F.lit(float(value)), F.lit(float(cost))
    return agg.select(
        "global_cr", "treated_share", "treatment_cr", "control_cr",
        (F.col("global_cr") * v).alias("revenue_per_user"),
        c.alias("cost_per_user"),
        (F.col("global_cr") * v - c).alias("net_profit_per_user"),
        (F.col("global_cr") * v - c * F.col("treated_share")).alias("baseline_profit_as_run"),
        (F.col("global_cr") * v - c).alias("baseline_profit_treat_all_global"),
        (F.col("treatment_cr") * v - c).alias("baseline_profit_treat_all_arm"),
        ((F.col("treatment_cr") * v - c) - F.col("control_cr") * v).alias("incremental_profit_per_user"))


def baseline_profit(df: DataFrame, outcome: str = "conversion", treatment: str = "treatment",
                    value: float = 10.0, cost: float = 0.10, mode: str = "as_run") -> DataFrame:
    col = {"as_run": "baseline_profit_as_run", "treat_all_global": "baseline_profit_treat_all_global",
           "treat_all_arm": "baseline_profit_treat_all_arm"}[mode]
    return economics(df, outcome, treatment, value, cost).select(F.col(col).alias("baseline_profit_per_user"))
