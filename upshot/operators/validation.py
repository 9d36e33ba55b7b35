"""Experiment integrity: sample-ratio mismatch and covariate balance.

Both are single-pass global aggregates: partial aggregation on every
executor, one row through the final exchange; no shuffle of base rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upshot.functions.columns import safe_div
from upshot.functions.dist import chi2_1dof_critical, chi2_1dof_p

BALANCE_THRESHOLD = 0.1


def discover_features(df: DataFrame, prefix: str = "f") -> list[str]:
    """Columns whose name starts with ``prefix`` (the reference's covariate rule)."""
    return [c for c in df.columns if c.startswith(prefix)]


class SampleRatioMismatch(ValueError):
    """Raised by ``check_srm(on_fail="raise")`` when the arm split fails the test."""


def check_srm(df: DataFrame, treatment: str = "treatment", expected_ratio: float = 0.85,
              alpha: float = 0.001, with_p: bool = False, on_fail: str = "warn") -> DataFrame:
    """Chi-square goodness of fit of arm counts against ``[N(1-r), N r]``.

    ``valid`` is ``p > alpha``, decided as ``chi2 < critical(alpha)`` so the
    verdict stays a column comparison; ``with_p`` adds the p-value itself.
    ``on_fail="warn"`` returns the verdict row (lazy); ``"raise"`` evaluates the
    one-row result now and raises ``SampleRatioMismatch`` when it is invalid.
    """
    if on_fail not in ("warn", "raise"):
        raise ValueError("on_fail must be 'warn' or 'raise'")
    out = _srm(df, treatment, expected_ratio, alpha, with_p)
    if on_fail == "raise":
        row = out.first()
        if not row["valid"]:
            raise SampleRatioMismatch(
                f"SRM detected: control={row['n_control']} treatment={row['n_treatment']} "
                f"chi2={row['chi2']:.4f} (expected treated share {expected_ratio})")
    return out


def _srm(df: DataFrame, treatment: str, expected_ratio: float, alpha: float, with_p: bool) -> DataFrame:
    t = F.col(treatment)
    counts = df.agg(F.count(F.when(t == 0, 1)).alias("n_control"),
                    F.count(F.when(t == 1, 1)).alias("n_treatment"))
    n = F.col("n_control") + F.col("n_treatment")
    e_c = n.cast("double") * F.lit(1.0 - expected_ratio)
    e_t = n.cast("double") * F.lit(expected_ratio)
    chi2 = (F.pow(F.col("n_control") - e_c, 2) / e_c + F.pow(F.col("n_treatment") - e_t, 2) / e_t)
    out = counts.select(
        "n_control", "n_treatment", n.alias("n_total"),
        F.lit(float(expected_ratio)).alias("expected_ratio"),
        safe_div(F.col("n_treatment"), n).alias("observed_ratio"),
        chi2.alias("chi2"))
    out = out.withColumn("valid", F.col("chi2") < F.lit(chi2_1dof_critical(alpha)))
    if with_p:
        out = out.withColumn("p_value", chi2_1dof_p("chi2"))
    return out


def covariate_balance(df: DataFrame, features: list[str], treatment: str = "treatment",
                      threshold: float = BALANCE_THRESHOLD) -> DataFrame:
    """Standardised mean difference per feature: ``(mt-mc)/sqrt((vt+vc)/2)``, 0 if pooled std is 0.

    One wide aggregate (4 moments per feature, filtered by arm), then a stack
    to one row per feature.
    """
    t = F.col(treatment)
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.avg(F.when(t == 1, x)).alias(f"{f}__mt"), F.avg(F.when(t == 0, x)).alias(f"{f}__mc"),
                 F.var_samp(F.when(t == 1, x)).alias(f"{f}__vt"), F.var_samp(F.when(t == 0, x)).alias(f"{f}__vc")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature_idx"), F.lit(f).alias("feature"),
                 F.col(f"{f}__mt").alias("mt"), F.col(f"{f}__mc").alias("mc"),
                 F.col(f"{f}__vt").alias("vt"), F.col(f"{f}__vc").alias("vc"))
        for i, f in enumerate(features)])).alias("r")
    long = wide.select(rows).select("r.*")
    pooled = F.sqrt((F.col("vt") + F.col("vc")) / 2.0)
    smd = F.when(pooled == 0, F.lit(0.0)).otherwise((F.col("mt") - F.col("mc")) / pooled)
    return (long.select("feature_idx", "feature", smd.alias("smd"))
            .withColumn("abs_smd", F.abs("smd"))
            .withColumn("is_balanced", F.col("abs_smd") < F.lit(threshold)))


def max_abs_smd(balance: DataFrame) -> DataFrame:
    return balance.agg(F.max(F.abs("smd")).alias("max_smd"))


def imbalanced_features(balance: DataFrame, k: int = 5) -> DataFrame:
    """Features failing the balance check, largest absolute SMD first, top ``k``."""
    return (balance.where(~F.col("is_balanced"))
            .orderBy(F.desc(F.abs("smd")), F.asc("feature")).limit(k))


def integrity(df: DataFrame, features: list[str], treatment: str = "treatment", expected_ratio: float = 0.85,
              alpha: float = 0.001, with_p: bool = True, threshold: float = BALANCE_THRESHOLD):
    """SRM verdict and covariate balance from ONE scan: arm counts and per-feature moments are a
    single aggregate, materialised once (one row), and both results are derived from it."""
    from upshot.functions.materialize import small
    t = F.col(treatment)
    aggs = [F.count(F.when(t == 0, 1)).alias("n_control"), F.count(F.when(t == 1, 1)).alias("n_treatment")]
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.avg(F.when(t == 1, x)).alias(f"{f}__mt"), F.avg(F.when(t == 0, x)).alias(f"{f}__mc"),
                 F.var_samp(F.when(t == 1, x)).alias(f"{f}__vt"), F.var_samp(F.when(t == 0, x)).alias(f"{f}__vc")]
    one = small(df.agg(*aggs), 1)
    n = F.col("n_control") + F.col("n_treatment")
    e_c = n.cast("double") * F.lit(1.0 - expected_ratio)
    e_t = n.cast("double") * F.lit(expected_ratio)
    chi2 = F.pow(F.col("n_control") - e_c, 2) / e_c + F.pow(F.col("n_treatment") - e_t, 2) / e_t
    srm = one.select("n_control", "n_treatment", n.alias("n_total"),
                     F.lit(float(expected_ratio)).alias("expected_ratio"),
                     safe_div(F.col("n_treatment"), n).alias("observed_ratio"), chi2.alias("chi2"))
    srm = srm.withColumn("valid", F.col("chi2") < F.lit(chi2_1dof_critical(alpha)))
    if with_p:
        srm = srm.withColumn("p_value", chi2_1dof_p("chi2"))
    long = one.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature_idx"), F.lit(f).alias("feature"),
                 F.col(f"{f}__mt").alias("mt"), F.col(f"{f}__mc").alias("mc"),
                 F.col(f"{f}__vt").alias("vt"), F.col(f"{f}__vc").alias("vc"))
        for i, f in enumerate(features)])).alias("r")).select("r.*")
    pooled = F.sqrt((F.col("vt") + F.col("vc")) / 2.0)
    smd = F.when(pooled == 0, F.lit(0.0)).otherwise((F.col("mt") - F.col("mc")) / pooled)
    balance = (long.select("feature_idx", "feature", smd.alias("smd"))
               .withColumn("abs_smd", F.abs("smd"))
               .withColumn("is_balanced", F.col("abs_smd") < F.lit(threshold)))
    return srm, balance
