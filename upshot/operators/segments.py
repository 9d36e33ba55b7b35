"""Audiences: top-share flags, segment profiles, archetypes and stratified samples."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.columns import (ARCHETYPES, archetype, archetype_order, safe_div,
                                      unit_uniform)
from upshot.functions.quantiles import quantiles
from upshot.functions.materialize import bounded, checkpointed
from upshot.functions.sampling import smallest_by_hash
from upshot.session import ensure_checkpoint_dir


def top_threshold(scored: DataFrame, score: str = "score", top: float = 0.10, method: str = "exact") -> DataFrame:
    """One row: the score percentile at ``1 - top`` (linear interpolation)."""
    return quantiles(scored, score, [1.0 - top], method=method).select(F.col("value").alias("threshold"))


def flag_top(scored: DataFrame, score: str = "score", top: float = 0.10, name: str = "is_persuadable",
             method: str = "exact") -> DataFrame:
    """``score >= percentile(1 - top)`` (inclusive), threshold broadcast as a one-row frame."""
    thr = top_threshold(scored, score, top, method)
    return (scored.crossJoin(F.broadcast(thr))
            .withColumn(name, F.col(score) >= F.col("threshold")).drop("threshold"))


def segment_profile(scored: DataFrame, features: list[str], score: str = "score", top: float = 0.10,
                    method: str = "exact") -> DataFrame:
    """Mean of each feature for the top share vs the rest; diff % = (p - o) / |o| * 100; ranked by |diff|."""
    flagged = flag_top(scored.select(score, *features), score, top, method=method)
    p = F.col("is_persuadable")
    aggs = []
    for f in features:
        x = F.col(f).cast("double")
        aggs += [F.avg(F.when(p, x)).alias(f"{f}__p"), F.avg(F.when(~p, x)).alias(f"{f}__o")]
    wide = flagged.agg(*aggs)
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("feature_idx"), F.lit(f).alias("feature"),
                 F.col(f"{f}__p").alias("persuadable_mean"), F.col(f"{f}__o").alias("other_mean"))
        for i, f in enumerate(features)])).alias("r")).select("r.*")
    long = long.withColumn("diff_pct", safe_div(F.col("persuadable_mean") - F.col("other_mean"),
                                                F.abs("other_mean")) * 100)
    rank = Window.orderBy(F.desc_nulls_last(F.abs("diff_pct")), "feature_idx")  # d rows only
    return long.withColumn("feature_rank", F.row_number().over(rank))


def stratum_baseline(df: DataFrame, strata: list, treatment: str = "treatment", outcome: str = "conversion",
                     name: str = "baseline_conversion_prob") -> DataFrame:
    """A model-free P(Y=1 | X, T=0): the control conversion rate of the unit's stratum.

    ``strata`` are column expressions with few distinct values (the join
    side has one row per stratum). Null strata are strata; every row stays.
    """
    keyed = df.select("*", F.struct(*[s.alias(f"s{i}") for i, s in enumerate(strata)]).alias("_key"))
    keys = ["_key"]
    rates = keyed.groupBy(*keys).agg(
        F.avg(F.when(F.col(treatment) == 0, F.col(outcome).cast("double"))).alias(name))
    # A stratum can hold a third of the rows: a shuffle join on its key would put it in one
    # task. Broadcast the rates when their row count is proven small, else an ordinary join.
    rates, small_side = bounded(rates, 100_000, with_flag=True)
    return keyed.join(F.broadcast(rates) if small_side else rates, keys).drop(*keys)


def classify(scored: DataFrame, score: str = "score", baseline: str = "baseline_conversion_prob",
             treatment: str = "treatment", outcome: str = "conversion", threshold: float = 0.02,
             control_rate: float | None = None) -> DataFrame:
    """Add ``archetype_label`` and ``persuadable_flag``; the Sure Thing split is the control conversion rate."""
    if control_rate is None:
        cr = scored.agg(F.avg(F.when(F.col(treatment) == 0, F.col(outcome).cast("double"))).alias("_cr"))
        out = scored.crossJoin(F.broadcast(cr))
        crc = F.col("_cr")
    else:
        out, crc = scored, F.lit(float(control_rate))
    out = out.withColumn("archetype_label", archetype(score, baseline, crc, threshold))
    out = out.withColumn("persuadable_flag", (F.col("archetype_label") == "Persuadable").cast("tinyint"))
    return out.drop("_cr") if control_rate is None else out


def archetype_summary(classified: DataFrame, score: str = "score", baseline: str = "baseline_conversion_prob",
                      outcome: str = "conversion", value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """Per archetype: count, % of total, mean uplift/baseline/conversion, expected profit, bid advice."""
    g = classified.groupBy("archetype_label").agg(
        F.count(F.lit(1)).alias("count"), F.avg(F.col(score).cast("double")).alias("avg_uplift_score"),
        F.avg(F.col(baseline).cast("double")).alias("avg_baseline_conv_prob"),
        F.avg(F.col(outcome).cast("double")).alias("avg_actual_conversion_rate"))
    total = g.agg(F.sum("count").alias("_total"))
    persu = F.col("archetype_label") == "Persuadable"
    return (g.crossJoin(F.broadcast(total))
            .select("archetype_label", "count", (F.col("count") * 100.0 / F.col("_total")).alias("pct_of_total"),
                    "avg_uplift_score", "avg_baseline_conv_prob", "avg_actual_conversion_rate",
                    F.when(persu, F.col("avg_uplift_score") * value - cost).otherwise(F.lit(0.0))
                    .alias("expected_profit_per_user"),
                    F.when(persu, "BID").otherwise("NO BID").alias("bid_recommendation"),
                    archetype_order("archetype_label").alias("archetype_order")))


def stratified_sample(df: DataFrame, label: str = "archetype_label", n: int = 50000, unit: str = "unit_id",
                      seed: int = 42, hash_kind: str = "md5", persist_input: bool = True) -> DataFrame:
    """Proportional stratified sample without replacement, exact size min(n, total).

    Quota per stratum: min(size, max(1, round_half_even(n * size / total))); if
    the quotas overshoot n the union is trimmed to n by a second hash, if they
    fall short the strata that lost most by rounding get one row more each.
    Rows are chosen by the smallest hash of the unit id within each stratum,
    so the sample is reproducible and retry-safe. Adds ``row_id`` 0..n-1.
    Eager: the input is read once (persisted for the duration of the call, unless
    ``persist_input=False`` because it is already materialised); the bounded result
    (n rows) is checkpointed to the shared checkpoint folder.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keyed = df.withColumn("_u", unit_uniform(unit, seed, hash_kind))
    if persist_input:
        keyed = keyed.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes = bounded(keyed.groupBy(label).agg(F.count(F.lit(1)).alias("_size")))  # one row per stratum
        total = sizes.agg(F.sum("_size").alias("_total"))
        k = F.least(F.col("_total"), F.lit(n))
        share = k * F.col("_size") / F.col("_total")
        quotas = sizes.crossJoin(F.broadcast(total)).withColumn("quota", F.least(F.col("_size"), F.greatest(
            F.lit(1).cast("long"), F.bround(share).cast("long"))))
        # rounding may leave a few rows to give: one each to the strata that lost most by it (one row per stratum here)
        lost = Window.orderBy(F.desc(F.col("quota") < F.col("_size")), F.desc(share - F.col("quota")), F.asc_nulls_last(label))
        short = k - F.sum("quota").over(Window.partitionBy())
        quotas = quotas.select(label, (F.col("quota") + ((F.row_number().over(lost) <= short) & (F.col("quota") < F.col("_size")))
                                       .cast("long")).alias("quota"))
        # at most n + (number of strata) rows: cheap to materialise, cuts the lineage
        picked = checkpointed(smallest_by_hash(keyed, [label], quotas, "_u", unit))
        trim_q = total.select(F.least(F.col("_total"), F.lit(n)).alias("quota"))
        trimmed = smallest_by_hash(picked.withColumn("_u", unit_uniform(unit, seed + 1, hash_kind)), [], trim_q,
                                   "_u", unit, bins=256)
        order = Window.orderBy("_u", unit)  # at most n rows
        return checkpointed(trimmed.withColumn("row_id", F.row_number().over(order) - 1).drop("_u"))
    finally:
        keyed.unpersist()


def archetype_counts(df: DataFrame, label: str = "archetype_label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


__all__ = ["ARCHETYPES", "top_threshold", "flag_top", "segment_profile", "stratum_baseline", "classify",
           "archetype_summary", "stratified_sample", "archetype_counts"]


def sample_n(df: DataFrame, n: int, unit: str = "unit_id", seed: int = 42, hash_kind: str = "md5") -> DataFrame:
    """Exact-size sample without replacement keyed on the unit hash (reproducible, retry-safe)."""
    from upshot.functions.sampling import sample_n as _sample_n
    keyed = df.withColumn("_u", unit_uniform(unit, seed, hash_kind))
    return _sample_n(keyed, n, "_u", unit).drop("_u")


def sample_frac(df: DataFrame, fraction: float, unit: str = "unit_id", seed: int = 42,
                hash_kind: str = "md5") -> DataFrame:
    """Bernoulli sample of about ``fraction`` of the units: hash(unit) < fraction (no shuffle)."""
    return df.where(unit_uniform(unit, seed, hash_kind) < F.lit(float(fraction)))


def segment_dim(profile: DataFrame, importance: DataFrame) -> DataFrame:
    """Segment dimension: profile and surrogate importance joined on the feature (one row per feature)."""
    return profile.join(importance.drop("feature_idx"), "feature", "left")
