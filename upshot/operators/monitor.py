"""Drift and production monitoring: periods, PSI, period health, drift samples.

Time is real: periods are equal-width event-time buckets between the first
and last timestamp (one-row min/max broadcast), not row-order slices, so the
assignment needs no global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision, col_, psi_rag, unit_uniform
from upshot.functions.materialize import small
from upshot.functions.quantiles import count_sorted, quantiles_of
from upshot.functions.sampling import smallest_by_hash

PSI_EPS = 1e-7


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 for TIMESTAMP or TIMESTAMP_NTZ, independent of the session zone."""
    c = col_(ts)
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)


def assign_periods(df: DataFrame, ts: str = "ts", n_periods: int = 8, name: str = "period") -> DataFrame:
    """Period 1..n: equal-width event-time buckets, ``((s - s_min) * n) div (s_max - s_min + 1) + 1``."""
    s = epoch_seconds(ts)
    rng = df.agg(F.min(s).alias("_s0"), F.max(s).alias("_s1"))
    p = F.floor(((s - F.col("_s0")) * n_periods) / (F.col("_s1") - F.col("_s0") + 1)).cast("int") + 1
    return df.crossJoin(F.broadcast(rng)).withColumn(name, p).drop("_s0", "_s1")


def unpivot(df: DataFrame, features: list[str], keep: list[str]) -> DataFrame:
    """Long form (keep..., feature, value) of the feature columns."""
    return df.select(*keep, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("_r")
    ).select(*keep, "_r.feature", "_r.value")


def psi_edges(reference: DataFrame, features: list[str], n_bins: int = 10, method: str = "exact") -> DataFrame:
    """Reference-quantile edges per feature, ends widened by 1e-7: (feature, edges array, n_ref)."""
    q = quantiles_of(reference, features, [i / n_bins for i in range(n_bins + 1)], method=method)
    arr = q.groupBy("feature").agg(F.array_sort(F.collect_list(F.struct("q_idx", "value"))).alias("_s"),
                                   F.first("n").alias("n_ref"))
    last = n_bins
    edges = F.transform("_s", lambda s, i: F.when(i == 0, s["value"] - PSI_EPS)
                        .when(i == last, s["value"] + PSI_EPS).otherwise(s["value"]))
    return small(arr.select("feature", edges.alias("edges"), "n_ref"), 100_000)  # one row per feature


def histogram_bin(value: Column, edges: Column, n_bins: int, overflow: str = "drop") -> Column:
    """``np.histogram`` bin: [e_i, e_{i+1}) with the last bin closed.

    Values outside the edges get no bin (``overflow="drop"``, the reference) or
    the first / last bin (``overflow="clip"``).
    """
    first, last = F.element_at(edges, 1), F.element_at(edges, n_bins + 1)
    idx = count_sorted(edges, value, n_bins + 1, strict=False) - 1
    if overflow == "clip":
        outside_lo, outside_hi = F.lit(0), F.lit(n_bins - 1)
    elif overflow == "drop":
        outside_lo = outside_hi = F.lit(None).cast("int")
    else:
        raise ValueError("overflow must be 'drop' or 'clip'")
    return (F.when(value < first, outside_lo).when(value > last, outside_hi)
            .when(value == last, F.lit(n_bins - 1)).otherwise(idx))


def bin_counts(df: DataFrame, edges: DataFrame, by: list[str], n_bins: int, overflow: str = "drop") -> DataFrame:
    """(by..., feature, bin, c): rows per bin of every feature, from one read.

    ``edges`` (one row per feature) go into the plan as literals; a row becomes
    one small struct per feature, counted map-side.
    """
    rows = [F.struct(F.lit(r["feature"]).alias("feature"), histogram_bin(
        F.col(r["feature"]).cast("double"), F.array(*[F.lit(float(x)) for x in r["edges"]]), n_bins, overflow).alias("bin"))
        for r in edges.collect()]
    long = df.select(*by, F.explode(F.array(*rows)).alias("_r")).where(F.col("_r.bin").isNotNull())
    return long.groupBy(*by, F.col("_r.feature").alias("feature"), F.col("_r.bin").alias("bin")).agg(F.count(F.lit(1)).alias("c"))


def psi(reference: DataFrame, current: DataFrame, features: list[str], by: list[str] | None = None,
        n_bins: int = 10, method: str = "exact", overflow: str = "drop") -> DataFrame:
    """Population Stability Index per feature (and per ``by`` group of the current frame).

    pct = (count + eps) / (n + eps * bins), with n the size of the frame (values
    outside the reference edges drop out of the counts but stay in n);
    psi = sum((cur - ref) * ln(cur / ref)). Bins missing from a side count 0.
    ``overflow="clip"`` counts out-of-range current values in the end bins instead.
    """
    by = list(by or [])
    edges = psi_edges(reference, features, n_bins, method)
    ref_counts = bin_counts(reference, edges, [], n_bins).withColumnRenamed("c", "ref_c")
    cur_counts = bin_counts(current, edges, by, n_bins, overflow).withColumnRenamed("c", "cur_c")
    cur_n = current.groupBy(*by).agg(F.count(F.lit(1)).alias("n_cur")) if by else \
        current.agg(F.count(F.lit(1)).alias("n_cur"))
    bins = current.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    grid = (cur_n.crossJoin(edges.select("feature", "n_ref")).crossJoin(bins))
    full = (grid.join(ref_counts, ["feature", "bin"], "left").join(cur_counts, [*by, "feature", "bin"], "left")
            .fillna(0, ["ref_c", "cur_c"]))
    rp = (F.col("ref_c") + PSI_EPS) / (F.col("n_ref") + PSI_EPS * n_bins)
    cp = (F.col("cur_c") + PSI_EPS) / (F.col("n_cur") + PSI_EPS * n_bins)
    out = full.groupBy(*by, "feature").agg(F.sum((cp - rp) * F.log(cp / rp)).alias("psi"))
    return out.withColumn("rag_status", psi_rag(F.bround("psi", 6)))


def monitor_periods(scored: DataFrame, period: str = "period", score: str = "score", outcome: str = "conversion",
                    value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """Per period: users, bid rate %, mean uplift, conversion rate, expected profit per user."""
    s = F.col(score).cast("double")
    bid = bid_decision(s, value, cost)
    g = scored.groupBy(period).agg(
        F.count(F.lit(1)).alias("n_users"), F.avg(bid.cast("double")).alias("_bid"),
        F.avg(s).alias("avg_uplift_score"), F.avg(F.col(outcome).cast("double")).alias("avg_conversion_rate"),
        F.avg(F.when(bid, s * value - cost).otherwise(F.lit(0.0))).alias("expected_profit_per_user"))
    return g.select(F.col(period).alias("week"), F.concat(F.lit("Week "), F.col(period).cast("string")).alias("week_label"),
                    "n_users", (F.col("_bid") * 100).alias("bid_rate_pct"), "avg_uplift_score",
                    "avg_conversion_rate", "expected_profit_per_user")


def control_band(timeseries: DataFrame, k: float = 2.0) -> DataFrame:
    """Cumulative expected profit with a mean +/- k sigma band of the periods before (few rows).

    A period is judged by its predecessors alone, so it cannot widen its own
    band; the first two periods have no band and raise no alert.
    """
    w = Window.orderBy("week").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    past = Window.orderBy("week").rowsBetween(Window.unboundedPreceding, -1)
    prof = F.col("expected_profit_per_user") * F.col("n_users")
    out = (timeseries.withColumn("period_profit", prof)
           .withColumn("cumulative_profit", F.sum("period_profit").over(w))
           .withColumn("band_std", F.stddev_samp("period_profit").over(past))
           .withColumn("band_mean", F.when(F.col("band_std").isNotNull(), F.avg("period_profit").over(past))))
    off = F.abs(F.col("period_profit") - F.col("band_mean")) > k * F.col("band_std")
    return out.withColumn("alert", F.coalesce(off, F.lit(False)))


def rag_counts(psi_scores: DataFrame) -> DataFrame:
    return psi_scores.groupBy("rag_status").agg(F.count(F.lit(1)).alias("n"))


def model_health(psi_scores: DataFrame, band: DataFrame | None = None) -> DataFrame:
    """CRITICAL if any RED; WARNING if any AMBER or a band alert; else HEALTHY (our rule)."""
    a = psi_scores.agg(F.max((F.col("rag_status") == "RED").cast("int")).alias("_red"),
                       F.max((F.col("rag_status") == "AMBER").cast("int")).alias("_amber"))
    if band is not None:
        a = a.crossJoin(band.agg(F.max(F.col("alert").cast("int")).alias("_alert")))
    else:
        a = a.withColumn("_alert", F.lit(0))
    return a.select(F.when(F.col("_red") == 1, "CRITICAL")
                    .when((F.col("_amber") == 1) | (F.col("_alert") == 1), "WARNING").otherwise("HEALTHY")
                    .alias("model_health"))


def model_age(run_date: str, today: Column | None = None, retrain_after_days: int = 30) -> list[Column]:
    age = F.datediff(today if today is not None else F.current_date(), F.lit(run_date).cast("date"))
    return [age.alias("model_age_days"), (age > retrain_after_days).alias("retrain_recommended")]


def drift_sample(scored: DataFrame, period: str = "period", score: str = "score", per_period: int = 500,
                 unit: str = "unit_id", seed: int = 42, hash_kind: str = "md5") -> DataFrame:
    """Up to ``per_period`` scores per period, without replacement, chosen by unit hash."""
    sizes = scored.groupBy(period).agg(F.least(F.count(F.lit(1)), F.lit(per_period)).alias("quota"))
    keyed = scored.select(period, unit, score).withColumn("_u", unit_uniform(unit, seed, hash_kind))
    picked = smallest_by_hash(keyed, [period], sizes, "_u", unit)
    return picked.select(F.col(period).alias("week"), unit, F.col(score).alias("uplift_score"))



def assign_periods_by_hash(df: DataFrame, unit: str = "unit_id", n_periods: int = 8, name: str = "period",
                           seed: int = 11) -> DataFrame:
    """Equal random slices 1..n by unit hash, for data without timestamps (the reference slices by row order)."""
    from upshot.functions.columns import unit_uniform
    u = unit_uniform(unit, seed, "xxhash")
    return df.withColumn(name, F.least(F.floor(u * n_periods), F.lit(n_periods - 1)).cast("int") + 1)
