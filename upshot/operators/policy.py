"""Policies in money: replay value, cost sensitivity, policy tables and planning grids.

Every estimator is one pass of conditional aggregates over the scored rows;
grids over costs or thresholds are folded into the same pass (one aggregate
column set per grid value) instead of one job per value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.functions.columns import bid_decision, col_, realised_profit, safe_div
from upshot.functions.quantiles import count_sorted, quantiles

DEFAULT_COSTS = [0.05, 0.10, 0.15, 0.20, 0.25, 0.50]


# Policies as the reports name and describe them.
AS_LOGGED = ("As logged", "The randomised assignment as it happened.")
TOP_SHARE = ("Top share", "Treats the share {:.0%} of units with the highest predicted effect.")
WORTH_IT = ("Worth the cost", "Treats a unit if its expected gain covers the cost.")
NOBODY = ("Nobody", "Treats no unit.")
BANDIT = ("Batched bandit", "Takes the arm with the larger upper bound, learnt round by round.")


def replay_value(scored: DataFrame, decision: Column | str, treatment: str = "treatment",
                 outcome: str = "conversion", value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """Replay estimator: mean realised profit over rows whose logged arm equals the decision (0 if none)."""
    d = col_(decision).cast("int")
    match = d == F.col(treatment)
    profit = realised_profit(F.col(outcome).cast("double"), F.col(treatment), value, cost)
    agg = scored.agg(F.count(F.when(match, 1)).alias("n_matched"), F.count(F.lit(1)).alias("n"),
                     F.avg(F.when(match, profit)).alias("_p"), F.avg(d.cast("double")).alias("bid_rate"))
    return agg.select("n", "n_matched", F.coalesce("_p", F.lit(0.0)).alias("profit_per_user"), "bid_rate")


def score_policy_value(scored: DataFrame, score: str = "score", value: float = 10.0, cost: float = 0.10,
                       **kw) -> DataFrame:
    return replay_value(scored, bid_decision(score, value, cost), value=value, cost=cost, **kw)


def cost_sensitivity(scored: DataFrame, score: str = "score", costs=DEFAULT_COSTS, value: float = 10.0,
                     treatment: str = "treatment", outcome: str = "conversion") -> DataFrame:
    """Replay profit and bid share at every cost, in one pass (3 aggregates per cost)."""
    y = F.col(outcome).cast("double")
    t = F.col(treatment)
    aggs = []
    for i, c in enumerate(costs):
        d = bid_decision(score, value, c).cast("int")
        m = d == t
        aggs += [F.avg(F.when(m, realised_profit(y, t, value, c))).alias(f"p{i}"),
                 F.count(F.when(m, 1)).alias(f"m{i}"), F.avg(d.cast("double")).alias(f"b{i}")]
    wide = scored.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(float(c)).alias("cost_per_ad"),
                 F.coalesce(F.col(f"p{i}"), F.lit(0.0)).alias("profit_per_user"),
                 F.col(f"m{i}").alias("n_matched"), (F.col(f"b{i}") * 100).alias("bid_share_pct"))
        for i, c in enumerate(costs)])).alias("r")).select("r.*")


def greedy_decision(scored: DataFrame, score: str = "score", top: float = 0.15, name: str = "greedy_bid",
                    method: str = "exact") -> DataFrame:
    """Treat the top ``top`` share by score (score >= percentile(1 - top))."""
    thr = quantiles(scored, score, [1.0 - top], method=method).select(F.col("value").alias("_thr"))
    return scored.crossJoin(F.broadcast(thr)).withColumn(name, F.col(score) >= F.col("_thr")).drop("_thr")


def policy_table(scored: DataFrame, policies: list[tuple[int, str, Column, str]], treatment: str = "treatment",
                 outcome: str = "conversion", value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """One row per policy (id, name, decision column, description): replay profit and bid rate %, one pass."""
    y = F.col(outcome).cast("double")
    t = F.col(treatment)
    profit = realised_profit(y, t, value, cost)
    aggs = []
    for i, (_, _, dec, _) in enumerate(policies):
        d = dec.cast("int")
        aggs += [F.avg(F.when(d == t, profit)).alias(f"p{i}"), F.avg(d.cast("double")).alias(f"b{i}")]
    wide = scored.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(pid).alias("policy_id"), F.lit(name).alias("policy_name"),
                 F.coalesce(F.col(f"p{i}"), F.lit(0.0)).alias("avg_profit_per_user"),
                 (F.col(f"b{i}") * 100).alias("bid_rate_pct"), F.lit(desc).alias("description"))
        for i, (pid, name, _, desc) in enumerate(policies)])).alias("r")).select("r.*")


def compare_policies(scored: DataFrame, teacher: str, student: str, treatment: str = "treatment",
                     outcome: str = "conversion", value: float = 10.0, cost: float = 0.10) -> DataFrame:
    """Teacher vs student replay profit vs the as-run baseline; retention and GO verdict (one row)."""
    y = F.col(outcome).cast("double")
    t = F.col(treatment)
    profit = realised_profit(y, t, value, cost)
    dt = bid_decision(teacher, value, cost).cast("int")
    ds = bid_decision(student, value, cost).cast("int")
    agg = scored.agg(F.avg(F.when(dt == t, profit)).alias("_pt"), F.avg(F.when(ds == t, profit)).alias("_ps"),
                     F.avg(y).alias("_cr"), F.avg(t.cast("double")).alias("_ts"))
    return agg.select(
        F.coalesce("_pt", F.lit(0.0)).alias("profit_teacher"), F.coalesce("_ps", F.lit(0.0)).alias("profit_student"),
        (F.col("_cr") * value - F.col("_ts") * cost).alias("profit_baseline")).select(
        "*", safe_div(F.col("profit_student"), F.col("profit_teacher")).alias("profit_retention"),
        (F.col("profit_student") > F.col("profit_baseline")).alias("go"))


def returns_curve(scored: DataFrame, score: str = "score", treatment: str = "treatment",
                  outcome: str = "conversion", value: float = 10.0, cost: float = 0.10, steps: int = 100,
                  method: str = "exact") -> DataFrame:
    """Targeting threshold 1%..100%: audience, CATE at the threshold percentile, mean CATE above it, P&L.

    revenue = audience * treatment_cr * (1 + cate_at) * value; net = revenue - audience * cost.
    The mean score above each of the ``steps`` edges comes from one pass: each row gets the
    number k of edges at or below its score (binary search), rows are summed per k (at most
    steps + 1 groups), and suffix sums over k give every threshold's mean.
    """
    ts = [(j + 1) / steps for j in range(steps)]
    q = quantiles(scored, score, [1.0 - t for t in ts], method=method)
    edges = (q.groupBy().agg(F.array_sort(F.collect_list(F.struct("q_idx", "value"))).alias("_e"),
                             F.first("n").alias("n"))
             .select(F.transform("_e", lambda s: s["value"]).alias("_e"), "n"))
    s = F.col(score).cast("double")
    y = F.col(outcome).cast("double")
    k = count_sorted(F.reverse(F.col("_e")), s, steps, strict=False)   # edges ascending
    per_k = (scored.select(score, treatment, outcome).crossJoin(F.broadcast(edges))
             .groupBy(k.alias("k")).agg(F.sum(s).alias("_s"), F.count(F.lit(1)).alias("_c"),
                                        F.sum(F.when(F.col(treatment) == 1, y)).alias("_ty"),
                                        F.count(F.when(F.col(treatment) == 1, 1)).alias("_tn")))
    tcr = per_k.agg((F.sum("_ty") / F.sum("_tn")).alias("_tcr"))
    grid = scored.sparkSession.range(steps).select(F.col("id").cast("int").alias("j"))
    above = (grid.crossJoin(per_k).where(F.col("k") >= F.lit(steps) - F.col("j"))   # <= steps x (steps+1) rows
             .groupBy("j").agg((F.sum("_s") / F.sum("_c")).alias("cate_avg")))
    ts_arr = F.array(*[F.lit(t) for t in ts])
    rows = (grid.crossJoin(edges).crossJoin(tcr).join(above, "j", "left")
            .select(F.element_at(ts_arr, F.col("j") + 1).alias("threshold"),
                    F.element_at("_e", F.col("j") + 1).alias("cate_at"), "cate_avg", "_tcr", F.col("n").alias("_n")))
    audience = F.col("threshold") * F.col("_n")
    revenue = audience * F.col("_tcr") * (1 + F.col("cate_at")) * value
    return rows.select("threshold", audience.alias("audience_size"), "cate_at", "cate_avg",
                       (audience * cost).alias("projected_cost"), revenue.alias("projected_revenue"),
                       (revenue - audience * cost).alias("net_profit"))


def optimal_threshold(curve: DataFrame) -> DataFrame:
    """Argmax of net profit; ties go to the smallest threshold."""
    return curve.agg(F.min_by("threshold", F.struct(-F.col("net_profit"), F.col("threshold"))).alias("optimal_threshold"),
                     F.max("net_profit").alias("max_net_profit"))


def breakeven_grid(avg_uplift: DataFrame, n_costs: int = 20, n_values: int = 20, cost_range=(0.01, 0.50),
                   value_range=(1.0, 20.0)) -> DataFrame:
    """Cost x value grid of ``avg_uplift * value - cost`` from a one-row ``avg_uplift`` frame."""
    spark = avg_uplift.sparkSession
    c0, c1 = cost_range
    v0, v1 = value_range
    costs = spark.range(n_costs).select(
        (F.lit(c0) + F.col("id") * F.lit((c1 - c0) / max(n_costs - 1, 1))).alias("cost_per_ad"))
    values = spark.range(n_values).select(
        (F.lit(v0) + F.col("id") * F.lit((v1 - v0) / max(n_values - 1, 1))).alias("conversion_value"))
    grid = costs.crossJoin(values).crossJoin(F.broadcast(avg_uplift.select("avg_uplift")))
    profit = F.col("avg_uplift") * F.col("conversion_value") - F.col("cost_per_ad")
    return grid.select("cost_per_ad", "conversion_value", "avg_uplift", profit.alias("profit_per_user"),
                       (profit > 0).alias("profitable"))


def roi_calculator(audience: Column, conversion_rate: Column, value: float, cost: float) -> list[Column]:
    """Projected cost, revenue, profit and ROI % (0 when cost is 0)."""
    c = audience * F.lit(cost)
    r = audience * conversion_rate * F.lit(value)
    return [c.alias("projected_cost"), r.alias("projected_revenue"), (r - c).alias("projected_profit"),
            F.when(c == 0, F.lit(0.0)).otherwise(safe_div(r - c, c) * 100).alias("roi_pct")]


def kpi_measures(scored_classified: DataFrame, treatment: str = "treatment", outcome: str = "conversion",
                 score: str = "score", value: float = 10.0, cost: float = 0.10, threshold: float = 0.10,
                 bandit_profit: float | None = None) -> DataFrame:
    """The report's one-row economic measures."""
    y = F.col(outcome).cast("double")
    t = F.col(treatment)
    persu = F.col("archetype_label") == "Persuadable"
    a = scored_classified.agg(
        F.avg(F.when(t == 1, y)).alias("treatment_cr"), F.avg(F.when(t == 0, y)).alias("control_cr"),
        F.count(F.lit(1)).alias("total_users"), F.count(F.when(persu, 1)).alias("persuadable_count"),
        F.avg(F.when(persu, F.col(score).cast("double"))).alias("avg_cate_persuadables"))
    rev_t = F.col("treatment_cr") * value
    audience = F.col("total_users") * F.lit(threshold)
    conv = audience * F.col("treatment_cr") * (1 + F.coalesce(F.col("avg_cate_persuadables"), F.lit(0.0)))
    proj_cost = audience * cost
    proj_rev = conv * value
    out = a.select(
        "*", rev_t.alias("revenue_per_user_treatment"), (F.col("control_cr") * value).alias("revenue_per_user_control"),
        (rev_t - cost).alias("net_profit_ab"), rev_t.alias("break_even_cost"),
        safe_div(F.col("persuadable_count"), F.col("total_users")).alias("persuadable_share"),
        audience.alias("projected_audience"), proj_cost.alias("projected_cost"), conv.alias("projected_conversions"),
        proj_rev.alias("projected_revenue"), (proj_rev - proj_cost).alias("projected_net_profit"),
        F.when(proj_cost == 0, F.lit(None).cast("double")).otherwise(safe_div(proj_rev - proj_cost, proj_cost))
        .alias("roi_at_scale"),
        safe_div(proj_cost, conv).alias("cost_per_conversion"))
    if bandit_profit is not None:
        out = out.withColumn("net_profit_bandit", F.lit(float(bandit_profit))).withColumn(
            "profit_delta", F.col("net_profit_bandit") - F.col("net_profit_ab"))
    return out


def audience_at_threshold(kpis: DataFrame, shares=(0.05, 0.10, 0.15, 0.20)) -> DataFrame:
    """Audience and projected conversions at several targeting shares."""
    spark = kpis.sparkSession
    sh = spark.createDataFrame([(float(s),) for s in shares], "share double")
    k = kpis.select("total_users", "treatment_cr", "avg_cate_persuadables")
    aud = F.col("share") * F.col("total_users")
    return sh.crossJoin(F.broadcast(k)).select(
        "share", aud.alias("audience_size"),
        (aud * F.col("treatment_cr") * (1 + F.coalesce("avg_cate_persuadables", F.lit(0.0)))).alias("projected_conversions"))


def scale_projection(profit_per_user: DataFrame, scales=(1_000_000, 10_000_000, 100_000_000)) -> DataFrame:
    """Profit per user times 1M / 10M / 100M impressions."""
    spark = profit_per_user.sparkSession
    sc = spark.createDataFrame([(int(s),) for s in scales], "impressions long")
    return sc.crossJoin(F.broadcast(profit_per_user.select("profit_per_user"))).select(
        "impressions", "profit_per_user", (F.col("impressions") * F.col("profit_per_user")).alias("projected_profit"))


def budget_allocation(arch_summary: DataFrame, budget: float = 50000.0) -> DataFrame:
    """Budget split across archetypes in proportion to positive expected profit x count (K24, our rule)."""
    weight = F.greatest(F.col("expected_profit_per_user"), F.lit(0.0)) * F.col("count")
    tot = arch_summary.agg(F.sum(weight).alias("_w"))
    return arch_summary.crossJoin(tot).select(
        "archetype_label", weight.alias("weight"),
        F.when(F.col("_w") > 0, F.lit(budget) * weight / F.col("_w")).otherwise(F.lit(0.0)).alias("budget"))


def health_status(srm: DataFrame, max_smd: DataFrame, smd_threshold: float = 0.1) -> DataFrame:
    """SRM / balance / overall PASS-FAIL."""
    j = srm.select("valid").crossJoin(max_smd.select("max_smd"))
    bal = F.col("max_smd") < smd_threshold
    return j.select(F.when(F.col("valid"), "PASS").otherwise("FAIL").alias("srm_status"),
                    F.when(bal, "PASS").otherwise("FAIL").alias("balance_status"),
                    F.when(F.col("valid") & bal, "PASS").otherwise("FAIL").alias("experiment_health"))


def incremental_value(cum_reward: Column, baseline: Column, matched: Column) -> list[Column]:
    """Bandit value over the fixed policy: total and relative to |baseline|."""
    inc = cum_reward - baseline * matched
    return [inc.alias("incremental_value"),
            safe_div(safe_div(cum_reward, matched) - baseline, F.abs(baseline)).alias("relative_gain")]


def roi_from_top_share(scored: DataFrame, score: str = "score", treatment: str = "treatment",
                       outcome: str = "conversion", share: float = 0.20, value: float = 10.0, cost: float = 0.10,
                       method: str = "exact") -> DataFrame:
    """ROI calculator (K23): target the top ``share`` by score; the conversion rate is the treated rate there."""
    thr = quantiles(scored, score, [1.0 - share], method=method).select(F.col("value").alias("_thr"))
    top = F.col(score) >= F.col("_thr")
    a = scored.crossJoin(F.broadcast(thr)).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.avg(F.when(top & (F.col(treatment) == 1), F.col(outcome).cast("double"))).alias("conversion_rate"))
    aud = F.col("total_users") * F.lit(share)
    return a.select(F.lit(float(share)).alias("share"), aud.alias("audience_size"), "conversion_rate",
                    *roi_calculator(aud, F.col("conversion_rate"), value, cost))


def sample_size_status(df: DataFrame, treatment: str = "treatment", min_n: int = 1000) -> DataFrame:
    """GREEN when both arms hold at least ``min_n`` units, else RED (K28, our rule)."""
    t = F.col(treatment)
    a = df.agg(F.count(F.when(t == 0, 1)).alias("n_control"), F.count(F.when(t == 1, 1)).alias("n_treatment"))
    ok = (F.col("n_control") >= min_n) & (F.col("n_treatment") >= min_n)
    return a.select("n_control", "n_treatment", F.lit(min_n).alias("min_n"),
                    F.when(ok, "GREEN").otherwise("RED").alias("sample_size_status"))
