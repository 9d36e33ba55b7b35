"""Registered queries: audiences, archetypes, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.functions.columns import unit_uniform, unit_uniform_sql
from upshot.operators import ranking, segments
from upshot.plans.registry import R, SCORED_CTE, register, rnd, scored
from upshot.sources.experiment import FEATURES

TOP_SHARE = 0.15


def split_flag(seed: int = 1):
    return unit_uniform("unit_id", seed) < 0.8


SPLIT_SQL = f"{unit_uniform_sql('unit_id', 1)} < 0.8"


@register("train_test_split", SCORED_CTE + f"""
SELECT ({SPLIT_SQL}) AS is_train, count(*) AS n, CAST(sum(treatment) AS BIGINT) AS n_treated,
  CAST(sum(conversion) AS BIGINT) AS conversions
FROM scored GROUP BY 1
""")
def q_split(spark, sf):
    s = scored(spark, sf).withColumn("is_train", split_flag())
    return s.groupBy("is_train").agg(F.count(F.lit(1)).alias("n"), F.sum("treatment").cast("long").alias("n_treated"),
                                     F.sum("conversion").cast("long").alias("conversions"))


def _profile_sql() -> str:
    parts = [f"SELECT {i} AS feature_idx, '{f}' AS feature, avg(CASE WHEN p THEN {f} END) AS persuadable_mean, "
             f"avg(CASE WHEN NOT p THEN {f} END) AS other_mean FROM fl" for i, f in enumerate(FEATURES)]
    return SCORED_CTE + f"""
, th AS (SELECT quantile_cont(score, {1 - TOP_SHARE!r}) AS thr FROM scored)
, fl AS (SELECT s.*, s.score >= th.thr AS p FROM scored s, th)
, m AS ({' UNION ALL '.join(parts)})
, d AS (SELECT *, (persuadable_mean - other_mean) / abs(other_mean) * 100 AS diff_pct FROM m)
SELECT feature_idx, feature, {R('persuadable_mean', 6)} AS persuadable_mean, {R('other_mean', 6)} AS other_mean,
  {R('diff_pct', 6)} AS diff_pct,
  CAST(row_number() OVER (ORDER BY abs(diff_pct) DESC NULLS LAST, feature_idx) AS INTEGER) AS feature_rank
FROM d
"""


@register("segment_profile", _profile_sql())
def q_profile(spark, sf):
    return rnd(segments.segment_profile(scored(spark, sf), FEATURES, top=TOP_SHARE), 6)


@register("top_share_threshold", SCORED_CTE + f"""
SELECT {R(f'quantile_cont(score, {1 - TOP_SHARE!r})')} AS threshold FROM scored
""")
def q_threshold(spark, sf):
    return rnd(segments.top_threshold(scored(spark, sf), top=TOP_SHARE))


def classified(spark, sf):
    s = segments.stratum_baseline(scored(spark, sf), [F.col("f1") > 5000])
    return segments.classify(s)


CLASSIFIED_CTE = SCORED_CTE + """
, br AS (SELECT (f1 > 5000) AS st, avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS baseline_conversion_prob
         FROM scored GROUP BY 1)
, cr AS (SELECT avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS c FROM scored)
, cl AS (SELECT s.*, br.baseline_conversion_prob,
           CASE WHEN s.score < 0 THEN 'Sleeping Dog' WHEN s.score >= 0.02 THEN 'Persuadable'
                WHEN br.baseline_conversion_prob > cr.c THEN 'Sure Thing' ELSE 'Lost Cause' END AS archetype_label
         FROM scored s JOIN br ON (s.f1 > 5000) = br.st, cr)
"""


@register("archetype_summary", CLASSIFIED_CTE + f"""
, g AS (SELECT archetype_label, count(*) AS count, avg(score) AS avg_uplift_score,
          avg(baseline_conversion_prob) AS avg_baseline_conv_prob, avg(CAST(conversion AS DOUBLE)) AS avg_actual_conversion_rate
        FROM cl GROUP BY 1)
, t AS (SELECT sum(count) AS total FROM g)
SELECT archetype_label, count, {R('count * 100.0 / total')} AS pct_of_total, {R('avg_uplift_score')} AS avg_uplift_score,
  {R('avg_baseline_conv_prob')} AS avg_baseline_conv_prob, {R('avg_actual_conversion_rate')} AS avg_actual_conversion_rate,
  {R("CASE WHEN archetype_label = 'Persuadable' THEN avg_uplift_score * 10.0 - 0.1 ELSE 0.0 END")} AS expected_profit_per_user,
  CASE WHEN archetype_label = 'Persuadable' THEN 'BID' ELSE 'NO BID' END AS bid_recommendation,
  CASE archetype_label WHEN 'Persuadable' THEN 1 WHEN 'Sure Thing' THEN 2 WHEN 'Sleeping Dog' THEN 3 ELSE 4 END AS archetype_order
FROM g, t
""")
def q_archetypes(spark, sf):
    return rnd(segments.archetype_summary(classified(spark, sf)))


@register("archetype_counts", CLASSIFIED_CTE + """
SELECT archetype_label, count(*) AS n FROM cl GROUP BY 1
""")
def q_arch_counts(spark, sf):
    return segments.archetype_counts(classified(spark, sf))


SAMPLE_N = 5000


@register("stratified_sample", CLASSIFIED_CTE + f"""
, sz AS (SELECT archetype_label, count(*) AS size FROM cl GROUP BY 1)
, tot AS (SELECT sum(size) AS total FROM sz)
, q0 AS (SELECT archetype_label, size, least(total, {SAMPLE_N}) AS k, least(total, {SAMPLE_N}) * size / total AS share,
           least(size, greatest(1, CAST(round_even(least(total, {SAMPLE_N}) * size / total, 0) AS BIGINT))) AS quota
         FROM sz, tot)
, qt AS (SELECT archetype_label, quota + CASE WHEN quota < size AND k - sum(quota) OVER () >=
           row_number() OVER (ORDER BY (quota < size) DESC, share - quota DESC, archetype_label NULLS LAST) THEN 1 ELSE 0 END AS quota
         FROM q0)
, rk AS (SELECT *, row_number() OVER (PARTITION BY archetype_label ORDER BY u1, unit_id) AS r
         FROM (SELECT *, {unit_uniform_sql('unit_id', 42)} AS u1 FROM cl) x)
, pk AS (SELECT rk.* FROM rk JOIN qt USING (archetype_label) WHERE r <= quota)
, tk AS (SELECT *, row_number() OVER (ORDER BY u2, unit_id) AS r2
         FROM (SELECT *, {unit_uniform_sql('unit_id', 43)} AS u2 FROM pk) y)
SELECT CAST(r2 - 1 AS INTEGER) AS row_id, unit_id, treatment, conversion, visit, f2, f3, f4,
  score AS uplift_score, {R('baseline_conversion_prob')} AS baseline_conversion_prob, archetype_label,
  CAST(CASE WHEN archetype_label = 'Persuadable' THEN 1 ELSE 0 END AS TINYINT) AS persuadable_flag
FROM tk, tot WHERE r2 <= least(total, {SAMPLE_N})
""")
def q_sample(spark, sf):
    s = segments.stratified_sample(classified(spark, sf), n=SAMPLE_N, seed=42)
    return rnd(s.select("row_id", "unit_id", "treatment", "conversion", "visit", "f2", "f3", "f4",
                        F.col("score").alias("uplift_score"), "baseline_conversion_prob", "archetype_label",
                        "persuadable_flag").withColumn("row_id", F.col("row_id").cast("int")), keep=("uplift_score",))


@register("cate_histogram", SCORED_CTE + f"""
, r AS (SELECT min(score) AS lo, max(score) AS hi FROM scored)
, b AS (SELECT CAST(least(CASE WHEN hi = lo THEN 0 ELSE floor((score - lo) / ((hi - lo) / 50)) END, 49) AS INTEGER) AS bin, lo, hi
        FROM scored, r)
SELECT bin, {R('lo + bin * ((hi - lo) / 50)')} AS bin_start, {R('lo + (bin + 1) * ((hi - lo) / 50)')} AS bin_end, count(*) AS n
FROM b GROUP BY bin, lo, hi
""")
def q_hist(spark, sf):
    return rnd(ranking.cate_histogram(scored(spark, sf), bins=50))


_DECILE_CTE = SCORED_CTE + """
, q AS (SELECT quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM scored)
, b AS (SELECT s.*, CAST(len(list_filter(q.edges, lambda e: e < s.score)) + 1 AS INTEGER) AS decile FROM scored s, q)
, g AS (SELECT decile, avg(CASE WHEN treatment = 1 THEN CAST(conversion AS DOUBLE) END)
                       - avg(CASE WHEN treatment = 0 THEN CAST(conversion AS DOUBLE) END) AS actual_lift FROM b GROUP BY decile)
"""


@register("decile_lift_summary", _DECILE_CTE + f"""
SELECT {R('avg(actual_lift)')} AS mean_decile_lift, {R('arg_max(actual_lift, decile)')} AS top_lift,
  {R('arg_max(actual_lift, decile) / avg(actual_lift)')} AS decile_lift_ratio FROM g
""")
def q_decile_summary(spark, sf):
    d = ranking.decile_stats(scored(spark, sf))
    r = ranking.decile_lift_ratio(d)
    return rnd(r.select(F.col("mean_lift").alias("mean_decile_lift"), "top_lift", "decile_lift_ratio"))


@register("uplift_sample_enriched", CLASSIFIED_CTE + f"""
, sz AS (SELECT archetype_label, count(*) AS size FROM cl GROUP BY 1)
, tot AS (SELECT sum(size) AS total FROM sz)
, q0 AS (SELECT archetype_label, size, least(total, {SAMPLE_N}) AS k, least(total, {SAMPLE_N}) * size / total AS share,
           least(size, greatest(1, CAST(round_even(least(total, {SAMPLE_N}) * size / total, 0) AS BIGINT))) AS quota
         FROM sz, tot)
, qt AS (SELECT archetype_label, quota + CASE WHEN quota < size AND k - sum(quota) OVER () >=
           row_number() OVER (ORDER BY (quota < size) DESC, share - quota DESC, archetype_label NULLS LAST) THEN 1 ELSE 0 END AS quota
         FROM q0)
, rk AS (SELECT *, row_number() OVER (PARTITION BY archetype_label ORDER BY u1, unit_id) AS r
         FROM (SELECT *, {unit_uniform_sql('unit_id', 42)} AS u1 FROM cl) x)
, pk AS (SELECT rk.* FROM rk JOIN qt USING (archetype_label) WHERE r <= quota)
, tk AS (SELECT *, row_number() OVER (ORDER BY u2, unit_id) AS r2
         FROM (SELECT *, {unit_uniform_sql('unit_id', 43)} AS u2 FROM pk) y)
, smp AS (SELECT tk.* FROM tk, tot WHERE r2 <= least(total, {SAMPLE_N}))
, g AS (SELECT archetype_label, count(*) AS cnt, avg(score) AS u FROM cl GROUP BY 1)
, s2 AS (SELECT archetype_label, cnt * 100.0 / sum(cnt) OVER () AS pct_of_total,
           CASE WHEN archetype_label = 'Persuadable' THEN u * 10.0 - 0.1 ELSE 0.0 END AS expected_profit_per_user,
           CASE WHEN archetype_label = 'Persuadable' THEN 'BID' ELSE 'NO BID' END AS bid_recommendation FROM g)
SELECT CAST(r2 - 1 AS INTEGER) AS row_id, unit_id, smp.archetype_label, score AS uplift_score,
  {R('pct_of_total')} AS pct_of_total, {R('expected_profit_per_user')} AS expected_profit_per_user, bid_recommendation
FROM smp JOIN s2 USING (archetype_label)
""")
def q_sample_enriched(spark, sf):
    c = classified(spark, sf)
    smp = segments.stratified_sample(c, n=SAMPLE_N, seed=42)
    summ = segments.archetype_summary(c).select("archetype_label", "pct_of_total", "expected_profit_per_user",
                                                "bid_recommendation")
    out = smp.join(F.broadcast(summ), "archetype_label")   # one row per archetype on the small side
    return rnd(out.select(F.col("row_id").cast("int").alias("row_id"), "unit_id", "archetype_label",
                          F.col("score").alias("uplift_score"), "pct_of_total", "expected_profit_per_user",
                          "bid_recommendation"), keep=("uplift_score",))
