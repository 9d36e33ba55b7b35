"""Registered queries: monitoring periods, PSI drift, RAG counts, health, drift samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.functions.columns import unit_uniform_sql
from upshot.operators import monitor
from upshot.plans.registry import COST, R, SCORED_CTE, VALUE, register, rnd, scored
from upshot.plans.q_segments import SPLIT_SQL, split_flag
from upshot.sources.experiment import FEATURES

N_PERIODS = 8


def all_periods(spark, sf):
    return monitor.assign_periods(scored(spark, sf), "ts", N_PERIODS)


def test_periods(spark, sf):
    s = scored(spark, sf)
    return monitor.assign_periods(s.where(~split_flag()), "ts", N_PERIODS)


def train_ref(spark, sf):
    return scored(spark, sf).where(split_flag())


def _periods_cte(where: str) -> str:
    return SCORED_CTE + f"""
, te AS (SELECT *, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400 + hour(ts) * 3600
                    + minute(ts) * 60 + second(ts) AS es FROM scored WHERE {where})
, rg AS (SELECT min(es) AS s0, max(es) AS s1 FROM te)
, pe AS (SELECT te.*, CAST(((es - s0) * {N_PERIODS}) // (s1 - s0 + 1) AS INTEGER) + 1 AS period FROM te, rg)
"""


PERIODS_CTE = _periods_cte(f"NOT ({SPLIT_SQL})")     # PSI: the held-out rows against the training rows
ALL_PERIODS_CTE = _periods_cte("true")

_TS_PART = f"""
, ts AS (SELECT period AS week, 'Week ' || CAST(period AS VARCHAR) AS week_label, count(*) AS n_users,
           avg(CAST(score * {VALUE} > {COST} AS DOUBLE)) * 100 AS bid_rate_pct, avg(score) AS avg_uplift_score,
           avg(CAST(conversion AS DOUBLE)) AS avg_conversion_rate,
           avg(CASE WHEN score * {VALUE} > {COST} THEN score * {VALUE} - {COST} ELSE 0.0 END) AS expected_profit_per_user
         FROM pe GROUP BY period)
"""
TS_SQL = ALL_PERIODS_CTE + _TS_PART
_BAND_PART = """
, b AS (SELECT week, expected_profit_per_user * n_users AS pp FROM ts)
, c AS (SELECT week, pp, sum(pp) OVER (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp,
          CASE WHEN stddev_samp(pp) OVER w IS NOT NULL THEN avg(pp) OVER w END AS bm, stddev_samp(pp) OVER w AS bs
        FROM b WINDOW w AS (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
"""


@register("monitoring_timeseries", TS_SQL + f"""
SELECT week, week_label, n_users, {R('bid_rate_pct')} AS bid_rate_pct, {R('avg_uplift_score')} AS avg_uplift_score,
  {R('avg_conversion_rate')} AS avg_conversion_rate, {R('expected_profit_per_user')} AS expected_profit_per_user FROM ts
""")
def q_timeseries(spark, sf):
    return rnd(monitor.monitor_periods(all_periods(spark, sf), value=VALUE, cost=COST))


@register("control_band", TS_SQL + _BAND_PART + f"""
SELECT week, {R('pp', 6)} AS period_profit, {R('cp', 6)} AS cumulative_profit, {R('bm', 6)} AS band_mean, {R('bs', 6)} AS band_std,
  coalesce(abs(pp - bm) > 2.0 * bs, false) AS alert FROM c
""")
def q_band(spark, sf):
    ts = monitor.monitor_periods(all_periods(spark, sf), value=VALUE, cost=COST)
    b = monitor.control_band(ts)
    return rnd(b.select("week", "period_profit", "cumulative_profit", "band_mean", "band_std", "alert"), 6)


def _psi_sql() -> str:
    unp = lambda src: " UNION ALL ".join(
        f"SELECT {'period, ' if src == 'pe' else ''}'{f}' AS feature, {f} AS value FROM {src}" for f in FEATURES)
    probs = ", ".join(repr(i / 10) for i in range(11))
    binx = ("CASE WHEN value < edges[1] OR value > edges[11] THEN NULL WHEN value = edges[11] THEN 9 "
            "ELSE len(list_filter(edges, lambda e: e <= value)) - 1 END")
    return PERIODS_CTE + f"""
, tr AS (SELECT * FROM scored WHERE {SPLIT_SQL})
, rl AS ({unp('tr')})
, ed AS (SELECT feature, count(*) AS n_ref,
           list_transform(quantile_cont(value, [{probs}]),
                          lambda x, i: CASE WHEN i = 1 THEN x - 1e-7 WHEN i = 11 THEN x + 1e-7 ELSE x END) AS edges
         FROM rl GROUP BY feature)
, rc AS (SELECT feature, bin, count(*) AS ref_c FROM (SELECT rl.feature, {binx} AS bin FROM rl JOIN ed USING (feature)) x
         WHERE bin IS NOT NULL GROUP BY 1, 2)
, cl AS ({unp('pe')})
, cc AS (SELECT period, feature, bin, count(*) AS cur_c
         FROM (SELECT cl.period, cl.feature, {binx} AS bin FROM cl JOIN ed USING (feature)) x
         WHERE bin IS NOT NULL GROUP BY 1, 2, 3)
, cn AS (SELECT period, count(*) AS n_cur FROM pe GROUP BY period)
, g AS (SELECT cn.period, cn.n_cur, ed.feature, ed.n_ref, CAST(b.bin AS INTEGER) AS bin FROM cn, ed, range(0, 10) b(bin))
, f AS (SELECT g.*, coalesce(rc.ref_c, 0) AS ref_c, coalesce(cc.cur_c, 0) AS cur_c FROM g
        LEFT JOIN rc ON rc.feature = g.feature AND rc.bin = g.bin
        LEFT JOIN cc ON cc.period = g.period AND cc.feature = g.feature AND cc.bin = g.bin)
, p AS (SELECT period, feature,
          sum(((cur_c + 1e-7) / (n_cur + 1e-7 * 10) - (ref_c + 1e-7) / (n_ref + 1e-7 * 10))
              * ln(((cur_c + 1e-7) / (n_cur + 1e-7 * 10)) / ((ref_c + 1e-7) / (n_ref + 1e-7 * 10)))) AS psi
        FROM f GROUP BY period, feature)
, ps AS (SELECT period AS week, feature, psi,
           CASE WHEN {R('psi', 6)} < 0.1 THEN 'GREEN' WHEN {R('psi', 6)} < 0.25 THEN 'AMBER' ELSE 'RED' END AS rag_status FROM p)
"""


PSI_SQL = _psi_sql()


def psi_scores(spark, sf):
    p = monitor.psi(train_ref(spark, sf), test_periods(spark, sf), FEATURES, by=["period"])
    return p.select(F.col("period").alias("week"), "feature", "psi", "rag_status")


@register("psi_scores", PSI_SQL + f"SELECT week, feature, {R('psi')} AS psi, rag_status FROM ps")
def q_psi(spark, sf):
    return rnd(psi_scores(spark, sf))


@register("rag_counts", PSI_SQL + "SELECT rag_status, count(*) AS n FROM ps GROUP BY rag_status")
def q_rag(spark, sf):
    return monitor.rag_counts(psi_scores(spark, sf))


@register("model_health", PSI_SQL + _TS_PART + _BAND_PART + """
, al AS (SELECT max(CAST(coalesce(abs(pp - bm) > 2.0 * bs, false) AS INTEGER)) AS alert FROM c)
, rag AS (SELECT max(CAST(rag_status = 'RED' AS INTEGER)) AS red, max(CAST(rag_status = 'AMBER' AS INTEGER)) AS amber FROM ps)
SELECT CASE WHEN red = 1 THEN 'CRITICAL' WHEN amber = 1 OR alert = 1 THEN 'WARNING' ELSE 'HEALTHY' END AS model_health
FROM rag, al
""")
def q_health(spark, sf):
    band = monitor.control_band(monitor.monitor_periods(test_periods(spark, sf), value=VALUE, cost=COST))
    return monitor.model_health(psi_scores(spark, sf), band)


@register("drift_sample", ALL_PERIODS_CTE + f"""
, r AS (SELECT period, unit_id, score, row_number() OVER (PARTITION BY period ORDER BY {unit_uniform_sql('unit_id', 42)}, unit_id) AS rn
        FROM pe)
SELECT period AS week, unit_id, score AS uplift_score FROM r WHERE rn <= 500
""")
def q_drift(spark, sf):
    return monitor.drift_sample(all_periods(spark, sf), per_period=500)
