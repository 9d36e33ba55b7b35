"""Registered streaming queries (L1-L5): run to completion with availableNow, then read the sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from upshot.operators.learners import Distiller
from upshot.plans.bandit_sql import rounds_cte
from upshot.plans.registry import COST, R, VALUE, register, rnd
from upshot.sources.tables import read_table
from upshot.streaming import events as st

ROUNDS, SPANS = 10, 5


def arriving(spark, sf, spans=SPANS, late=None) -> st.Arrivals:
    """The events table as a stream source that receives it span by span."""
    return st.Arrivals(read_table(spark, sf, "events"), spans, late)


EV_CTE = f"WITH ev AS ({st.EVENT_COLUMNS_SQL})\n"
WIN = (f"CAST(floor((date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 86400 "
       f"+ hour(ts) * 3600 + minute(ts) * 60 + second(ts)) / {st.WEEK}) AS BIGINT) * {st.WEEK}")


@register("stream_monitor", EV_CTE + f"""
SELECT {WIN} AS window_start, count(*) AS n_events,
  {R(f'avg(CAST(score * {VALUE} > {COST} AS DOUBLE)) * 100')} AS bid_rate_pct, {R('avg(score)')} AS avg_uplift_score,
  {R('avg(CAST(conversion AS DOUBLE))')} AS avg_conversion_rate,
  {R(f'avg(CASE WHEN score * {VALUE} > {COST} THEN score * {VALUE} - {COST} ELSE 0.0 END)')} AS expected_profit_per_user
FROM ev GROUP BY 1
""")
def q_stream_monitor(spark, sf):
    source = arriving(spark, sf)
    return rnd(st.stream_monitor(spark, source.folder, VALUE, COST, feed=source))


@register("stream_srm", EV_CTE + f"""
, c AS (SELECT {WIN} AS window_start, count(CASE WHEN treatment = 0 THEN 1 END) AS n_control,
          count(CASE WHEN treatment = 1 THEN 1 END) AS n_treatment FROM ev GROUP BY 1)
, x AS (SELECT *, power(n_control - (n_control + n_treatment) * 0.15000000000000002, 2) / ((n_control + n_treatment) * 0.15000000000000002)
             + power(n_treatment - (n_control + n_treatment) * 0.85, 2) / ((n_control + n_treatment) * 0.85) AS chi2 FROM c)
SELECT window_start, n_control, n_treatment, {R('chi2')} AS chi2, chi2 < 10.827566170662733 AS valid FROM x
""")
def q_stream_srm(spark, sf):
    source = arriving(spark, sf)
    return rnd(st.stream_srm(spark, source.folder, feed=source))


def _event_reference(spark, sf):
    """The first 7-day window of events is the PSI reference period."""
    ev = st.event_columns(read_table(spark, sf, "events"))
    w = F.window("ts", "7 days")  # same epoch-aligned windows as the stream
    first = ev.agg(F.min(w.start).alias("_s"))
    return ev.crossJoin(first).where(w.start == F.col("_s")).drop("_s")


def _stream_psi_sql() -> str:
    probs = ", ".join(repr(i / 10) for i in range(11))
    binx = ("CASE WHEN value < edges[1] OR value > edges[11] THEN NULL WHEN value = edges[11] THEN 9 "
            "ELSE len(list_filter(edges, lambda e: e <= value)) - 1 END")
    return EV_CTE + f"""
, w AS (SELECT *, {WIN} AS window_start FROM ev)
, ref AS (SELECT * FROM w WHERE window_start = (SELECT min(window_start) FROM w))
, rl AS (SELECT 'x_value' AS feature, x_value AS value FROM ref UNION ALL SELECT 'x_hour', x_hour FROM ref)
, ed AS (SELECT feature, count(*) AS n_ref,
           list_transform(quantile_cont(value, [{probs}]),
                          lambda x, i: CASE WHEN i = 1 THEN x - 1e-7 WHEN i = 11 THEN x + 1e-7 ELSE x END) AS edges
         FROM rl GROUP BY feature)
, rc AS (SELECT feature, bin, count(*) AS ref_c FROM (SELECT rl.feature, {binx} AS bin FROM rl JOIN ed USING (feature)) x
         WHERE bin IS NOT NULL GROUP BY 1, 2)
, cl AS (SELECT window_start, 'x_value' AS feature, x_value AS value FROM w
         UNION ALL SELECT window_start, 'x_hour', x_hour FROM w)
, cc AS (SELECT window_start, feature, bin, count(*) AS cur_c
         FROM (SELECT cl.window_start, cl.feature, {binx} AS bin FROM cl JOIN ed USING (feature)) x
         WHERE bin IS NOT NULL GROUP BY 1, 2, 3)
, cn AS (SELECT window_start, count(*) AS n_cur FROM w GROUP BY 1)
, g AS (SELECT cn.window_start, cn.n_cur, ed.feature, ed.n_ref, CAST(b.bin AS INTEGER) AS bin FROM cn, ed, range(0, 10) b(bin))
, f AS (SELECT g.*, coalesce(rc.ref_c, 0) AS ref_c, coalesce(cc.cur_c, 0) AS cur_c FROM g
        LEFT JOIN rc ON rc.feature = g.feature AND rc.bin = g.bin
        LEFT JOIN cc ON cc.window_start = g.window_start AND cc.feature = g.feature AND cc.bin = g.bin)
, p AS (SELECT window_start, feature,
          sum(((cur_c + 1e-7) / (n_cur + 1e-7 * 10) - (ref_c + 1e-7) / (n_ref + 1e-7 * 10))
              * ln(((cur_c + 1e-7) / (n_cur + 1e-7 * 10)) / ((ref_c + 1e-7) / (n_ref + 1e-7 * 10)))) AS psi
        FROM f GROUP BY 1, 2)
SELECT window_start, feature, {R('psi')} AS psi,
  CASE WHEN {R('psi')} < 0.1 THEN 'GREEN' WHEN {R('psi')} < 0.25 THEN 'AMBER' ELSE 'RED' END AS rag_status FROM p
"""


@register("stream_psi", _stream_psi_sql())
def q_stream_psi(spark, sf):
    ref = _event_reference(spark, sf)
    edges = st.with_ref_counts(ref, st.reference_edges(ref))
    source = arriving(spark, sf)
    return rnd(st.stream_psi(spark, source.folder, edges, feed=source))


@register("stream_ingest", EV_CTE + f"""
, m AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM ev)
, again AS (SELECT count(*) FILTER (ts <= mark) AS n_late, count(*) FILTER (ts > mark) AS n_duplicate FROM ev, m WHERE event_id % 10 = 3)
SELECT {WIN} AS window_start, count(*) AS n_events, count(DISTINCT event_id) AS n_ids, n_late, n_duplicate
FROM ev, again GROUP BY 1, n_late, n_duplicate
""")
def q_stream_ingest(spark, sf):
    """Every tenth event is sent again after all others: none may be let in twice, and all are accounted for."""
    again = read_table(spark, sf, "events").where("event_id % 10 = 3")
    source = arriving(spark, sf, late=again)
    rows, dropped = st.stream_ingest(spark, source.folder, feed=source)
    out = rows.groupBy(F.unix_seconds(F.window("ts", "7 days").start).alias("window_start")).agg(
        F.count(F.lit(1)).alias("n_events"), F.countDistinct("event_id").alias("n_ids"))
    return out.select("*", F.lit(dropped["late"]).cast("long").alias("n_late"),
                      F.lit(dropped["duplicate"]).cast("long").alias("n_duplicate"))


@register("stream_score", EV_CTE + f"""
, k AS (SELECT regr_slope(score, x_value) AS b, regr_intercept(score, x_value) AS a FROM ev)
, s AS (SELECT a + b * x_value AS uplift FROM ev, k)
SELECT CASE WHEN uplift * {VALUE} - {COST} > 0 THEN 'BID' ELSE 'NO BID' END AS decision, count(*) AS n,
  {R(f'avg(uplift * {VALUE} - {COST})')} AS avg_expected_profit FROM s GROUP BY 1
""")
def q_stream_score(spark, sf):
    ev = st.event_columns(read_table(spark, sf, "events"))
    student = Distiller(["x_value"], "linear").fit(ev, "score")
    source = arriving(spark, sf)
    out = st.stream_score(spark, source.folder, lambda df: student.predict(df, "uplift_score"), VALUE, COST, feed=source)
    return rnd(out.groupBy("decision").agg(F.count(F.lit(1)).alias("n"), F.avg("expected_profit").alias("avg_expected_profit")))


def _linucb_sql(rounds: int) -> str:
    return EV_CTE.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, t AS (SELECT *, epoch_us(ts) AS us FROM ev)
, g AS (SELECT min(us) AS lo, max(us) AS hi FROM t)
, e AS (SELECT CAST(coalesce(floor((us - lo) * {rounds} / (hi - lo + 1)), 0) AS INTEGER) AS round, treatment AS arm,
          x_value / 100.0 AS x0, x_hour / 10.0 AS x1, conversion * {VALUE} - treatment * {COST} AS r FROM t, g)
""" + rounds_cte(rounds) + f"""
SELECT CAST(round AS BIGINT) AS batch_id, matched, {R('reward')} AS reward,
  {R('CASE WHEN matched > 0 THEN reward / matched ELSE 0.0 END')} AS avg_profit FROM s WHERE round >= 0
"""


@register("stream_linucb", _linucb_sql(ROUNDS))
def q_stream_linucb(spark, sf):
    source = arriving(spark, sf, ROUNDS)
    return rnd(st.stream_linucb(spark, source.folder, value=VALUE, cost=COST, feed=source))
