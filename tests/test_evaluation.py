import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from upshot.operators import ranking


def numpy_qini(t, y, s, unit):
    order = np.lexsort((unit, -s))          # score desc, unit asc
    t, y = t[order], y[order]
    cyt, cnt = np.cumsum(y * (t == 1)), np.cumsum(t == 1).astype(float)
    cyc, cnc = np.cumsum(y * (t == 0)), np.cumsum(t == 0).astype(float)
    q = (cyt / np.maximum(cnt, 1) - cyc / np.maximum(cnc, 1)) * (cnt + cnc)
    n = len(q)
    x = np.arange(n) / (n - 1)
    return q, np.sum((x[1:] - x[:-1]) * (q[1:] + q[:-1]) / 2)


def planted(n=10000, seed=1):
    rng = np.random.default_rng(seed)
    score = np.linspace(-0.1, 0.5, n)
    t = rng.integers(0, 2, n)
    p = np.clip(0.1 + t * score, 0, 1)
    y = (rng.random(n) < p).astype(int)
    return pd.DataFrame({"unit_id": np.arange(n), "score": score, "treatment": t, "conversion": y})


def test_deciles_planted(spark):
    pdf = planted()
    d = {r["decile"]: r for r in ranking.decile_stats(spark.createDataFrame(pdf), n_bins=5).collect()}
    assert d[5]["actual_lift"] > 0.3 and d[5]["actual_lift"] > d[1]["actual_lift"] and d[1]["actual_lift"] < 0.2
    assert sum(r["n_obs"] for r in d.values()) == len(pdf)


def test_qini_matches_numpy_with_ties(spark):
    rng = np.random.default_rng(2)
    n = 3000
    pdf = pd.DataFrame({"unit_id": rng.permutation(n), "score": np.floor(rng.random(n) * 7) / 7,
                        "treatment": rng.integers(0, 2, n), "conversion": rng.integers(0, 2, n)})
    q, auuc = numpy_qini(pdf.treatment.to_numpy(), pdf.conversion.to_numpy(), pdf.score.to_numpy(),
                         pdf.unit_id.to_numpy())
    rows = ranking.qini_rows(spark.createDataFrame(pdf), buckets=8).toPandas().sort_values("idx")
    assert list(rows.idx) == list(range(n))
    assert np.allclose(rows.qini.to_numpy(), q, atol=1e-9)
    curve = ranking.qini_curve(spark.createDataFrame(pdf), n_points=1000, buckets=8).toPandas()
    assert len(curve) == 1000 and abs(curve.auuc.iloc[0] - auuc) < 1e-9
    idx = (np.arange(1000) * (n - 1)) // 999
    assert np.allclose(curve.sort_values("point").qini.to_numpy(), q[idx], atol=1e-9)
    # last value equals (rate_t - rate_c) * n
    tt, yy = pdf.treatment.to_numpy(), pdf.conversion.to_numpy()
    assert abs(q[-1] - (yy[tt == 1].mean() - yy[tt == 0].mean()) * n) < 1e-6


def test_qini_same_with_one_or_many_buckets(spark):
    pdf = planted(2000, 4)
    a = ranking.qini_curve(spark.createDataFrame(pdf), n_points=50, buckets=1).toPandas().sort_values("point")
    b = ranking.qini_curve(spark.createDataFrame(pdf), n_points=50, buckets=16).toPandas().sort_values("point")
    assert np.allclose(a.qini.to_numpy(), b.qini.to_numpy()) and abs(a.auuc.iloc[0] - b.auuc.iloc[0]) < 1e-9


def test_bootstrap_band(spark):
    rng = np.random.default_rng(9)
    n = 2000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "score": rng.random(n), "treatment": rng.integers(0, 2, n),
                        "conversion": rng.integers(0, 2, n)})
    band = ranking.bootstrap_qini(spark.createDataFrame(pdf), n_bootstraps=20, n_points=1000, n_buckets=100).toPandas()
    assert len(band) == 1000
    assert (band.y_upper_95ci >= band.y_mean - 1e-9).all() and (band.y_mean >= band.y_lower_95ci - 1e-9).all()
    assert band.auuc_std.iloc[0] >= 0


def test_bootstrap_draws_per_cell(spark):
    """One draw for a cell and replicate, however many rows it has; draws are Poisson with the cell's count as mean."""
    cells = spark.createDataFrame([(1, 0, 0.0, 40), (1, 1, 1.0, 5_000), (2, 1, 0.5, 10**9)], "bucket int, arm long, y double, n long")
    w = ranking.bootstrap_draws(cells, 2000).toPandas()
    assert len(w) == 3 * 2000 and not w.duplicated(["b", "bucket", "arm"]).any()
    for (_, arm, y), g in w.groupby(["bucket", "arm", "y"]):
        n = {0.0: 40, 1.0: 5_000, 0.5: 10**9}[y]
        assert abs(g.w.mean() - n) < 5 * np.sqrt(n / 2000) and abs(g.w.var() / n - 1) < 0.2
    assert w.equals(ranking.bootstrap_draws(cells, 2000).toPandas())


def test_bootstrap_does_not_multiply_the_rows(spark, monkeypatch):
    rng = np.random.default_rng(10)
    n = 20_000
    pdf = pd.DataFrame({"score": np.round(rng.random(n), 3), "treatment": rng.integers(0, 2, n), "conversion": rng.integers(0, 2, n)})
    holes = pd.DataFrame({"score": [None, 0.5, 0.5], "treatment": [1.0, None, 1.0], "conversion": [1.0, 1.0, None]})
    df = spark.createDataFrame(pd.concat([pdf, holes])).select(
        *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in ("score", "treatment", "conversion")])
    written = []
    plain = ranking.checkpointed
    monkeypatch.setattr(ranking, "checkpointed", lambda d: written.append(plain(d)) or written[-1])
    band = ranking.bootstrap_qini(df, n_bootstraps=30, n_points=11, n_buckets=50)
    rows = band.collect()
    assert written[0].count() <= 50 * 4 and written[0].agg(F.sum("n")).first()[0] == n
    assert written[1].count() <= 30 * 50 and len(rows) == 11


def test_histogram_counts_sum(spark):
    pdf = planted(1000, 5)
    h = ranking.cate_histogram(spark.createDataFrame(pdf), bins=50).toPandas()
    assert h.n.sum() == 1000 and h.bin.max() == 49


def test_tie_aware_qini_matches_row_curve_at_boundaries(spark):
    rng = np.random.default_rng(3)
    n = 3000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "score": np.floor(rng.random(n) * 6) / 6,
                        "treatment": rng.integers(0, 2, n), "conversion": rng.integers(0, 2, n)})
    q, _ = numpy_qini(pdf.treatment.to_numpy(), pdf.conversion.to_numpy(), pdf.score.to_numpy(),
                      pdf.unit_id.to_numpy())
    ties = ranking.qini_tie_aware(spark.createDataFrame(pdf), rows_per_bucket=2).toPandas().sort_values("n_cum")
    assert len(ties) == 6 and ties.n_cum.iloc[-1] == n
    assert np.allclose(ties.qini.to_numpy(), q[ties.n_cum.to_numpy() - 1], atol=1e-9)  # equal at tie ends
    x = np.concatenate([[0.0], ties.population_pct.to_numpy()])
    y = np.concatenate([[0.0], ties.qini.to_numpy()])
    assert abs(ties.auuc.iloc[0] - np.sum((x[1:] - x[:-1]) * (y[1:] + y[:-1]) / 2)) < 1e-9


def test_qini_does_not_depend_on_exchange_reuse(spark):
    pdf = planted(n=4000).assign(score=lambda d: d.score.round(2))
    frame = spark.createDataFrame(pdf).repartition(7)
    got = []
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            with_conf = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive}
            before = {k: spark.conf.get(k) for k in with_conf}
            try:
                for k, v in with_conf.items():
                    spark.conf.set(k, v)
                curve = ranking.qini_curve(frame, n_points=100, buckets=8).toPandas().sort_values("point")
                ties = ranking.qini_tie_aware(frame, rows_per_bucket=500).toPandas().sort_values("n_cum")
                got.append((curve.qini.to_numpy(), curve.auuc.iloc[0], ties.qini.to_numpy(), ties.auuc.iloc[0]))
            finally:
                for k, v in before.items():
                    spark.conf.set(k, v)
    for other in got[1:]:
        for a, b in zip(got[0], other, strict=True):
            np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-9)


def test_null_scores_take_no_part_in_deciles_and_histogram(spark):
    full = spark.createDataFrame(planted(n=500))
    holes = full.unionByName(full.limit(7).selectExpr("unit_id", "cast(null as double) score", "treatment", "conversion"))
    for f, key in ((ranking.decile_stats, "decile"), (ranking.cate_histogram, "bin")):
        a, b = (sorted(f(d).collect(), key=lambda r: r[key]) for d in (full, holes))
        assert a == b and all(r[key] is not None for r in a)
