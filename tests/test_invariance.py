"""Results must not depend on the physical layout (shuffle partitions, input partitioning)."""

import numpy as np
import pandas as pd

from conftest import SF01

from upshot.operators import monitor, ranking, segments
from upshot.plans.registry import scored


def _run(spark, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        s = scored(spark, SF01)
        d = ranking.decile_stats(s).toPandas().sort_values("decile").reset_index(drop=True)
        q = ranking.qini_curve(s, n_points=200, buckets=4).toPandas().sort_values("point").reset_index(drop=True)
        smp = segments.stratified_sample(segments.classify(s.withColumn("baseline_conversion_prob", s.f1 * 0)),
                                         n=700).toPandas()
        return d, q, set(smp.unit_id)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_same_result_with_1_and_64_partitions(spark):
    d1, q1, s1 = _run(spark, 1)
    d2, q2, s2 = _run(spark, 64)
    assert d1[["decile", "n_obs", "n_control", "n_treatment"]].equals(d2[["decile", "n_obs", "n_control", "n_treatment"]])
    assert np.allclose(d1.actual_lift, d2.actual_lift, atol=1e-12, equal_nan=True)
    assert np.allclose(q1.qini, q2.qini, atol=1e-9) and abs(q1.auuc[0] - q2.auuc[0]) < 1e-9
    assert s1 == s2


def test_psi_input_partitioning_does_not_matter(spark):
    rng = np.random.default_rng(61)
    ref = pd.DataFrame({"a": rng.normal(size=4000)})
    cur = pd.DataFrame({"a": rng.normal(0.3, 1, 2000)})
    r = spark.createDataFrame(ref)
    c = spark.createDataFrame(cur)
    p1 = monitor.psi(r.repartition(1), c.repartition(1), ["a"]).first()["psi"]
    p2 = monitor.psi(r.repartition(13), c.repartition(7), ["a"]).first()["psi"]
    assert abs(p1 - p2) < 1e-12


def test_poisson_bootstrap_close_to_exact_bootstrap(spark):
    """Band from Poisson weights and score buckets vs a plain NumPy bootstrap (same data)."""
    rng = np.random.default_rng(62)
    n = 4000
    score = rng.random(n)
    t = rng.integers(0, 2, n)
    y = (rng.random(n) < 0.1 + 0.2 * t * score).astype(int)
    pdf = pd.DataFrame({"unit_id": np.arange(n), "score": score, "treatment": t, "conversion": y})
    band = ranking.bootstrap_qini(spark.createDataFrame(pdf), n_bootstraps=60, n_points=101, n_buckets=200).toPandas()

    def curve(tt, yy, ss):
        o = np.argsort(-ss, kind="stable")
        tt, yy = tt[o], yy[o]
        nt, nc = np.cumsum(tt == 1), np.cumsum(tt == 0)
        q = (np.cumsum(yy * (tt == 1)) / np.maximum(nt, 1) - np.cumsum(yy * (tt == 0)) / np.maximum(nc, 1)) * (nt + nc)
        return np.interp(np.linspace(0, 1, 101), np.linspace(0, 1, len(q)), q)

    boot = np.array([curve(t[i], y[i], score[i]) for i in (rng.integers(0, n, n) for _ in range(200))])
    mean_np = boot.mean(axis=0)
    width_np = np.percentile(boot, 97.5, axis=0) - np.percentile(boot, 2.5, axis=0)
    band = band.sort_values("point")
    mid = slice(20, 101)
    # means agree within a fraction of the band width; widths agree within 35 %
    assert np.all(np.abs(band.y_mean.to_numpy()[mid] - mean_np[mid]) < 0.35 * width_np[mid] + 1.0)
    ratio = (band.y_upper_95ci - band.y_lower_95ci).to_numpy()[mid] / width_np[mid]
    assert 0.65 < np.median(ratio) < 1.35
