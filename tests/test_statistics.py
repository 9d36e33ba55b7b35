import numpy as np
import pandas as pd

from upshot.operators import effects


def test_ate_planted(spark):
    rng = np.random.default_rng(11)
    t = np.array([0] * 5000 + [1] * 5000)
    y = np.where(t == 1, rng.normal(0.6, 1, 10000), rng.normal(0.5, 1, 10000))
    r = effects.ate(spark.createDataFrame(pd.DataFrame({"treatment": t, "conversion": y})), "conversion",
                    with_p=True).first()
    assert 0.05 < r["absolute_effect"] < 0.15 and r["p_value"] < 0.05
    se = np.sqrt(y[t == 0].var(ddof=1) / 5000 + y[t == 1].var(ddof=1) / 5000)
    assert abs(r["std_error"] - se) < 1e-12
    assert r["ci_lower"] < r["absolute_effect"] < r["ci_upper"]


def test_cuped_reduces_se(spark):
    rng = np.random.default_rng(12)
    n = 10000
    t = rng.integers(0, 2, n)
    f0 = rng.normal(10, 2, n)
    y = f0 + 0.5 * t + rng.normal(0, 0.5, n)
    df = spark.createDataFrame(pd.DataFrame({"treatment": t, "conversion": y, "f0": f0}))
    a = effects.ate(df, "conversion").first()
    c = effects.cuped(df, "conversion", ["f0"]).first()
    assert c["std_error"] < a["std_error"]
    assert abs(c["absolute_effect"] - 0.5) < 0.1
    theta, _ = effects.cuped_theta(df, "conversion", ["f0"])
    xc = f0 - f0.mean()
    expect = np.linalg.lstsq(xc[:, None], y, rcond=None)[0]
    assert np.allclose(theta, expect, rtol=1e-9)
    single = effects.cuped_single(df, "conversion", "f0").first()
    assert abs(single["absolute_effect"] - c["absolute_effect"]) < 1e-9


def test_cuped_many_covariates_matches_lstsq(spark):
    rng = np.random.default_rng(13)
    n = 3000
    X = rng.normal(size=(n, 3))
    y = X @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(conversion=y, treatment=rng.integers(0, 2, n))
    theta, _ = effects.cuped_theta(spark.createDataFrame(pdf), "conversion", ["a", "b", "c"])
    Xc = X - X.mean(axis=0)
    assert np.allclose(theta, np.linalg.lstsq(Xc, y, rcond=None)[0], rtol=1e-8)


def test_relative_effect_zero_control(spark):
    df = spark.createDataFrame(pd.DataFrame({"treatment": [0, 0, 1, 1], "conversion": [0.0, 0.0, 1.0, 0.0]}))
    assert effects.ate(df, "conversion").first()["relative_effect"] == 0.0


def test_baseline_ab_and_economics(spark):
    pdf = pd.DataFrame({"treatment": [0] * 100 + [1] * 100, "conversion": [1] * 10 + [0] * 90 + [1] * 20 + [0] * 80})
    df = spark.createDataFrame(pdf)
    rows = {r["treatment"]: r for r in effects.baseline_ab(df).collect()}
    assert abs(rows[1]["ate"] - 0.1) < 1e-12 and abs(rows[1]["relative_lift_pct"] - 100.0) < 1e-9
    assert abs(rows[0]["ci_margin"] - 1.96 * np.sqrt(0.1 * 0.9 / 100)) < 1e-12
    e = effects.economics(df, value=10.0, cost=0.1).first()
    assert abs(e["baseline_profit_as_run"] - (0.15 * 10 - 0.1 * 0.5)) < 1e-12
    assert abs(e["incremental_profit_per_user"] - ((0.2 * 10 - 0.1) - 0.1 * 10)) < 1e-12


def test_cuped_rank_deficient_is_min_norm(spark):
    rng = np.random.default_rng(14)
    n = 2000
    a = rng.normal(size=n)
    X = np.column_stack([a, a, rng.normal(size=n)])        # duplicated covariate
    y = 2 * a + 0.5 * X[:, 2] + rng.normal(size=n)
    pdf = pd.DataFrame(X, columns=["a", "a2", "c"]).assign(conversion=y, treatment=rng.integers(0, 2, n))
    theta, _ = effects.cuped_theta(spark.createDataFrame(pdf), "conversion", ["a", "a2", "c"])
    Xc = X - X.mean(axis=0)
    want = np.linalg.lstsq(Xc, y - y.mean(), rcond=None)[0]
    assert np.allclose(theta, want, atol=1e-8) and abs(theta[0] - theta[1]) < 1e-8


def test_one_arm_frame_gives_null_effect(spark):
    df = spark.createDataFrame(pd.DataFrame({"treatment": [1, 1, 1], "conversion": [0.0, 1.0, 1.0]}))
    r = effects.ate(df, "conversion").first()
    assert r["n_c"] == 0 and r["absolute_effect"] is None and r["std_error"] is None


def test_p_values_equal_the_error_function(spark):
    import math

    from upshot.functions import dist
    zs = [0.0, 0.5, 1.96, 3.0, 7.5, 20.0]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in zip(zs, [r[0] for r in df.select(dist.normal_two_sided_p("z")).collect()], strict=True):
        want = math.erfc(z / math.sqrt(2))
        assert abs(p - want) <= 1e-14 + 1e-9 * want
    chi = [r[0] for r in spark.createDataFrame([(3.841458820694124,)], "c double")
           .select(dist.chi2_1dof_p("c")).collect()]
    assert abs(chi[0] - 0.05) < 1e-12


def test_plain_and_adjusted_effect_from_one_read(spark, tmp_path):
    """Moment matrices against the adjusted column itself, with nulls, a third arm and a null arm."""
    import re

    from pyspark.sql import functions as F
    rng = np.random.default_rng(21)
    n = 6000
    X = rng.normal(size=(n, 3)) * [1.0, 50.0, 1e-3] + [0.0, 1e4, 5.0]
    t = rng.integers(0, 2, n)
    y = X @ np.array([0.4, 0.01, 90.0]) + 0.3 * t + rng.normal(size=n)
    pdf = pd.DataFrame(X, columns=["a", "b", "c"]).assign(conversion=y, treatment=t)
    path = str(tmp_path / "rows")
    rows = spark.createDataFrame(pdf)
    odd = rows.limit(50)
    rows = (rows.unionByName(odd.withColumn("treatment", F.lit(2))).unionByName(odd.withColumn("treatment", F.lit(None).cast("long")))
            .unionByName(odd.withColumn("b", F.lit(None).cast("double"))).unionByName(odd.withColumn("conversion", F.lit(None).cast("double"))))
    rows.write.parquet(path)
    df = spark.read.parquet(path)
    plan = effects.arm_moments(df, "conversion", ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", plan)) == 1
    raw, adjusted = [r.first() for r in effects.ate_and_cuped(df, "conversion", ["a", "b", "c"], with_p=True)]
    p = df.toPandas()
    ok = p.dropna(subset=["a", "b", "c", "conversion", "treatment"])
    theta, centre = effects.cuped_theta(df.where("treatment IS NOT NULL"), "conversion", ["a", "b", "c"])
    x = ok[["a", "b", "c"]].to_numpy()
    assert np.allclose(theta, np.linalg.lstsq(x - x.mean(0), ok.conversion - ok.conversion.mean(), rcond=None)[0], rtol=1e-8)
    adj = ok.conversion - (x - centre) @ theta
    c, tr = adj[ok.treatment == 0], adj[ok.treatment == 1]
    assert adjusted["n_c"] == len(c) and adjusted["n_t"] == len(tr)
    assert abs(adjusted["absolute_effect"] - (tr.mean() - c.mean())) < 1e-9
    assert abs(adjusted["std_error"] - np.sqrt(c.var(ddof=1) / len(c) + tr.var(ddof=1) / len(tr))) < 1e-9
    plain = effects.ate(df, "conversion").first()
    assert all(abs(raw[k] - plain[k]) < 1e-9 for k in ("absolute_effect", "std_error", "n_c", "n_t"))


def test_cuped_theta_from_sample(spark):
    from upshot.functions.sampling import cuped_sample_size
    rng = np.random.default_rng(15)
    n = 20000
    t = rng.integers(0, 2, n)
    f0 = rng.normal(10, 2, n)
    y = f0 + 0.5 * t + rng.normal(0, 0.5, n)
    df = spark.createDataFrame(pd.DataFrame({"unit_id": np.arange(n), "treatment": t, "conversion": y, "f0": f0}))
    full = effects.cuped(df, "conversion", ["f0"]).first()
    samp = effects.cuped(df, "conversion", ["f0"], theta_sample=cuped_sample_size(n, floor_n=2000)).first()
    assert abs(full["absolute_effect"] - samp["absolute_effect"]) < 0.02
    assert samp["std_error"] < effects.ate(df, "conversion").first()["std_error"]
