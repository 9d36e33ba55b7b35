import numpy as np
import pandas as pd

from upshot.operators import validation


def test_srm_pass_exact_split(spark):
    df = spark.createDataFrame(pd.DataFrame({"treatment": [1] * 8500 + [0] * 1500, "f0": np.arange(10000.0)}))
    r = validation.check_srm(df, expected_ratio=0.85, with_p=True).first()
    assert r["valid"] and r["n_control"] == 1500 and r["n_treatment"] == 8500
    assert r["chi2"] < 1e-20 and abs(r["p_value"] - 1.0) < 1e-12  # 1 - 0.85 is not exact in binary


def test_srm_fail_half_split(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame({"treatment": rng.integers(0, 2, 1000)}))
    r = validation.check_srm(df, expected_ratio=0.85, with_p=True).first()
    assert not r["valid"] and r["p_value"] < 0.001


def test_balance(spark):
    rng = np.random.default_rng(5)
    t = rng.integers(0, 2, 1000)
    pdf = pd.DataFrame({"treatment": t, "f0": rng.normal(10, 2, 1000),
                        "f1": np.where(t == 1, rng.normal(100, 5, 1000), rng.normal(0, 5, 1000))})
    out = {r["feature"]: r for r in validation.covariate_balance(spark.createDataFrame(pdf), ["f0", "f1"]).collect()}
    assert abs(out["f0"]["smd"]) < 0.15 and out["f0"]["is_balanced"]
    assert abs(out["f1"]["smd"]) > 1.0 and not out["f1"]["is_balanced"]
    # independent NumPy check
    a, b = pdf[pdf.treatment == 1].f0, pdf[pdf.treatment == 0].f0
    smd = (a.mean() - b.mean()) / np.sqrt((a.var(ddof=1) + b.var(ddof=1)) / 2)
    assert abs(out["f0"]["smd"] - smd) < 1e-12


def test_zero_pooled_std_gives_zero(spark):
    df = spark.createDataFrame(pd.DataFrame({"treatment": [0, 0, 1, 1], "f0": [1.0, 1.0, 1.0, 1.0]}))
    r = validation.covariate_balance(df, ["f0"]).first()
    assert r["smd"] == 0.0 and r["is_balanced"]


def test_imbalanced_top_k_by_absolute_smd(spark):
    rows = [(0, "a", 0.5, 0.5, False), (1, "b", -0.9, 0.9, False), (2, "c", 0.2, 0.2, False), (3, "d", 0.0, 0.0, True)]
    bal = spark.createDataFrame(rows, "feature_idx int, feature string, smd double, abs_smd double, is_balanced boolean")
    assert [r["feature"] for r in validation.imbalanced_features(bal, 2).collect()] == ["b", "a"]


def test_srm_on_fail_raise(spark):
    import pytest
    df = spark.createDataFrame(pd.DataFrame({"treatment": [0, 1] * 500}))
    with pytest.raises(validation.SampleRatioMismatch):
        validation.check_srm(df, expected_ratio=0.85, on_fail="raise")
    ok = spark.createDataFrame(pd.DataFrame({"treatment": [1] * 850 + [0] * 150}))
    assert validation.check_srm(ok, on_fail="raise").first()["valid"]


def test_integrity_equals_separate_checks(spark):
    rng = np.random.default_rng(9)
    t = rng.integers(0, 2, 3000)
    df = spark.createDataFrame(pd.DataFrame({"treatment": t, "f0": rng.normal(size=3000), "f1": t + rng.normal(size=3000)}))
    srm, bal = validation.integrity(df, ["f0", "f1"], expected_ratio=0.5)
    a = srm.first()
    b = validation.check_srm(df, expected_ratio=0.5, with_p=True).first()
    assert a["n_control"] == b["n_control"] and abs(a["chi2"] - b["chi2"]) < 1e-12 and a["valid"] == b["valid"]
    x = {r["feature"]: r["smd"] for r in bal.collect()}
    y = {r["feature"]: r["smd"] for r in validation.covariate_balance(df, ["f0", "f1"]).collect()}
    assert all(abs(x[k] - y[k]) < 1e-12 for k in y)
