import numpy as np
import pandas as pd
import pytest

from upshot.sources import loader


def test_read_and_narrow(spark, tmp_path):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.random((100, 12)), columns=[f"f{i}" for i in range(12)])
    for c in ["treatment", "conversion", "visit", "exposure"]:
        pdf[c] = rng.integers(0, 2, 100)
    path = str(tmp_path / "exp.parquet")
    pdf.to_parquet(path)
    df = loader.read_experiment(spark, path)
    types = dict(df.dtypes)
    assert df.count() == 100 and len(df.columns) == 16
    assert types["f0"] == "float" and types["f11"] == "float" and types["treatment"] == "tinyint"


def test_missing_columns_and_file(spark, tmp_path):
    path = str(tmp_path / "bad.parquet")
    pd.DataFrame({"f0": [1.0]}).to_parquet(path)
    with pytest.raises(ValueError, match="treatment"):
        loader.read_experiment(spark, path)
    with pytest.raises(FileNotFoundError):
        loader.read_experiment(spark, str(tmp_path / "nope.parquet"))


def test_treatment_only_guard(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    pd.DataFrame({"treatment": [0, 1, 1], "x": [1.0, 2.0, 3.0]}).to_parquet(path)
    df = loader.read_experiment(spark, path, required=["treatment"])
    assert dict(df.dtypes)["treatment"] == "tinyint" and dict(df.dtypes)["x"] == "float"


def test_validation_cli(spark, tmp_path):
    from upshot.plans import validate_cli
    rng = np.random.default_rng(3)
    t = np.array([1] * 850 + [0] * 150)
    path = str(tmp_path / "v.parquet")
    pd.DataFrame({"treatment": t, "f0": rng.normal(size=1000), "f1": t * 5.0 + rng.normal(size=1000)}).to_parquet(path)
    srm, balance, worst = validate_cli.run(spark, path)
    assert srm.first()["valid"]
    assert [r["feature"] for r in worst.collect()] == ["f1"]


def test_baseline_cli(spark, tmp_path):
    from upshot.plans import baseline_cli
    path = str(tmp_path / "b.parquet")
    pd.DataFrame({"treatment": [0] * 100 + [1] * 100,
                  "conversion": [1] * 10 + [0] * 90 + [1] * 15 + [0] * 85}).to_parquet(path)
    rows = baseline_cli.run(spark, path).collect()
    assert [r["n_obs"] for r in rows] == [100, 100]
    assert abs(rows[1]["relative_lift_pct"] - 50.0) < 1e-9


@pytest.mark.parametrize("value", [0.7, 2.0, -1.0, float("nan")])
def test_flag_that_is_not_binary_fails(spark, value):
    df = spark.createDataFrame([(0.0,), (1.0,), (value,)], "treatment double")
    with pytest.raises(Exception, match="neither 0 nor 1"):
        loader.narrow_types(df).collect()


def test_null_and_boolean_flags_are_kept(spark):
    df = spark.createDataFrame([(None, True), (1.0, False)], "treatment double, visit boolean")
    assert [tuple(r) for r in loader.narrow_types(df).collect()] == [(None, 1), (1, 0)]
