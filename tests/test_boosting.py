"""Boosted trees over blocks of binned rows against Spark ML's own."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from upshot.operators import boosting, learners

SIZE = dict(maxIter=8, maxDepth=4, stepSize=0.1, maxBins=32, seed=7, featuresCol="_features")
NAMES = ["a", "b", "c"]


@pytest.fixture(autouse=True)
def all_by_blocks(monkeypatch):
    monkeypatch.setattr(boosting, "SPARK_ML_ROWS", 0)


def rows(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    return pd.DataFrame({"unit_id": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": rng.integers(-2, 3, n).astype(float),
                         "y": (rng.random(n) < 0.2 + 0.4 * (x[:, 0] > 0)).astype(float), "z": x[:, 0] * x[:, 1] + rng.normal(size=n)})


def estimators():
    return GBTClassifier(labelCol="y", **SIZE), GBTRegressor(labelCol="z", **SIZE)


def scores(x, classifier, regressor):
    p = classifier.transform(x).select("unit_id", vector_to_array("probability")[1].alias("p"))
    v = regressor.transform(x).select("unit_id", F.col("prediction").alias("v"))
    return p.join(v, "unit_id").orderBy("unit_id").toPandas()


@pytest.mark.parametrize("n", [60, 3000, 16_000])
def test_trees_are_those_of_spark_ml(spark, n):
    """With tiny nodes, with all rows as the sample of the cuts, and with a part of them."""
    df = spark.createDataFrame(rows(n)).coalesce(1).persist()
    x = learners.assemble(df, NAMES)
    theirs, ours = [e.fit(x) for e in estimators()], [boosting.fit(e, df, NAMES) for e in estimators()]
    a, b = scores(x, *theirs), scores(x, *ours)
    assert len(a) == n and np.allclose(a.p, b.p, atol=1e-9) and np.allclose(a.v, b.v, atol=1e-9)
    assert [m.toDebugString.split("\n", 1)[1].count("If") for m in ours] == [m.toDebugString.split("\n", 1)[1].count("If") for m in theirs]
    assert np.allclose(ours[0].featureImportances.toArray(), theirs[0].featureImportances.toArray())


def test_jobs_blocks_and_tasks_change_no_tree(spark, monkeypatch):
    df = spark.createDataFrame(rows(4000)).coalesce(1).persist()
    x = learners.assemble(df, NAMES)
    one = scores(x, *[boosting.fit(e, df, NAMES) for e in estimators()])
    monkeypatch.setattr(boosting, "ONE_TASK_ROWS", 0)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 900)
    monkeypatch.setattr(boosting, "BLOCK", 100)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    many = scores(x, *[boosting.fit(e, df.repartition(5), NAMES) for e in estimators()])
    assert np.allclose(one.p, many.p, atol=1e-9) and np.allclose(one.v, many.v, atol=1e-9)


def test_few_rows_take_few_jobs(spark):
    """Spark ML starts a job for each level of each tree; one task grows all trees of few rows."""
    df = spark.createDataFrame(rows(2000)).coalesce(1).persist()
    spark.sparkContext.setJobGroup("boosting", "few rows")
    try:
        boosting.fit(estimators()[0], df, NAMES)
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("boosting")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 8 * 4


def test_training_rows_are_held_as_bytes():
    """One byte a feature, one for the label and a double a row (Spark ML's row objects take over 100 bytes)."""
    import pyarrow as pa
    n = 100_000
    pdf = rows(n)
    batch = pa.RecordBatch.from_pandas(pdf[["y", *NAMES]])
    held = list(boosting._blocks([batch], [np.arange(31.0)] * 3))
    assert [len(y) for _, y in held] == [32_768] * 3 + [n - 3 * 32_768]
    assert sum(bins.nbytes for bins, _ in held) == 3 * n


def test_the_model_is_spark_mls(spark, tmp_path):
    df = spark.createDataFrame(rows(500)).coalesce(1).persist()
    model = boosting.fit(estimators()[0], df, NAMES)
    assert isinstance(model, GBTClassificationModel) and model.getNumTrees == 8 and model.numFeatures == 3
    assert model.treeWeights == [1.0] + [0.1] * 7 and model.getLabelCol() == "y"
    model.write().overwrite().save(str(tmp_path / "m"))
    x = learners.assemble(df, NAMES)
    a, b = (m.transform(x).select(vector_to_array("probability")[1]).collect()
            for m in (model, GBTClassificationModel.load(str(tmp_path / "m"))))
    assert a == b


@pytest.mark.parametrize("change", [dict(a=[None, 1.0]), dict(y=[2.0, 1.0]), dict(y=[None, 1.0])])
def test_values_the_trees_cannot_take_are_refused(spark, change):
    df = spark.createDataFrame(pd.DataFrame(dict(a=[1.0, 2.0], y=[0.0, 1.0]) | change).convert_dtypes(convert_integer=False))
    with pytest.raises(ValueError, match="training rows"):
        boosting.fit(estimators()[0], df, ["a"])
