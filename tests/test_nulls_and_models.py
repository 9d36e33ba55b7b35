"""Null groups, the control band, out-of-fold students, saved models, rules on the rows, stable ids."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from upshot.functions.sampling import smallest_by_hash
from upshot.operators import bandit, learners, monitor, segments
from upshot.sources.loader import read_experiment


def rows(n=3000, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    t = rng.integers(0, 2, n)
    y = (rng.random(n) < 0.2 + 0.2 * (x[:, 0] > 0) * t).astype(int)
    return pd.DataFrame({"unit_id": np.arange(n), "f0": x[:, 0], "f1": x[:, 1], "f2": x[:, 2], "treatment": t, "conversion": y,
                         "score": 0.3 * x[:, 0] - 0.1 * x[:, 1] ** 2})


def test_null_strata_are_strata(spark):
    df = spark.createDataFrame([(i, None if i % 3 else "a", i % 2, i % 5 == 0) for i in range(900)],
                               "unit_id long, g string, treatment int, conversion boolean").withColumn("conversion", F.col("conversion").cast("int"))
    quotas = spark.createDataFrame([(None, 5), ("a", 7)], "g string, quota long")
    picked = smallest_by_hash(df.withColumn("u", F.rand(1)), ["g"], quotas, "u", "unit_id")
    assert {r.g: r["count"] for r in picked.groupBy("g").count().collect()} == {None: 5, "a": 7}
    kept = segments.stratum_baseline(df, [F.col("g")])
    assert kept.count() == 900 and kept.where("baseline_conversion_prob IS NULL").count() == 0
    sample = segments.stratified_sample(df, "g", n=90)
    assert {r.g: r["count"] for r in sample.groupBy("g").count().collect()} == {None: 60, "a": 30}


def test_no_score_no_archetype(spark):
    df = spark.createDataFrame([(None, 0.1, 0, 0), (0.5, 0.1, 0, 1), (-0.5, 0.1, 1, 0)],
                               "score double, baseline_conversion_prob double, treatment int, conversion int")
    got = {r.score: (r.archetype_label, r.persuadable_flag) for r in segments.classify(df).collect()}
    assert got == {None: (None, None), 0.5: ("Persuadable", 1), -0.5: ("Sleeping Dog", 0)}


def test_a_period_is_judged_by_its_predecessors(spark):
    profits = [10.0, 11.0, 9.5, 10.5, 1000.0, 10.0]
    series = spark.createDataFrame([(i + 1, p, 1) for i, p in enumerate(profits)], "week int, expected_profit_per_user double, n_users long")
    band = {r.week: r for r in monitor.control_band(series).collect()}
    assert [w for w in band if band[w].alert] == [5]
    assert band[1].band_mean is None and band[2].band_mean is None
    assert abs(band[5].band_mean - np.mean(profits[:4])) < 1e-12 and abs(band[5].band_std - np.std(profits[:4], ddof=1)) < 1e-12


def test_students_are_judged_on_other_units(spark):
    """A tree that has learnt noise by heart fits its own units well and units it has not seen badly."""
    rng = np.random.default_rng(3)
    pdf = rows(2000).assign(noise=rng.normal(size=2000))
    df = spark.createDataFrame(pdf)
    deep = dict(max_depth=12, min_samples_leaf=1)
    own = learners.Distiller(["f0", "f1", "f2"], "tree", **deep).fit(df, "noise").fidelity(df, "noise").first()["r2"]
    judged = learners.out_of_fold(df, ["f0", "f1", "f2"], "noise", "tree", **deep)
    other = learners.regression_fidelity(judged, "noise", "student_score").first()
    assert own > 0.2 > 0.1 > other["r2"] and other["n"] == 2000
    again = learners.out_of_fold(df.repartition(5), ["f0", "f1", "f2"], "score", "linear").select("unit_id", "student_score")
    first = learners.out_of_fold(df, ["f0", "f1", "f2"], "score", "linear").select("unit_id", "student_score")
    a, b = ({r.unit_id: r.student_score for r in d.collect()} for d in (first, again))
    assert len(a) == 2000 and all(abs(a[k] - b[k]) < 1e-9 for k in a)


def test_pipeline_with_a_learner_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(rows(600))
    est = learners.UpliftEstimator(["f0", "f1"], learner="t", maxIter=3, maxDepth=2, predictionCol="cate")
    fitted = Pipeline(stages=[est]).fit(df)
    fitted.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    a, b = ({r.unit_id: r.cate for r in m.transform(df).collect()} for m in (fitted, loaded))
    assert a == b and loaded.stages[0].getOrDefault("featureCols") == ["f0", "f1"]
    est.write().overwrite().save(str(tmp_path / "e"))
    assert learners.UpliftEstimator.load(str(tmp_path / "e")).getOrDefault("maxIter") == 3


def test_propensity_alone_equals_the_learners(spark):
    df = spark.createDataFrame(rows(500))
    alone = learners.PropensityModel(["f0", "f1"], n_estimators=3, max_depth=2).fit(df).predict(df)
    full = learners.XLearner(["f0", "f1"], n_estimators=3, max_depth=2).fit(df).predict_propensity(df)
    a, b = ({r.unit_id: r.propensity for r in d.collect()} for d in (alone, full))
    assert a == b


def test_rules_count_the_same_rows_as_the_model(spark):
    df = spark.createDataFrame(rows(2500))
    model = learners.surrogate_tree(df, ["f0", "f1", "f2"], score="score", max_depth=4)
    got = learners.leaf_check(model, df, ["f0", "f1", "f2"], "score").collect()
    assert len(got) > 8
    for r in got:
        assert r.n_samples == r.n_model == r.n_rule and abs(r.mean_model - r.mean_rule) < 1e-12 and abs(r.predicted - r.mean_rule) < 1e-9


def test_ids_do_not_depend_on_the_splits(spark, tmp_path):
    path = str(tmp_path / "t")
    cols = {f"f{i}": F.col("id") * (i + 1.0) for i in range(12)} | {c: (F.col("id") % 2).cast("double") for c in (
        "treatment", "conversion", "visit", "exposure")}
    spark.range(5000).select(*[e.alias(c) for c, e in cols.items()]).repartition(3).write.option("parquet.block.size", 4096).parquet(path)
    found = []
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    for size in ("134217728", "5000"):
        try:
            spark.conf.set(name, size)
            df = read_experiment(spark, path, unit_ids=True)
            found.append({r.unit_id: r.f0 for r in df.select("unit_id", "f0").collect()})
        finally:
            spark.conf.set(name, before)
    assert found[0] == found[1] and len(found[0]) == 5000


def test_bandit_row_equals_the_replay(spark):
    df = spark.createDataFrame(rows(800))
    agent = bandit.BatchedLinUCB(["f0", "f1"])
    stream = agent.prepare(df, n_rounds=4, files_per_round=2)
    agent.run(stream)
    row = agent.policy_row(stream, 9, "bandit", "text").first()
    assert row.policy_id == 9 and row.avg_profit_per_user == pytest.approx(agent.summary(spark).first()["avg_profit"])
    assert 0 <= row.bid_rate_pct <= 100
    many = agent.trajectory(stream, 0.3, n_points=40, buckets=1, rows_per_bucket=20).orderBy("impression_index").collect()
    one = agent.trajectory(stream, 0.3, n_points=40, buckets=1).orderBy("impression_index").collect()
    assert [(r.impression_index, round(r.cumulative_profit_bandit, 9)) for r in many] == [
        (r.impression_index, round(r.cumulative_profit_bandit, 9)) for r in one]


def test_sample_has_its_exact_size_when_rounding_falls_short(spark):
    """Three strata of 11, 11 and 11 rows: a sample of 10 rounds to 3 + 3 + 3, and one stratum gives a fourth."""
    df = spark.createDataFrame([(i, "abc"[i % 3]) for i in range(33)], "unit_id long, g string")
    counts = {r.g: r["count"] for r in segments.stratified_sample(df, "g", n=10).groupBy("g").count().collect()}
    assert counts == {"a": 4, "b": 3, "c": 3}
