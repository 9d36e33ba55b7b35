import numpy as np
import pandas as pd

from upshot.operators import bandit, learners


def test_tlearner_planted(spark):
    rng = np.random.default_rng(41)
    n = 5000
    f0 = rng.uniform(-1, 1, n)
    t = rng.integers(0, 2, n)
    p = 0.2 + 0.5 * t * (f0 > 0)
    y = (rng.random(n) < p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"f0": f0, "treatment": t, "conversion": y}))
    m = learners.TLearner(["f0"], n_estimators=20, max_depth=3).fit(df)
    test = spark.createDataFrame(pd.DataFrame({"f0": [-0.5, 0.5, -0.8, 0.8]}))
    s = m.predict(test).toPandas().uplift_score.to_numpy()
    assert abs(s[0]) < 0.15 and abs(s[2]) < 0.15 and abs(s[1] - 0.5) < 0.15 and abs(s[3] - 0.5) < 0.15


def test_xlearner_runs_no_nan(spark):
    rng = np.random.default_rng(42)
    n = 1000
    pdf = pd.DataFrame({"f0": rng.random(n), "f1": rng.random(n), "treatment": rng.integers(0, 2, n),
                        "conversion": rng.integers(0, 2, n)})
    m = learners.XLearner(["f0", "f1"], n_estimators=5, max_depth=3).fit(spark.createDataFrame(pdf))
    out = m.predict(spark.createDataFrame(pdf)).toPandas()
    assert len(out) == n and out.uplift_score.notna().all()


def test_distillation_fidelity(spark):
    rng = np.random.default_rng(43)
    pdf = pd.DataFrame(rng.random((1000, 3)), columns=["f0", "f1", "f2"])
    pdf["teacher"] = pdf.f0 + pdf.f1
    d = learners.Distiller(["f0", "f1", "f2"], "tree", max_depth=5).fit(spark.createDataFrame(pdf), "teacher")
    assert d.fidelity(spark.createDataFrame(pdf), "teacher").first()["r2"] > 0.8
    assert d.predict(spark.createDataFrame(pdf)).count() == 1000


def test_batched_linucb_batch_one_equals_closed_form(spark):
    rng = np.random.default_rng(44)
    n = 40
    x = rng.normal(size=(n, 2))
    arms = rng.integers(0, 2, n)
    conv = rng.integers(0, 2, n)
    rewards = conv * 10.0 - arms * 0.1
    pdf = pd.DataFrame({"unit_id": np.arange(n), "event_idx": np.arange(n), "a": x[:, 0], "b": x[:, 1],
                        "treatment": arms, "conversion": conv})
    agent = bandit.BatchedLinUCB(["a", "b"], alpha=1.0)
    stream = agent.prepare(spark.createDataFrame(pdf), order_col="event_idx", batch_size=1)
    agent.run(stream)
    seen = agent.decisions(stream).toPandas().sort_values("unit")
    chosen = seen.chosen.to_numpy()
    kept = chosen == arms
    for i in range(n):      # each decision against the closed-form ridge solution over the events kept before it
        ucb = []
        for a in (0, 1):
            before = kept & (arms == a) & (np.arange(n) < i)
            inv = np.linalg.inv(np.eye(2) + x[before].T @ x[before])
            ucb.append(inv @ x[before].T @ rewards[before] @ x[i] + np.sqrt(x[i] @ inv @ x[i]))
        assert chosen[i] == int(ucb[1] > ucb[0])
    s = agent.summary(spark).first()
    assert s["aligned_events"] == kept.sum() and abs(s["cumulative_reward"] - rewards[kept].sum()) < 1e-9
    for a in (0, 1):
        own = x[kept & (arms == a)]
        assert np.allclose(agent.A[a], np.eye(2) + own.T @ own)


def test_profit_bandit_prefers_control(spark):
    rng = np.random.default_rng(45)
    n = 1000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "f0": rng.random(n), "f1": rng.random(n),
                        "treatment": rng.integers(0, 2, n), "conversion": (rng.random(n) < 0.1).astype(int)})
    agent = bandit.BatchedLinUCB(["f0", "f1"], value=10.0, cost=1.0)
    agent.run(agent.prepare(spark.createDataFrame(pdf), n_rounds=10))
    tab = agent.round_table(spark).toPandas()
    assert tab.matched.sum() > 0
    assert tab.matched.sum() - tab.matched_treatment.sum() > tab.matched_treatment.sum()


def test_save_load_roundtrip(spark, tmp_path):
    rng = np.random.default_rng(46)
    n = 600
    pdf = pd.DataFrame({"f0": rng.random(n), "f1": rng.random(n), "treatment": rng.integers(0, 2, n),
                        "conversion": rng.integers(0, 2, n)})
    df = spark.createDataFrame(pdf)
    t = learners.TLearner(["f0", "f1"], n_estimators=3, max_depth=2).fit(df)
    t.save(str(tmp_path / "t"))
    t2 = learners.TLearner.load(str(tmp_path / "t"))
    a = t.predict(df).toPandas().uplift_score.to_numpy()
    b = t2.predict(df).toPandas().uplift_score.to_numpy()
    assert np.allclose(a, b)
    pdf["teacher"] = pdf.f0 - pdf.f1
    d = learners.Distiller(["f0", "f1"], "tree", max_depth=3).fit(spark.createDataFrame(pdf), "teacher")
    d.save(str(tmp_path / "s"))
    d2 = learners.Distiller.load(str(tmp_path / "s"), ["f0", "f1"])
    assert np.allclose(d.predict(df).toPandas().student_score, d2.predict(df).toPandas().student_score)


def test_tree_rules_table(spark):
    rng = np.random.default_rng(47)
    pdf = pd.DataFrame({"f0": rng.random(2000), "f1": rng.random(2000)})
    pdf["score"] = np.where(pdf.f0 > 0.5, 0.1, -0.01)
    tree = learners.surrogate_tree(spark.createDataFrame(pdf), ["f0", "f1"], score="score", max_depth=2)
    rules = learners.tree_rules(tree, ["f0", "f1"]).toPandas()
    root = rules[rules.node_id == 0].iloc[0]
    assert root.node_type == "Split" and root.feature == "f0" and abs(float(root.threshold) - 0.5) < 0.05
    assert rules[rules.node_type == "Leaf"].n_samples.sum() == 2000
    assert set(rules.archetype_hint) <= {"Persuadable", "Sleeping Dog", "Low Uplift"}
    imp = learners.feature_importance(tree, ["f0", "f1"]).toPandas().set_index("feature")
    assert imp.loc["f0", "rank"] == 1 and imp.loc["f0", "threshold_direction"] == "<="


def test_linucb_learns_paying_arm(spark):
    """Context [1.0, 0.5]; arm 1 always pays 1, arm 0 pays 0 (value 1, no cost)."""
    n = 100
    pdf = pd.DataFrame({"unit_id": np.arange(n), "event_idx": np.arange(n), "a": [1.0] * n, "b": [0.5] * n,
                        "treatment": [i % 2 for i in range(n)], "conversion": [i % 2 for i in range(n)]})
    agent = bandit.BatchedLinUCB(["a", "b"], alpha=1.0, value=1.0, cost=0.0)
    agent.run(agent.prepare(spark.createDataFrame(pdf), order_col="event_idx", batch_size=10))
    assert agent.choose([1.0, 0.5]) == 1
    assert agent.summary(spark).first()["aligned_events"] > 0


def test_report_on_reference_schema(spark, tmp_path):
    """The full report on a table with the reference's columns only (no unit id, no timestamps)."""
    from upshot.plans import run_report
    rng = np.random.default_rng(48)
    n = 6000
    pdf = pd.DataFrame(rng.random((n, 12)), columns=[f"f{i}" for i in range(12)])
    pdf["treatment"] = (rng.random(n) < 0.85).astype(int)
    p = 0.05 + 0.1 * pdf.treatment * (pdf.f0 > 0.5)
    pdf["conversion"] = (rng.random(n) < p).astype(int)
    pdf["visit"] = np.maximum(pdf.conversion, (rng.random(n) < 0.3).astype(int))
    pdf["exposure"] = pdf.treatment * (rng.random(n) < 0.6)
    src = str(tmp_path / "exp.parquet")
    pdf.to_parquet(src)
    out = str(tmp_path / "report")
    check = run_report.main(["--input", src, "--out", out, "--n-estimators", "5", "--max-depth", "3",
                             "--bootstraps", "5", "--sample-size", "1000"], spark=spark).toPandas()
    assert check.ok.all(), check[~check.ok]
    assert spark.read.text(out + "/segment_rules").count() > 0


def test_xlearner_recovers_planted_sign(spark):
    rng = np.random.default_rng(49)
    n = 4000
    f0, f1 = rng.random(n), rng.random(n)
    t = (rng.random(n) < 0.7).astype(int)
    p = 0.2 + np.where(f0 > 0.5, 0.4, -0.15) * t
    pdf = pd.DataFrame({"f0": f0, "f1": f1, "treatment": t, "conversion": (rng.random(n) < p).astype(int)})
    df = spark.createDataFrame(pdf)
    m = learners.XLearner(["f0", "f1"], n_estimators=15, max_depth=3).fit(df)
    out = m.predict(df).toPandas()
    hi, lo = out[out.f0 > 0.5].uplift_score.mean(), out[out.f0 <= 0.5].uplift_score.mean()
    assert hi > 0.2 and lo < 0.0


def test_bandit_trajectory_matches_pandas_cumsum(spark):
    rng = np.random.default_rng(50)
    n = 3000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "f0": rng.random(n), "f1": rng.random(n),
                        "treatment": rng.integers(0, 2, n), "conversion": (rng.random(n) < 0.2).astype(int)})
    agent = bandit.BatchedLinUCB(["f0", "f1"], value=10.0, cost=0.5)
    stream = agent.prepare(spark.createDataFrame(pdf), n_rounds=5)
    agent.run(stream)
    dec = agent.decisions(stream).toPandas()
    m = dec[dec.chosen == dec.arm].sort_values(["round", "order_key", "unit"])
    cum = m.reward.cumsum().to_numpy()
    traj = agent.trajectory(stream, baseline_profit=0.3, n_points=50, buckets=4).toPandas().sort_values("impression_index")
    assert len(traj) == 50 and traj.impression_index.iloc[-1] == len(m) - 1
    assert np.allclose(traj.cumulative_profit_bandit.to_numpy(), cum[traj.impression_index.to_numpy()], atol=1e-9)
    assert np.allclose(traj.cumulative_profit_baseline, (traj.impression_index + 1) * 0.3)
    assert abs(cum[-1] - agent.summary(spark).first()["cumulative_reward"]) < 1e-9


def test_uplift_estimator_in_pipeline(spark):
    from pyspark.ml import Pipeline

    from upshot.operators.learners import UpliftEstimator
    rng = np.random.default_rng(51)
    n = 1500
    pdf = pd.DataFrame({"f0": rng.random(n), "f1": rng.random(n), "treatment": rng.integers(0, 2, n),
                        "conversion": rng.integers(0, 2, n)})
    df = spark.createDataFrame(pdf)
    est = UpliftEstimator(featureCols=["f0", "f1"], learner="t", maxIter=3, maxDepth=2, predictionCol="cate")
    model = Pipeline(stages=[est]).fit(df)
    out = model.transform(df)
    assert "cate" in out.columns and out.where("cate IS NULL").count() == 0
