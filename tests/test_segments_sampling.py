import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from upshot.functions.columns import unit_uniform
from upshot.functions.sampling import smallest_by_hash
from upshot.operators import learners, segments


def test_segment_profile_and_rules(spark):
    rng = np.random.default_rng(21)
    f0 = np.concatenate([rng.normal(10, 1, 500), rng.normal(0, 1, 500)])
    pdf = pd.DataFrame({"f0": f0, "f1": rng.normal(5, 5, 1000)})
    pdf["score"] = 0.1 * pdf.f0
    df = spark.createDataFrame(pdf)
    prof = {r["feature"]: r for r in segments.segment_profile(df, ["f0", "f1"], top=0.10).collect()}
    assert prof["f0"]["diff_pct"] > 50 and abs(prof["f1"]["diff_pct"]) < 50 and prof["f0"]["feature_rank"] == 1
    tree = learners.surrogate_tree(df, ["f0", "f1"], score="score", max_depth=3)
    assert "f0" in learners.rules_text(tree, ["f0", "f1"])


def test_smallest_by_hash_exact(spark):
    rng = np.random.default_rng(22)
    n = 20000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "g": np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b"], n))})
    df = spark.createDataFrame(pdf).withColumn("_u", unit_uniform("unit_id", 5))
    quotas = spark.createDataFrame([("hot", 700), ("a", 5), ("b", 100000)], "g string, quota long")
    got = smallest_by_hash(df, ["g"], quotas, "_u", "unit_id", bins=64).toPandas()
    full = df.toPandas()
    for g, q in [("hot", 700), ("a", 5), ("b", 100000)]:
        want = full[full.g == g].sort_values(["_u", "unit_id"]).head(q).unit_id
        assert set(got[got.g == g].unit_id) == set(want)


def test_stratified_sample_size_and_quotas(spark):
    rng = np.random.default_rng(23)
    n = 9000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "archetype_label": rng.choice(["P", "S", "L"], n, p=[0.6, 0.3, 0.1])})
    df = spark.createDataFrame(pdf)
    s1 = segments.stratified_sample(df, n=1000).toPandas()
    s2 = segments.stratified_sample(df, n=1000).toPandas()
    assert len(s1) == 1000 and sorted(s1.row_id) == list(range(1000))
    assert set(s1.unit_id) == set(s2.unit_id)            # deterministic
    sizes = pdf.archetype_label.value_counts()
    for lab, size in sizes.items():
        want = min(size, max(1, round(1000 * size / n)))
        assert abs((s1.archetype_label == lab).sum() - want) <= 1


def test_archetypes(spark):
    pdf = pd.DataFrame({"score": [-0.1, 0.05, 0.01, 0.01], "baseline_conversion_prob": [0.5, 0.5, 0.9, 0.0],
                        "treatment": [0, 1, 0, 1], "conversion": [1, 0, 0, 1]})
    c = segments.classify(spark.createDataFrame(pdf), control_rate=0.5).toPandas()
    assert list(c.archetype_label) == ["Sleeping Dog", "Persuadable", "Sure Thing", "Lost Cause"]
    assert list(c.persuadable_flag) == [0, 1, 0, 0]


def test_sample_n_and_frac(spark):
    n = 5000
    df = spark.createDataFrame(pd.DataFrame({"unit_id": np.arange(n), "x": np.arange(n) % 7}))
    s = segments.sample_n(df, 300).toPandas()
    assert len(s) == 300 and s.unit_id.is_unique
    assert len(segments.sample_n(df, 10 ** 6).toPandas()) == n
    f = segments.sample_frac(df, 0.1).count()
    assert 350 < f < 650
    from upshot.functions.sampling import cuped_sample_size
    assert cuped_sample_size(2_000_000) == 200_000 and cuped_sample_size(50_000) == 50_000


def test_the_cut_join_does_not_shuffle_the_rows(spark):
    """Nearly all rows in one stratum: a shuffle join on the stratum would send every one of them to one task."""
    df = spark.range(20000).select(F.col("id").alias("unit_id"), F.when(F.col("id") < 19990, "hot").otherwise("b").alias("g"))
    quotas = spark.createDataFrame([("hot", 100), ("b", 5)], "g string, quota long")
    picked = smallest_by_hash(df.withColumn("_u", unit_uniform("unit_id", 5)), ["g"], quotas, "_u", "unit_id", bins=64)
    assert picked.count() == 105
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan, plan
