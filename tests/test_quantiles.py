import contextlib
import io
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from upshot.functions import quantiles as module
from upshot.functions.quantiles import quantiles


@pytest.mark.parametrize("n", [1, 2, 7, 150, 4000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, n), "x": np.round(rng.normal(size=n) * 3, 1)})
    probs = [0.0, 0.1, 0.25, 0.5, 0.85, 0.95, 1.0]
    res = quantiles(spark.createDataFrame(pdf), "x", probs, by=["g"], accuracy=500).toPandas()
    for g, sub in pdf.groupby("g"):
        got = res[res.g == g].sort_values("q_idx").value.to_numpy()
        assert np.allclose(np.quantile(sub.x.to_numpy(), probs), got, rtol=0, atol=1e-12)


def test_hot_value_third_of_rows(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([np.full(3000, 5.0), rng.normal(size=6000)])
    res = quantiles(spark.createDataFrame(pd.DataFrame({"x": x})), "x", [0.2, 0.5, 0.8], accuracy=200).toPandas()
    assert np.allclose(np.quantile(x, [0.2, 0.5, 0.8]), res.sort_values("q_idx").value.to_numpy())


def test_count_sorted_long_arrays_match_filter(spark):
    from pyspark.sql import functions as F

    from upshot.functions.quantiles import count_sorted
    rng = np.random.default_rng(5)
    for n in (1, 7, 64, 65, 999, 1000, 1030):
        edges = np.sort(np.round(rng.normal(size=n), 1))   # duplicates included
        vals = np.concatenate([edges[:20], rng.normal(size=200), [-99.0, 99.0]])
        df = spark.createDataFrame(pd.DataFrame({"v": vals})).withColumn(
            "e", F.array(*[F.lit(float(x)) for x in edges]))
        got = df.select("v", count_sorted("e", "v", n, strict=False).alias("le"),
                        count_sorted("e", "v", n, strict=True).alias("lt")).toPandas()
        assert (got["le"].to_numpy() == np.searchsorted(edges, got.v.to_numpy(), side="right")).all(), n
        assert (got["lt"].to_numpy() == np.searchsorted(edges, got.v.to_numpy(), side="left")).all(), n


def test_approx_method_runs_through_operators(spark):
    from upshot.operators import monitor, policy, ranking, segments
    rng = np.random.default_rng(8)
    n = 3000
    pdf = pd.DataFrame({"unit_id": np.arange(n), "score": rng.normal(size=n), "treatment": rng.integers(0, 2, n),
                        "conversion": rng.integers(0, 2, n), "f0": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    d_exact = ranking.decile_stats(df).toPandas().sort_values("decile")
    d_apx = ranking.decile_stats(df, method="approx").toPandas().sort_values("decile")
    assert d_apx.n_obs.sum() == n and (abs(d_apx.n_obs.to_numpy() - d_exact.n_obs.to_numpy()) <= 5).all()
    assert segments.segment_profile(df, ["f0"], method="approx").count() == 1
    assert policy.greedy_decision(df, method="approx").where("greedy_bid").count() in range(440, 461)
    assert monitor.psi(df, df, ["f0"], method="approx").first()["psi"] < 1e-6


def test_two_reads_of_the_data(spark, monkeypatch, tmp_path):
    """All columns and groups: the sketch read and the count read, nothing else touches the base."""
    import re

    from pyspark.sql import functions as F

    from upshot.functions import quantiles as q
    path = str(tmp_path / "base")
    spark.range(60_000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("a"),
                             F.sin("id").alias("b")).write.parquet(path)
    reads = []

    def watch(make):
        def run(df, *args, **kw):
            reads.append(len(re.findall(r"FileScan parquet|Scan parquet", df._jdf.queryExecution().executedPlan().toString())))
            return make(df, *args, **kw)
        return run

    for name in ("bounded", "small", "checkpointed"):
        monkeypatch.setattr(q, name, watch(getattr(q, name)))
    out = q.quantiles_of(spark.read.parquet(path), ["a", "b"], [0.1, 0.5, 0.9], by=["g"])
    rows = out.collect()
    assert len(rows) == 3 * 2 * 3 and sum(reads) == 2
    assert "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    pdf = spark.read.parquet(path).toPandas()
    for r in rows:
        assert abs(np.quantile(pdf[pdf.g == r.g][r.feature], r.prob) - r.value) < 1e-12


def test_null_groups_null_values_and_missed_brackets(spark, monkeypatch):
    from upshot.functions import quantiles as q
    rng = np.random.default_rng(4)
    rows = [(None if i % 3 else "a", None if i % 10 == 0 else float(x)) for i, x in enumerate(rng.normal(size=60_000))]
    pdf = pd.DataFrame([*rows, ("empty", None)], columns=["g", "x"])
    df = spark.createDataFrame(pdf.astype({"x": "Float64"}), "g string, x double")
    probs = [0.0, 0.3, 0.5, 1.0]

    def same():
        got = {(r.g, r.q_idx): (r.value, r.n) for r in q.quantiles(df, "x", probs, by=["g"]).collect()}
        assert {k[0] for k in got} == {None, "a"}
        for g in (None, "a"):
            x = [v for k, v in rows if k == g and v is not None]
            for i, p in enumerate(probs):
                assert abs(got[g, i][0] - np.quantile(x, p)) < 1e-12 and got[g, i][1] == len(x)

    same()
    plain, tries = q._exact, []

    def astray(base, width, k, p, delta):
        tries.append(delta)
        if len(tries) == 1:          # brackets around other ranks: every wanted one is missed
            ends = [0.11, 0.12]
            monkeypatch.setattr(q, "_sketched", lambda b, w, kk, at, f=q._sketched: f(b, w, kk, [ends[0] + 0.01 * (i % 2) for i in range(len(at))]))
            out = plain(base, width, k, p, delta)
            monkeypatch.undo()
            monkeypatch.setattr(q, "_exact", astray)
            return out
        return plain(base, width, k, p, delta)

    monkeypatch.setattr(q, "_exact", astray)
    same()
    assert len(tries) == 2


def test_nan_values_sort_last(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)] + [(float("nan"),)] * 5, "x double")
    got = {r.q_idx: r.value for r in quantiles(df, "x", [0.0, 0.5, 1.0]).collect()}
    assert got[0] == 0.0 and got[1] == 7.0 and np.isnan(got[2])


def test_the_second_read_of_many_columns_is_code_the_jvm_compiles(spark, monkeypatch):
    """A method above 8,000 bytes of code is never compiled; one search a column made one method of all six."""
    df = spark.range(500).select(*[(F.col("id") * k % 97).cast("double").alias(f"x{k}") for k in range(1, 7)])
    sizes, store = [], module.checkpointed

    def checked(table):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            table.explain("codegen")
        sizes.extend(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue()))
        return store(table)

    monkeypatch.setattr(module, "checkpointed", checked)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = module.quantiles_of(df, [f"x{k}" for k in range(1, 7)], [i / 10 for i in range(11)]).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8000
    pdf = df.toPandas()
    for r in got.itertuples():
        assert r.value == pytest.approx(np.quantile(pdf[r.feature], r.prob), abs=1e-9)
