"""Property tests: exact quantiles and exact hash sampling against NumPy / pandas on random inputs."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from upshot.functions.quantiles import quantiles
from upshot.functions.sampling import smallest_by_hash

values = st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False, width=32)),
                  min_size=1, max_size=300)
probs = st.lists(st.floats(0.0, 1.0), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values, probs)
def test_quantiles_equal_numpy(spark, xs, ps):
    df = spark.createDataFrame(pd.DataFrame({"x": xs}))
    got = quantiles(df, "x", ps, accuracy=50).toPandas().sort_values("q_idx").value.to_numpy()
    want = np.quantile(np.array(xs, dtype=float), ps)
    assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(1, 400), st.integers(0, 450), st.integers(1, 64))
def test_smallest_by_hash_equals_sort(spark, n, quota, bins):
    rng = np.random.default_rng(n + quota)
    pdf = pd.DataFrame({"k": np.arange(n), "g": rng.integers(0, 3, n), "u": rng.random(n).round(3)})
    q = pd.DataFrame({"g": [0, 1, 2], "quota": [quota, quota // 2, 1]})
    got = smallest_by_hash(spark.createDataFrame(pdf), ["g"], spark.createDataFrame(q), "u", "k", bins=bins).toPandas()
    for g, qq in zip(q.g, q.quota):
        want = set(pdf[pdf.g == g].sort_values(["u", "k"]).head(qq).k)
        assert set(got[got.g == g].k) == want
