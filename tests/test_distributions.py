"""Native distribution expressions against the standard library and each other's SQL."""

import math
from statistics import NormalDist

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from upshot.functions import dist


def both(spark, values, column, sql):
    got = spark.createDataFrame([(float(v),) for v in values], "x double").select("x", column.alias("y")).toPandas()
    frame = pd.DataFrame({"x": [float(v) for v in values]})  # noqa: F841 - read by DuckDB
    other = duckdb.sql(f"SELECT x, {sql} AS y FROM frame").df()
    a, b = got.sort_values("x").y.to_numpy(), other.sort_values("x").y.to_numpy()
    assert np.allclose(a, b, rtol=1e-13, atol=0)
    return a


def test_erfc(spark):
    xs = np.r_[0.0, 1e-9, np.linspace(0.01, 26, 400), 1.9999999, 2.0]
    got = both(spark, xs, dist.erfc("x"), dist.erfc_sql("x"))
    want = np.array([math.erfc(x) for x in np.sort(xs)])
    assert np.allclose(got, want, rtol=1e-12, atol=0)
    assert spark.range(1).select(dist.erfc(F.lit(None).cast("double")).alias("e")).first().e is None
    assert spark.range(1).select(dist.normal_two_sided_p(F.lit(-1.959963984540054)).alias("p")).first().p - 0.05 < 1e-12


def test_normal_quantile(spark):
    us = np.r_[2.0 ** -53, 1e-12, np.linspace(0.0005, 0.9995, 999), 1 - 1e-12]
    text = dist.normal_quantile_text("x")
    got = both(spark, us, F.expr(text), text)
    want = np.array([NormalDist().inv_cdf(u) for u in np.sort(us)])
    assert np.allclose(got, want, rtol=1e-9, atol=1e-12)


def exact_quantile(n, u):
    k, p = 0, math.exp(-n)
    c = p
    while c <= u:
        k += 1
        p *= n / k
        c += p
    return k


def test_poisson_quantile(spark):
    rng = np.random.default_rng(1)
    pairs = [(n, float(u)) for n in (1, 2, 7, 30, 64, 65, 90, 300, 600) for u in np.r_[rng.random(300), 1e-9, 1 - 1e-9]]
    got = dist.with_poisson(spark.createDataFrame(pairs, "n long, u double"), "n", "u", "k").toPandas()
    want = np.array([exact_quantile(n, u) for n, u in zip(got.n, got.u, strict=True)])
    off = np.abs(got.k.to_numpy() - want)
    assert (off[got.n <= dist.POISSON_EXACT] == 0).all()
    assert off.max() <= 1 and (off > 0).mean() < 0.002      # the expansion meets a step now and then
    frame = got[["n", "u"]]  # noqa: F841
    other = duckdb.sql(f"SELECT n, u, {dist.poisson_quantile_sql('n', 'u')} AS k FROM frame").df()
    assert (other.k.to_numpy() == got.k.to_numpy()).all()


def test_poisson_draws_add_up(spark):
    """Draws for a mean of 10^9 stay Poisson: mean and variance, and quantiles of the standardised draw."""
    u = (np.arange(4000) + 0.5) / 4000
    rows = [(10**9, float(x)) for x in u]
    k = dist.with_poisson(spark.createDataFrame(rows, "n long, u double"), "n", "u", "k").toPandas().k.to_numpy()
    z = (k - 1e9) / math.sqrt(1e9)
    assert abs(z.mean()) < 1e-3 and abs(z.var() - 1) < 5e-3
