"""Registered loader queries: schema check, narrowed types, feature discovery, integrity."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from upshot.operators import validation
from upshot.plans.catalog import BALANCE_SQL
from upshot.plans.registry import R, register, rnd, with_p
from upshot.functions.dist import chi2_1dof_critical, chi2_1dof_p_sql
from upshot.session import scratch_path
from upshot.sources.experiment import EXPECTED_RATIO, FEATURES, experiment, experiment_cte
from upshot.sources.loader import FLAG_COLUMNS, read_experiment

# The loader's schema has twelve features; the last six are simple functions of the fixture's.
_MORE = {"f6": "f0 / 3", "f7": "f1 * 1.1", "f8": "f2 + f3", "f9": "f4 - f5", "f10": "f0 - f1", "f11": "f3 * f4"}
_ALL = [*FEATURES, *_MORE]


def _loaded_sql() -> str:
    cols = [(f, "float", f"CAST(CAST({f} AS FLOAT) AS DOUBLE)") for f in _ALL]
    cols += [(f, "tinyint", f"CAST(CAST({f} AS TINYINT) AS DOUBLE)") for f in FLAG_COLUMNS]
    more = ", ".join(f"CAST({e} AS DOUBLE) AS {f}" for f, e in _MORE.items())
    return experiment_cte() + f", x AS (SELECT *, {more} FROM experiment)\n" + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS name, '{t}' AS kind, {str(t == 'float').lower()} AS is_feature, count({c}) AS n, {R(f'avg({e})', 4)} AS mean FROM x"
        for c, t, e in cols)


@register("loaded_table", _loaded_sql())
def q_loaded(spark, sf):
    """The experiment written as a table of the loader's schema and read by it: types, features and values."""
    path = scratch_path(spark, f"loader-{uuid.uuid4().hex}")
    more = [F.expr(e).cast("double").alias(f) for f, e in _MORE.items()]
    experiment(spark, sf).select(*FEATURES, *more, *FLAG_COLUMNS).write.parquet(path)
    df = read_experiment(spark, path, unit_ids=True)
    features = validation.discover_features(df)
    kinds = dict(df.dtypes)
    names = [c for c in df.columns if c != "unit_id"]
    wide = df.agg(*[a for c in names for a in (F.count(c).alias(f"{c}_n"), F.avg(F.col(c).cast("double")).alias(f"{c}_m"))])
    long = wide.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("name"), F.lit(kinds[c]).alias("kind"), F.lit(c in features).alias("is_feature"),
        F.col(f"{c}_n").alias("n"), F.col(f"{c}_m").alias("mean")) for c in names])).alias("r"))
    return rnd(long.select("r.*"), 4)


@register("integrity_report", BALANCE_SQL + f"""
, c AS (SELECT count(CASE WHEN treatment = 0 THEN 1 END) AS n_control, count(CASE WHEN treatment = 1 THEN 1 END) AS n_treatment
        FROM experiment)
, k AS (SELECT *, power(n_control - (n_control + n_treatment) * {1 - EXPECTED_RATIO!r}, 2) / ((n_control + n_treatment) * {1 - EXPECTED_RATIO!r})
             + power(n_treatment - (n_control + n_treatment) * {EXPECTED_RATIO!r}, 2) / ((n_control + n_treatment) * {EXPECTED_RATIO!r}) AS chi2
        FROM c)
SELECT feature_idx, feature, {R('smd')} AS smd, abs(smd) < 0.1 AS is_balanced, n_control, n_treatment, {R('chi2')} AS chi2,
  chi2 < {chi2_1dof_critical(0.001)!r} AS valid, {R(chi2_1dof_p_sql('chi2'), 12)} AS p_value FROM s, k
""")
def q_integrity(spark, sf):
    """Sample ratio and balance from one read of the rows."""
    srm, balance = validation.integrity(experiment(spark, sf), FEATURES, expected_ratio=EXPECTED_RATIO)
    out = balance.select("feature_idx", "feature", "smd", "is_balanced").crossJoin(
        srm.select("n_control", "n_treatment", "chi2", "valid", "p_value"))
    return with_p(out)
