"""Query registry and shared helpers for the registered queries.

``QUERIES[name](spark, sf_dir)`` is the Spark plan; ``ORACLE[name]`` is the
same question in plain SQL over the pre-registered tables (the correctness
oracle). Queries whose semantics SQL cannot express have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.functions.columns import fixed, fixed_sql
from upshot.functions.dist import z_critical
from upshot.sources.experiment import experiment, experiment_cte

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VALUE, COST = 10.0, 0.10
Z95 = z_critical(0.05)


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return experiment(spark, sf_dir).withColumn("score", F.col("f0") / F.lit(500000.0) - F.lit(0.3))


SCORED_CTE = experiment_cte() + ", scored AS (SELECT *, f0 / 500000.0 - 0.3 AS score FROM experiment)\n"


def rnd(df: DataFrame, digits: int = 6, keep=()) -> DataFrame:
    """Round every double column (report-layer rounding) except ``keep``."""
    return df.select(*[fixed(c, digits).alias(c) if t == "double" and c not in keep else F.col(c)
                       for c, t in df.dtypes])


def with_p(df: DataFrame, digits: int = 6, keep=()) -> DataFrame:
    """``rnd`` that gives the p-value twelve decimals."""
    return rnd(df, digits, keep=(*keep, "p_value")).withColumn("p_value", fixed("p_value", 12))


def R(expr: str, digits: int = 6) -> str:
    return fixed_sql(expr, digits)


_MEMO: dict = {}


def memo(spark: SparkSession, key: tuple, build):
    """Reuse a trained artefact (model, scored checkpoint, built report) within one Spark application.

    Keyed on the application id, so a new session never sees objects of a stopped one.
    """
    full = (spark.sparkContext.applicationId, *key)
    if full not in _MEMO:
        _MEMO[full] = build()
    return _MEMO[full]
