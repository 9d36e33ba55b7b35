"""The ``experiment`` view: one randomised-experiment row per order.

The driver tables carry no experiment, so units, arms and outcomes are
derived from ``orders`` joined to ``customer`` with integer congruences only
(no engine-specific hash or random function). Spark and DuckDB therefore
produce identical rows, and the same SQL text serves as the oracle.

Planted truth: uplift about +0.10 when ``f0 > 250000``, about -0.04 when
``f0 <= 50000``, about 0 in between; ``f1 > 5000`` lifts the base rate by
0.05. Expected treatment share 0.85.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upshot.sources.tables import read_table

FEATURES = ["f0", "f1", "f2", "f3", "f4", "f5"]
EXPECTED_RATIO = 0.85

# The congruences and planted effects that define the fixture.
_BASE_COLUMNS = [
    "o_orderkey AS unit_id",
    "o_orderdate AS ts",
    "o_totalprice AS f0",
    "c_acctbal AS f1",
    "CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS f2",
    "CAST(c_nationkey AS DOUBLE) AS f3",
    "CAST(month(o_orderdate) AS DOUBLE) AS f4",
    "CAST(day(o_orderdate) AS DOUBLE) AS f5",
    "CASE WHEN (o_orderkey * 48271 + 11) % 10007 < 8506 THEN 1 ELSE 0 END AS treatment",
    "CAST((o_orderkey * 1664525 + 1013904223) % 1000003 AS DOUBLE) / 1000003 AS u",
    "CAST((o_orderkey * 22695477 + 1) % 1000003 AS DOUBLE) / 1000003 AS v",
]

_CONVERSION = """
  CASE WHEN u < 0.05
         + CASE WHEN treatment = 1 THEN
             (CASE WHEN f0 > 250000 THEN 0.10 WHEN f0 <= 50000 THEN -0.04 ELSE 0.0 END)
           ELSE 0.0 END
         + CASE WHEN f1 > 5000 THEN 0.05 ELSE 0.0 END
       THEN 1 ELSE 0 END
"""

# visit >= conversion; exposure only for treated units (our derivation).
_VISIT = "CASE WHEN conversion = 1 OR v < 0.30 THEN 1 ELSE 0 END"
_EXPOSURE = "CASE WHEN treatment = 1 AND (conversion = 1 OR v < 0.60) THEN 1 ELSE 0 END"

EXPERIMENT_SQL = f"""
SELECT unit_id, ts, f0, f1, f2, f3, f4, f5, treatment, conversion,
  {_VISIT} AS visit, {_EXPOSURE} AS exposure
FROM (
  SELECT *, {_CONVERSION} AS conversion
  FROM (
    SELECT {', '.join(_BASE_COLUMNS)}
    FROM orders JOIN customer ON o_custkey = c_custkey
  ) q0
) q1
"""


def experiment_cte() -> str:
    """``WITH experiment AS (...)`` prefix for oracle SQL."""
    return f"WITH experiment AS ({EXPERIMENT_SQL})\n"


def experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The experiment as a lazy DataFrame over the whole orders and customer tables.

    Only the five order columns and three customer columns are read; the
    join strategy is left to Catalyst/AQE (customer grows with the scale
    factor, so it is not force-broadcast).
    """
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal", "c_nationkey"])
    base = orders.join(customer, orders.o_custkey == customer.c_custkey).selectExpr(*_BASE_COLUMNS)
    with_conv = base.withColumn("conversion", F.expr(_CONVERSION))
    return with_conv.select(
        "unit_id", "ts", *FEATURES, "treatment", "conversion",
        F.expr(_VISIT).alias("visit"), F.expr(_EXPOSURE).alias("exposure"))

