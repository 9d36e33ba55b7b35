"""Physical-plan checks for the scale-critical shapes (pruned scans, bounded passes, no global window)."""

import re

from conftest import SF

import __spark_entry__ as E


def _plan(spark, name):
    df = E.queries()[name](spark, SF)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_ate_single_pass_and_pruned_scan(spark):
    plan = _plan(spark, "ate")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    orders = [s for s in schemas if "o_orderkey" in s]
    assert orders and all("o_orderstatus" not in s and "o_orderpriority" not in s for s in orders)
    assert "Window" not in plan and "ArrowEvalPython" not in plan


def test_quantile_query_scans_base_a_bounded_number_of_times(spark):
    plan = _plan(spark, "decile_stats")
    assert len(re.findall(r"FileScan parquet", plan)) <= 10   # a few passes, not one per branch
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_qini_window_is_partitioned_by_range(spark):
    plan = _plan(spark, "qini_curve")
    # the ranges are drawn once, before this plan: both reads of the rows see the stored range ids
    assert "rangepartitioning" not in plan and "ExistingRDD" in plan
    big_windows = [w for w in re.findall(r"Window \[[^\n]*", plan) if "score" in w and "DESC" in w]
    assert big_windows and all("windowspecdefinition(_bucket" in w for w in big_windows)


def test_summary_parts_do_not_multiply_their_partitions(spark):
    """Five one-row frames of several partitions each: the row is made by as many tasks as the first frame has."""
    from upshot.sources import sinks
    parts = [spark.createDataFrame([(i,)], f"c{i} int") for i in range(5)]
    row = sinks.summary_row(parts)
    assert [tuple(r) for r in row.collect()] == [(0, 1, 2, 3, 4)]
    assert row.rdd.getNumPartitions() <= parts[0].rdd.getNumPartitions()
