"""Registered report queries (S6-S10, E14): the full report written and validated."""

from __future__ import annotations

import uuid

from upshot.plans.registry import COST, VALUE, memo, register, rnd
from upshot.plans.report import ExperimentReport, ReportConfig
from upshot.session import scratch_path
from upshot.sources import sinks
from upshot.sources.experiment import FEATURES, experiment


def _report(spark, sf):
    def build():
        cfg = ReportConfig(features=FEATURES, value=VALUE, cost=COST, n_estimators=20, max_depth=4,
                           profile_features=["f2", "f3", "f4"], run_date="2024-01-31")
        return ExperimentReport(spark, experiment(spark, sf), cfg).build()
    return memo(spark, ("report", sf), build)


@register("experiment_summary")
def q_summary(spark, sf):
    return rnd(_report(spark, sf).experiment_summary(), 6, keep=("srm_p_value", "ate_p_value", "cuped_p_value"))


@register("report_export_validation")
def q_export(spark, sf):
    rep = _report(spark, sf)
    out = scratch_path(spark, f"report-{uuid.uuid4().hex}")
    rep.export(out)
    return sinks.validate_exports(spark, out)
