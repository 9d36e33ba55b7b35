"""End-to-end report command: validate, estimate, learn, evaluate, target, monitor, export.

    python -m upshot.plans.run_report --input data.parquet --out OUT_DIR
    python -m upshot.plans.run_report --sf-dir /root/testdata/sf0.01 --out OUT_DIR

``--input`` takes the reference's experiment schema (f0..f11, treatment,
conversion, visit, exposure; extra columns kept). Without a ``unit_id``
column one is derived with ``monotonically_increasing_id`` (stable for a
given file layout); without ``ts`` the monitoring periods are equal hash
slices. ``--sf-dir`` uses the experiment view derived from the driver tables.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame

from upshot.plans.report import ExperimentReport, ReportConfig
from upshot.session import local_session
from upshot.sources import sinks
from upshot.sources.experiment import FEATURES, experiment
from upshot.sources.loader import FEATURE_COLUMNS, read_experiment


def main(argv=None, spark=None) -> DataFrame:
    ap = argparse.ArgumentParser(description="Experiment report")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--input")
    src.add_argument("--sf-dir")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--value", type=float, default=10.0)
    ap.add_argument("--cost", type=float, default=0.10)
    ap.add_argument("--n-estimators", type=int, default=100)
    ap.add_argument("--max-depth", type=int, default=5)
    ap.add_argument("--bootstraps", type=int, default=20)
    ap.add_argument("--sample-size", type=int, default=50000)
    ap.add_argument("--run-date", default="1970-01-01")
    ap.add_argument("--quantiles", default="exact", choices=["exact", "approx"])
    a = ap.parse_args(argv)
    spark = spark or local_session()
    if a.input:
        exp = read_experiment(spark, a.input, unit_ids=True)
        feats = [f for f in FEATURE_COLUMNS if f in exp.columns]
        profile = [f for f in ["f2", "f3", "f4", "f6", "f9"] if f in feats]
    else:
        exp, feats, profile = experiment(spark, a.sf_dir), FEATURES, ["f2", "f3", "f4"]
    cfg = ReportConfig(features=feats, value=a.value, cost=a.cost, n_estimators=a.n_estimators,
                       max_depth=a.max_depth, bootstraps=a.bootstraps, sample_size=a.sample_size,
                       profile_features=profile, run_date=a.run_date, quantile_method=a.quantiles)
    manifest = ExperimentReport(spark, exp, cfg).export(a.out, a.format)
    check = sinks.validate_exports(spark, a.out, a.format)
    print(json.dumps(manifest.first().asDict()))
    check.show(truncate=False)
    return check


if __name__ == "__main__":
    main()
