"""Report sinks: write tables, isolate failures, write a manifest, validate row counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Minimum row counts per report table.
MIN_ROWS = {
    "experiment_summary": 1, "bandit_trajectory": 100, "uplift_sample": 1000, "decile_stats": 5,
    "covariate_balance": 1, "statistics_results": 2, "qini_curve_data": 100, "feature_importance": 1,
    "segment_profile": 1, "policy_comparison": 3, "archetype_summary": 2, "tree_rules": 1,
    "distillation_benchmark": 2, "monitoring_timeseries": 8, "psi_scores": 8, "drift_simulation": 100,
}


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Overwrite one report table (Parquet by default, CSV with a header as an option)."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def export_all(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]], out_dir: str, run_date: str,
               fmt: str = "parquet") -> DataFrame:
    """Build and write every table; a failing table is recorded and the rest continue.

    Returns the manifest as a one-row DataFrame (also written as JSON).
    """
    exported, failed = [], []
    for name, build in tables.items():
        try:
            write_report(build(), f"{out_dir}/{name}", fmt)
            exported.append(name)
        except Exception as exc:  # noqa: BLE001 - isolate one table's failure
            failed.append(f"{name}: {type(exc).__name__}: {str(exc).splitlines()[0][:300] if str(exc) else ''}")
    manifest = spark.createDataFrame(
        [(run_date, out_dir, exported, failed, len(exported), len(failed))],
        "run_date string, output_dir string, exported_files array<string>, failed_files array<string>, "
        "total_exported int, total_failed int")
    manifest.coalesce(1).write.mode("overwrite").json(f"{out_dir}/_manifest")
    return manifest


def validate_exports(spark: SparkSession, out_dir: str, fmt: str = "parquet", min_rows=None) -> DataFrame:
    """Per table: exists, rows, minimum, ok (reads each table back and counts it).

    A table that is not there fails its check; one that is there but cannot be read raises the reader's error.
    """
    rows = []
    for name, need in (min_rows or MIN_ROWS).items():
        try:
            reader = spark.read.option("header", True) if fmt == "csv" else spark.read
            n = reader.format(fmt).load(f"{out_dir}/{name}").count()
            rows.append((name, True, n, need, n >= need))
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            rows.append((name, False, 0, need, False))
    return spark.createDataFrame(rows, "table string, exists boolean, n_rows long, min_rows long, ok boolean")


def summary_row(parts: list[DataFrame]) -> DataFrame:
    """Cross join of one-row frames into the single summary row.

    Each frame is broadcast: as Cartesian products their partition counts would multiply (five local frames of 8
    partitions are 4,096 tasks).
    """
    out = parts[0]
    for p in parts[1:]:
        out = out.crossJoin(F.broadcast(p))
    return out

