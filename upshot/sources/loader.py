"""Experiment scan with the reference's schema contract: required names, narrowed types."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_COLUMNS = [f"f{i}" for i in range(12)]
FLAG_COLUMNS = ["treatment", "conversion", "visit", "exposure"]
REQUIRED = FEATURE_COLUMNS + FLAG_COLUMNS


def validate_schema(df: DataFrame, required=REQUIRED) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df


def narrow_types(df: DataFrame, flags=FLAG_COLUMNS) -> DataFrame:
    """Doubles become float, 0/1 flags become tinyint; other columns are kept as they are.

    A flag value other than 0, 1 or null (0.7, 2, NaN) fails the job that reads
    it rather than being cut to an integer.
    """
    out = []
    for name, dtype in df.dtypes:
        if name in flags:
            wrong = F.raise_error(F.concat(F.lit(f"flag {name} is neither 0 nor 1: "), F.col(name).cast("string")))
            fits = F.col(name).isNull() | F.col(name).cast("double").isin(0.0, 1.0)
            out.append(F.when(fits, F.col(name).cast("tinyint")).otherwise(wrong.cast("tinyint")).alias(name))
        elif dtype == "double":
            out.append(F.col(name).cast("float").alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def read_experiment(spark: SparkSession, path: str, required=REQUIRED, narrow: bool = True,
                    unit_ids: bool = False) -> DataFrame:
    """Parquet scan, schema check, optional narrowing (lazy apart from the footer read).

    With ``unit_ids``, rows without a ``unit_id`` column get one: the file's
    name and the row's place in it. It does not change when the files are read
    in other splits, in another order or from another folder, so hash splits
    and samples of the rows stay the same.
    """
    if "://" not in path and not os.path.exists(path):
        raise FileNotFoundError(f"File not found: {path}")
    df = validate_schema(spark.read.parquet(path), required)
    if unit_ids and "unit_id" not in df.columns:
        df = df.withColumn("unit_id", F.concat_ws(":", "_metadata.file_name", F.col("_metadata.row_index").cast("string")))
    return narrow_types(df) if narrow else df


def flags_are_binary(df: DataFrame, flags=FLAG_COLUMNS) -> DataFrame:
    """One row: for each flag, whether every value is 0 or 1 (a single aggregate)."""
    return df.agg(*[F.min(F.col(f).isin(0, 1).cast("int")).cast("boolean").alias(f"{f}_is_binary")
                    for f in flags if f in df.columns])
