"""Session-level helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from upshot.session import ensure_checkpoint_dir, prepare  # noqa: F401 - the operators take prepare from here

#: Spark setting: shuffle files of a query are deleted when the query ends, not when the driver collects garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared folder of ``spark.checkpoint.dir`` and read it back.

    Later jobs start from the files, so a lost executor costs no recomputation
    of what lies before, and the shuffle files of the written query go at once.
    Folders carry the application's id.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/upshot-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN)
        else:
            spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``cut`` from which everything has been written that they are needed for."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
