"""Cutting lineage without computing a plan twice.

``checkpoint()`` on a frame that is not persisted runs its plan once to
count and again to write. Two helpers avoid that:

* ``small(df, max_rows)``: for results whose size is fixed by parameters
  (edges per group, target buckets, per-stratum cuts). The rows are collected
  under an explicit bound and rebuilt as a local relation: one job, no files.
* ``checkpointed(df)``: persist, reliable checkpoint to the shared folder,
  unpersist - one computation, and the result survives executor loss.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from upshot.session import ensure_checkpoint_dir


def small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Collect a frame whose size is bounded by construction and rebuild it as a local relation.

    (A ``limit`` before ``collect`` would run as an incremental take - several
    jobs - so the bound is checked after the single collect instead.)
    """
    rows = df.collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows, got {len(rows)}; use checkpointed()")
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return cached.checkpoint(eager=True)
    finally:
        cached.unpersist()


def bounded(df: DataFrame, max_local_rows: int = 100_000, with_flag: bool = False):
    """Materialise an aggregate whose size depends on the data (e.g. one row per group).

    Computed once into the cache; kept as a local relation when it has at most
    ``max_local_rows`` rows, otherwise written as a reliable checkpoint.
    ``with_flag`` also returns whether the result is the small local relation
    (a proven size bound, e.g. to decide on a broadcast join).
    """
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cached.count() <= max_local_rows:
            out, local = df.sparkSession.createDataFrame(cached.collect(), schema=df.schema), True
        else:
            out, local = cached.checkpoint(eager=True), False
        return (out, local) if with_flag else out
    finally:
        cached.unpersist()
