"""Exact, skew-proof hash sampling: the ``quota`` rows of each stratum with the smallest hash.

A window ``row_number() over (partition by stratum order by hash)`` would
sort a whole stratum in one task (a stratum may hold a third of the rows).
Because the hash is uniform, a fixed histogram of it is balanced whatever
the skew: count rows per (stratum, hash bin), find the bin where each
stratum's quota is reached, keep the rows up to that bin and rank rows only
inside their (stratum, bin) - each such group holds about size / bins rows,
and only selected rows (about the quota) are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.materialize import bounded
from upshot.session import ensure_checkpoint_dir


def smallest_by_hash(df: DataFrame, by: list[str], quotas: DataFrame, u: str, tie: str,
                     bins: int = 65536) -> DataFrame:
    """Rows of ``df`` whose rank by (u, tie) within their stratum is <= the stratum's ``quota``.

    ``quotas`` has columns ``by..., quota`` (one row per stratum, small). Two
    passes over ``df``: the histogram, then the selection. Null is a stratum
    like any other.
    """
    ensure_checkpoint_dir(df.sparkSession)
    stratum = F.struct(F.lit(0).alias("_"), *by).alias("_key")     # a struct joins null strata too
    keys = ["_key"]
    hb = F.least(F.floor(F.col(u) * bins), F.lit(bins - 1)).cast("int")
    keyed = df.select("*", hb.alias("_hb"), stratum)
    quotas = quotas.select(stratum, "quota")
    hist = keyed.groupBy(*keys, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_hb").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (hist.withColumn("_cum", F.sum("_c").over(w)).join(quotas, keys)
           .where(F.col("_cum") >= F.col("quota"))
           .groupBy(*keys).agg(F.min_by(F.struct("_hb", (F.col("quota") - (F.col("_cum") - F.col("_c"))).alias("need")),
                                        "_hb").alias("_k"))
           .select(*keys, F.col("_k._hb").alias("_cut"), F.col("_k.need").alias("_need")))
    cut, small_side = bounded(cut, with_flag=True)  # one row per stratum; strata without a row keep every row
    # A shuffle join would put a whole stratum in one task: broadcast the cuts when their row count is proven small.
    sel = keyed.join(F.broadcast(cut) if small_side else cut, keys, "left").where(F.col("_cut").isNull() | (F.col("_hb") <= F.col("_cut")))
    rank = Window.partitionBy(*keys, "_hb").orderBy(u, tie)
    out = (sel.withColumn("_r", F.row_number().over(rank))
           .where(F.col("_cut").isNull() | (F.col("_hb") < F.col("_cut")) | (F.col("_r") <= F.col("_need"))))
    return out.select(*df.columns)


def sample_n(df: DataFrame, n: int, u: str, tie: str) -> DataFrame:
    """Exactly min(n, rows) rows: those with the smallest (u, tie) - a seeded sample without replacement."""
    spark = df.sparkSession
    return smallest_by_hash(df, [], spark.createDataFrame([(int(n),)], "quota long"), u, tie)


def cuped_sample_size(n_rows: int, floor_n: int = 100000, share: float = 0.10) -> int:
    """max(floor_n, share * N), capped at N (the reference raises instead of capping)."""
    return min(n_rows, max(floor_n, int(share * n_rows)))
