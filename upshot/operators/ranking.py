"""Ranking quality of an uplift score: quantile lift, Qini curve, AUUC, bootstrap band.

Scale notes
-----------
* Quantile bins use :func:`upshot.functions.quantiles.quantiles` (exact, no
  global sort, no single-task percentile buffer); the edges are one broadcast row.
* The Qini curve needs running sums in global score order. A global
  ``Window.orderBy`` would move every row into one task, so the order
  ``(score desc, unit asc)`` is range-partitioned into P ranges with P
  growing with the row count (ties on a hot score are split by the unit
  id). The rows are written once with their range ids; per-range totals (P
  rows) give exclusive prefix offsets, running sums run inside each range
  and add the offset. Both read the written ids, so they agree whatever the
  planner reuses and whichever executors are lost.
* The bootstrap never materialises B copies of the data: one aggregate counts
  rows by (score bucket, arm, outcome), and every such cell takes one Poisson
  draw per replicate; curves are built from B x K rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.columns import safe_div, unit_uniform
from upshot.functions.dist import with_poisson
from upshot.functions.quantiles import bin_of, quantile_array
from upshot.functions.materialize import checkpointed
from upshot.session import ensure_checkpoint_dir


# --------------------------------------------------------------------- deciles

def decile_stats(scored: DataFrame, score: str = "score", treatment: str = "treatment",
                 outcome: str = "conversion", n_bins: int = 10, method: str = "exact") -> DataFrame:
    """Quantile bins of the score (right-closed); per bin arm means, counts and actual lift.

    ``decile`` runs 1..n_bins with n_bins the highest scores. Bins whose
    edges coincide (heavy ties) are simply absent. Rows without a score take
    no part.
    """
    scored = scored.where(F.col(score).isNotNull())
    probs = [i / n_bins for i in range(1, n_bins)]
    edges = quantile_array(scored, score, probs, method=method).select("edges")
    t, y = F.col(treatment), F.col(outcome).cast("double")
    binned = (scored.select(score, treatment, outcome).crossJoin(F.broadcast(edges))
              .withColumn("decile", bin_of(score, "edges", len(probs)) + 1))
    out = binned.groupBy("decile").agg(
        F.count(F.lit(1)).alias("n_obs"),
        F.count(F.when(t == 0, 1)).alias("n_control"),
        F.count(F.when(t == 1, 1)).alias("n_treatment"),
        F.avg(F.col(score).cast("double")).alias("mean_pred_uplift"),
        F.avg(F.when(t == 0, y)).alias("mean_y_control"),
        F.avg(F.when(t == 1, y)).alias("mean_y_treatment"))
    return out.withColumn("actual_lift", F.col("mean_y_treatment") - F.col("mean_y_control"))


def mean_decile_lift(deciles: DataFrame) -> DataFrame:
    return deciles.agg(F.avg("actual_lift").alias("mean_decile_lift"))


def decile_lift_ratio(deciles: DataFrame) -> DataFrame:
    """Top-bin lift over the unweighted mean bin lift."""
    top = deciles.agg(F.max_by("actual_lift", "decile").alias("top_lift"), F.avg("actual_lift").alias("mean_lift"))
    return top.withColumn("decile_lift_ratio", safe_div(F.col("top_lift"), F.col("mean_lift")))


def cate_histogram(scored: DataFrame, score: str = "score", bins: int = 50) -> DataFrame:
    """Equal-width histogram of the scores between min and max (last bin closed); null scores take no part."""
    scored = scored.where(F.col(score).isNotNull())
    s = F.col(score).cast("double")
    rng = scored.agg(F.min(s).alias("_lo"), F.max(s).alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    raw = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.floor(safe_div(s - F.col("_lo"), width)).cast("int"))
    b = F.least(raw, F.lit(bins - 1))
    out = (scored.select(score).crossJoin(F.broadcast(rng)).withColumn("bin", b)
           .groupBy("bin", "_lo", "_hi").agg(F.count(F.lit(1)).alias("n")))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    return out.select("bin", (F.col("_lo") + F.col("bin") * w).alias("bin_start"),
                      (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_end"), "n")


# ------------------------------------------------------------------ qini curve

def qini_rows(scored: DataFrame, score: str = "score", treatment: str = "treatment",
              outcome: str = "conversion", unit: str = "unit_id", buckets: int = 16,
              rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Every row with its position ``idx`` (0-based, order score desc / unit asc) and Qini value.

    qini = (cum_y_t / max(cum_n_t,1) - cum_y_c / max(cum_n_c,1)) * (cum_n_t + cum_n_c)
    """
    return _qini_rows(scored, score, treatment, outcome, unit, buckets, rows_per_bucket)[0]


def _qini_rows(scored, score, treatment, outcome, unit, buckets, rows_per_bucket):
    """Range-partition the order (score desc, unit asc) into P ranges, P growing with the row count.

    Spark samples the composite key to pick the range bounds, so ties on a
    hot score are split by the unit id and every range holds about
    ``rows_per_bucket`` rows. The bounds are sampled, so a second run of the
    exchange may cut elsewhere: the rows are checkpointed with their range
    ids, and both the totals and the running sums read that. The join of the
    P offsets shares the window's partitioning by range, so its form is left
    to the planner.
    """
    t = F.col(treatment).cast("long")
    y = F.col(outcome).cast("double")
    keyed = scored.select(F.col(unit), F.col(score).cast("double").alias(score),
                          t.alias("_t"), y.alias("_y")).where(F.col(score).isNotNull())
    n = keyed.count()
    n_ranges = max(1, int(buckets or 1), -(-n // max(rows_per_bucket, 1)))
    ranged = checkpointed(keyed.repartitionByRange(n_ranges, F.desc(score), F.asc(unit))
                          .withColumn("_bucket", F.spark_partition_id()))
    parts = {"_yt": F.col("_y") * F.col("_t"), "_nt": F.col("_t"),
             "_yc": F.col("_y") * (1 - F.col("_t")), "_nc": 1 - F.col("_t")}
    totals = ranged.groupBy("_bucket").agg(*[F.sum(e).alias(k) for k, e in parts.items()])
    prior = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)   # P rows only
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(k).over(prior), F.lit(0)).alias(f"{k}_off")
                                         for k in parts])
    run = (Window.partitionBy("_bucket").orderBy(F.desc(score), F.asc(unit))
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = ranged.join(offsets, "_bucket")
    rows = joined.select(unit, score, *[(F.sum(e).over(run) + F.col(f"{k}_off")).alias(k)
                                        for k, e in parts.items()])  # one Window operator
    n_t, n_c = F.col("_nt"), F.col("_nc")
    qini = (F.col("_yt") / F.greatest(n_t, F.lit(1)) - F.col("_yc") / F.greatest(n_c, F.lit(1))) * (n_t + n_c)
    return rows.select(unit, score, (n_t + n_c - 1).alias("idx"), qini.alias("qini")), n


def downsample_grid(n_points: int, n_rows: Column) -> Column:
    """Indices trunc(linspace(0, n-1, P)) computed exactly as (k (n-1)) div (P-1)."""
    if n_points == 1:
        return F.array(F.lit(0).cast("long"))
    return F.transform(F.sequence(F.lit(0), F.lit(n_points - 1)),
                       lambda k: F.floor(k.cast("long") * (n_rows - 1) / F.lit(n_points - 1)).cast("long"))


def qini_curve(scored: DataFrame, n_points: int = 1000, **kw) -> DataFrame:
    """Qini curve reduced to ``n_points`` evenly spaced positions plus the raw AUUC.

    Columns: point, idx, population_pct (idx/(n-1)), qini, auuc, n.
    AUUC is the trapezoid area over all n rows on x = i/(n-1):
    (sum(q) - (q_first + q_last)/2) / (n-1). One aggregation over the
    windowed rows yields the sum, the end points and the (at most
    ``n_points``) grid rows.
    """
    rows, n = _qini_rows(scored, kw.get("score", "score"), kw.get("treatment", "treatment"),
                         kw.get("outcome", "conversion"), kw.get("unit", "unit_id"), kw.get("buckets", 16),
                         kw.get("rows_per_bucket", 2_000_000))
    grid_idx = sorted({(k * (n - 1)) // max(n_points - 1, 1) for k in range(n_points)}) if n else []
    spark = scored.sparkSession
    grid = spark.createDataFrame([(int(i),) for i in grid_idx], "idx long").withColumn("_g", F.lit(True))
    marked = rows.join(F.broadcast(grid), "idx", "left")   # at most n_points grid rows
    summary = marked.agg(
        F.count(F.lit(1)).alias("n"), F.sum("qini").alias("_s"),
        F.min_by("qini", "idx").alias("_q0"), F.max_by("qini", "idx").alias("_q1"),
        F.collect_list(F.when(F.col("_g"), F.struct("idx", "qini"))).alias("_pts"))
    auuc = F.when(F.col("n") <= 1, F.lit(0.0)).otherwise(
        (F.col("_s") - (F.col("_q0") + F.col("_q1")) / 2.0) / (F.col("n") - 1))
    pts = summary.select("n", auuc.alias("auuc"), F.map_from_entries("_pts").alias("_m"),
                         F.posexplode(downsample_grid(n_points, F.col("n"))).alias("point", "idx"))
    return pts.select("point", "idx",
                      F.when(F.col("n") <= 1, F.lit(0.0)).otherwise(F.col("idx") / (F.col("n") - 1)).alias("population_pct"),
                      F.element_at("_m", F.col("idx")).alias("qini"), "auuc", "n")


def random_line(curve: DataFrame) -> DataFrame:
    """Straight line from 0 to the last curve value: ``x * y_last``."""
    last = curve.agg(F.max_by("qini", "idx").alias("_last"))
    return curve.crossJoin(last).withColumn("random_qini", F.col("population_pct") * F.col("_last")).drop("_last")


# -------------------------------------------------------------------- bootstrap

def bootstrap_draws(cells: DataFrame, n_bootstraps: int, seed: int = 42) -> DataFrame:
    """(b, bucket, arm, y, w): the weight of every cell in every replicate.

    The sum of n independent Poisson(1) weights is Poisson(n), so a cell of n
    equal rows takes one draw. It is the Poisson quantile at a uniform that is
    a hash of (bucket, arm, y, b, seed), so reruns agree and SQL can repeat it.
    """
    name = F.concat_ws(":", "bucket", "arm", "y", "b")
    half = F.lit(0.5 ** 53)                                   # keeps the uniform off 0
    drawn = cells.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_bootstraps - 1)))).withColumn(
        "u", unit_uniform(name, seed) + half)
    return with_poisson(drawn, "n", "u", "w").select("b", "bucket", "arm", "y", "w")


def bootstrap_qini(scored: DataFrame, score: str = "score", treatment: str = "treatment",
                   outcome: str = "conversion", n_bootstraps: int = 50,
                   n_points: int = 1000, n_buckets: int = 1000, seed: int = 42,
                   method: str = "exact") -> DataFrame:
    """Poisson-bootstrap Qini band on a common grid of ``n_points`` population fractions.

    The rows are read to place the bucket edges and once more to count them by
    (score bucket, arm, outcome); everything else works on those cells, however
    many replicates there are. Each replicate's curve is evaluated at
    score-bucket boundaries (ties stay together, so the curve is order
    independent) and linearly interpolated on the grid. Output per grid point:
    population_pct, y_mean, y_lower_95ci, y_upper_95ci, auuc_mean, auuc_std
    (population std over replicates). Rows without a score, arm or outcome take no part.
    """
    ensure_checkpoint_dir(scored.sparkSession)
    t, y = F.col(treatment).cast("long"), F.col(outcome).cast("double")
    rows = scored.select(F.col(score).cast("double").alias("_s"), t.alias("arm"), y.alias("y")).where(
        "_s IS NOT NULL AND arm IN (0, 1) AND y IS NOT NULL")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    edges = quantile_array(rows, "_s", probs, method=method).select("edges")
    cells = (rows.crossJoin(F.broadcast(edges))
             .select((F.lit(n_buckets) - bin_of("_s", "edges", len(probs))).alias("bucket"), "arm", "y")  # 1 = highest scores
             .groupBy("bucket", "arm", "y").agg(F.count(F.lit(1)).alias("n")))
    w, arm = F.col("w").cast("double"), F.col("arm")
    agg = bootstrap_draws(checkpointed(cells), n_bootstraps, seed).groupBy("b", F.col("bucket").alias("_bucket")).agg(
        F.sum(w * F.col("y") * arm).alias("yt"), F.sum(w * arm).alias("nt"),
        F.sum(w * F.col("y") * (1 - arm)).alias("yc"), F.sum(w * (1 - arm)).alias("nc"))
    agg = checkpointed(agg.where("nt + nc > 0"))  # B x K rows; everything after this is small
    cum = Window.partitionBy("b").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pts = agg.select("b", "_bucket", *[F.sum(c).over(cum).alias(c) for c in ["yt", "nt", "yc", "nc"]])
    tot = Window.partitionBy("b")
    pts = pts.select(
        "b", "_bucket",
        ((F.col("nt") + F.col("nc")) / F.max(F.col("nt") + F.col("nc")).over(tot)).alias("x"),
        ((F.col("yt") / F.greatest("nt", F.lit(1.0)) - F.col("yc") / F.greatest("nc", F.lit(1.0)))
         * (F.col("nt") + F.col("nc"))).alias("y"))
    origin = pts.select("b").distinct().select("b", F.lit(0).alias("_bucket"), F.lit(0.0).alias("x"),
                                               F.lit(0.0).alias("y"))
    pts = pts.unionByName(origin)
    # AUUC per replicate: trapezoid over the bucket-level points.
    seg = Window.partitionBy("b").orderBy("x", "_bucket")
    auucs = (pts.withColumn("_px", F.lag("x").over(seg)).withColumn("_py", F.lag("y").over(seg))
             .groupBy("b").agg(F.sum(F.coalesce((F.col("x") - F.col("_px")) * (F.col("y") + F.col("_py")) / 2,
                                                F.lit(0.0))).alias("auuc")))
    auuc_stats = auucs.agg(F.avg("auuc").alias("auuc_mean"), F.stddev_pop("auuc").alias("auuc_std"))
    # Interpolate every replicate on the common grid.
    grid = (pts.select("b").distinct()
            .crossJoin(F.broadcast(
                scored.sparkSession.range(n_points).select(
                    F.col("id").alias("point"),
                    (F.col("id") / F.lit(max(n_points - 1, 1))).alias("x")))))
    merged = (pts.select("b", "x", "y", F.lit(0).alias("_is_grid"), F.lit(None).cast("long").alias("point"))
              .unionByName(grid.select("b", "x", F.lit(None).cast("double").alias("y"),
                                       F.lit(1).alias("_is_grid"), "point")))
    before = Window.partitionBy("b").orderBy("x", "_is_grid").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy("b").orderBy("x", "_is_grid").rowsBetween(0, Window.unboundedFollowing)
    pt = F.when(F.col("_is_grid") == 0, F.struct("x", "y"))
    interp = (merged.withColumn("_l", F.last(pt, ignorenulls=True).over(before))
              .withColumn("_r", F.first(pt, ignorenulls=True).over(after))
              .where(F.col("_is_grid") == 1))
    lx, ly, rx, ry = F.col("_l.x"), F.col("_l.y"), F.col("_r.x"), F.col("_r.y")
    yv = (F.when(F.col("_r").isNull(), ly).when(F.col("_l").isNull(), ry)
          .when(rx == lx, ly).otherwise(ly + (ry - ly) * (F.col("x") - lx) / (rx - lx)))
    curves = interp.select("b", "point", "x", yv.alias("y"))
    band = curves.groupBy("point", "x").agg(
        F.avg("y").alias("y_mean"),
        F.percentile("y", F.array(F.lit(0.025), F.lit(0.975))).alias("_p"))
    return (band.crossJoin(auuc_stats)
            .select("point", F.col("x").alias("population_pct"), "y_mean",
                    F.col("_p")[0].alias("y_lower_95ci"), F.col("_p")[1].alias("y_upper_95ci"),
                    "auuc_mean", "auuc_std"))


def qini_tie_aware(scored: DataFrame, score: str = "score", treatment: str = "treatment",
                   outcome: str = "conversion", rows_per_bucket: int = 2_000_000) -> DataFrame:
    """Qini curve evaluated only at tie boundaries: one point per distinct score (order independent).

    Rows are first aggregated per distinct score (partial aggregation; a hot
    score collapses to one row), then running sums over the distinct scores in
    descending order use range partitions with prefix offsets, as in
    ``qini_rows``. Columns: score, n_cum, population_pct (n_cum / n), qini, auuc
    (trapezoid over the boundary points starting at (0, 0)).
    """
    t = F.col(treatment).cast("long")
    y = F.col(outcome).cast("double")
    per = (scored.where(F.col(score).isNotNull())
           .groupBy(F.col(score).cast("double").alias(score))
           .agg(F.sum(y * t).alias("yt"), F.sum(t).alias("nt"), F.sum(y * (1 - t)).alias("yc"),
                F.sum(1 - t).alias("nc")))
    n_distinct = per.count()
    n_ranges = max(1, -(-n_distinct // max(rows_per_bucket, 1)))
    ranged = checkpointed(per.repartitionByRange(n_ranges, F.desc(score))
                          .withColumn("_bucket", F.spark_partition_id()))
    parts = ["yt", "nt", "yc", "nc"]
    totals = ranged.groupBy("_bucket").agg(*[F.sum(p).alias(p) for p in parts])
    prior = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_bucket", *[F.coalesce(F.sum(p).over(prior), F.lit(0)).alias(f"{p}_off") for p in parts])
    run = Window.partitionBy("_bucket").orderBy(F.desc(score)).rowsBetween(Window.unboundedPreceding, 0)
    joined = ranged.join(offsets, "_bucket")
    cum = joined.select("_bucket", score, *[(F.sum(p).over(run) + F.col(f"{p}_off")).alias(p) for p in parts])
    n_t, n_c = F.col("nt"), F.col("nc")
    total = ranged.agg((F.sum("nt") + F.sum("nc")).alias("_n"))
    pts = (cum.crossJoin(F.broadcast(total))
           .select("_bucket", score, (n_t + n_c).alias("n_cum"), ((n_t + n_c) / F.col("_n")).alias("population_pct"),
                   ((F.col("yt") / F.greatest(n_t, F.lit(1)) - F.col("yc") / F.greatest(n_c, F.lit(1)))
                    * (n_t + n_c)).alias("qini")))
    # Trapezoid from (0, 0): the previous point is the lag inside the range, or the last point of
    # the previous range (one row per range), so no window spans all distinct scores.
    last = pts.groupBy("_bucket").agg(F.max_by(F.struct("population_pct", "qini"), "n_cum").alias("_last"))
    prev_last = last.select("_bucket", F.lag("_last").over(Window.orderBy("_bucket")).alias("_prev"))
    inner = Window.partitionBy("_bucket").orderBy(F.desc(score))
    seg = (pts.join(prev_last, "_bucket")
           .withColumn("_lp", F.lag(F.struct("population_pct", "qini")).over(inner))
           .withColumn("_p", F.coalesce("_lp", "_prev", F.struct(F.lit(0.0).alias("population_pct"),
                                                                  F.lit(0.0).alias("qini")))))
    area = seg.agg(F.sum((F.col("population_pct") - F.col("_p.population_pct"))
                         * (F.col("qini") + F.col("_p.qini")) / 2).alias("auuc"))
    return pts.crossJoin(area).select(score, "n_cum", "population_pct", "qini", "auuc")
