"""Distributed quantiles with linear interpolation: exact, two reads of the data, no global sort.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which does not survive a 100 TB column. Here:

1. the first read builds one KLL sketch per group and column (all columns in
   one aggregate, bounded memory, merged map-side) and takes from it a bracket
   [q(p - d), q(p + d)] around every wanted probability p, with d three times
   the sketch's rank error; brackets that touch are merged;
2. the second read gives every row the number of its cell between bracket
   ends (codegen'd halving steps) and counts rows by (group, column, cell,
   value), where the value is kept inside brackets only: everything outside
   collapses to one row a cell in the map-side aggregate, and so does a hot
   value. Groups of a few thousand rows keep all their values.

All else works on that count table, which is written once: running counts of
cells name the cell of each wanted order statistic, running counts of the
values inside that cell name the value. A rank outside the brackets (the sketch
missed, which is improbable) starts again with wider ones, so the result never
depends on the sketch.

The result equals NumPy/DuckDB ``linear`` quantiles: h = (n-1) p,
q = x[floor h] + (h - floor h) (x[floor h + 1] - x[floor h]). Null values take
no part; null groups are groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.functions.materialize import bounded, checkpointed, small
from upshot.session import ensure_checkpoint_dir

SKETCH_K = 32_768                # KLL parameter (8..65535): larger sketches, narrower brackets


def quantiles(df: DataFrame, value: str, probs, by=(), accuracy: int = SKETCH_K,
              method: str = "exact") -> DataFrame:
    """Rows ``(by..., q_idx, prob, value, n)``; one per group and probability."""
    return _named(df, [value], probs, by, accuracy, method, [])


def quantiles_of(df: DataFrame, columns: list[str], probs, by=(), accuracy: int = SKETCH_K,
                 method: str = "exact") -> DataFrame:
    """Quantiles of several columns at once: rows ``(by..., feature, q_idx, prob, value, n)``."""
    return _named(df, columns, probs, by, accuracy, method, [F.array(*[F.lit(c) for c in columns])[F.col("_f")].alias("feature")])


def _named(df, columns, probs, by, accuracy, method, feature) -> DataFrame:
    if method not in ("exact", "approx"):
        raise ValueError(f"unknown method {method!r}")
    ensure_checkpoint_dir(df.sparkSession)
    by, probs = list(by), [float(p) for p in probs]
    k = min(max(accuracy, 8), 65_535)
    base = df.select(F.struct(F.lit(0).alias("_"), *by).alias("_g"),    # structs join null-safely
                     *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(columns)])
    if method == "approx":
        out = _sketched(base, len(columns), k, probs).select(
            "_g", F.posexplode("_s").alias("_f", "_s")).select("_g", "_f", "_s.n", F.posexplode("_s.e").alias("q_idx", "value"))
    else:
        delta = 3 * 2.296 / k ** 0.9723
        out = None
        while out is None:
            out = _exact(base, len(columns), k, probs, delta)
            delta *= 16
    return out.select(*[F.col("_g")[c].alias(c) for c in by], *feature, "q_idx",
                      F.element_at(_doubles(probs), F.col("q_idx") + 1).alias("prob"), "value", "n")


def _doubles(values: list[float]) -> Column:
    return F.expr(f"array({', '.join(f'{v!r}D' for v in values)})")


def _sketched(base: DataFrame, width: int, k: int, at: list[float]) -> DataFrame:
    """(_g, _s): for each column the count n and the sketch's quantiles e at the given ranks; the first read."""
    values = [F.col(f"_v{i}") for i in range(width)]
    aggs = [a for i, v in enumerate(values) for a in (
        F.count(v).alias(f"_n{i}"), F.kll_sketch_agg_double(v, F.lit(k)).alias(f"_k{i}"))]
    ranks = _doubles(at)
    found = base.groupBy("_g").agg(*aggs)
    return found.select("_g", F.array(*[F.struct(
        F.col(f"_n{i}").alias("n"),
        F.when(F.col(f"_n{i}") > 0, F.kll_sketch_get_quantile_double(f"_k{i}", ranks)).alias("e")) for i in range(width)]).alias("_s"))


def _materialised(df: DataFrame, grouped: bool) -> tuple[DataFrame, bool]:
    """A small table computed once, and whether its size is proven small (always, without groups)."""
    return bounded(df, with_flag=True) if grouped else (small(df), True)


def _exact(base: DataFrame, width: int, k: int, probs: list[float], delta: float) -> DataFrame | None:
    """(_g, _f, q_idx, value, n), or None if a wanted rank lies outside the brackets."""
    ends: list[float] = []
    for p in sorted(probs):
        lo, hi = max(0.0, p - delta), min(1.0, p + delta)
        if ends and lo <= ends[-1]:
            ends[-1] = max(hi, ends[-1])
        else:
            ends += [lo, hi]
    width_e = len(ends)
    grouped = len(base.schema["_g"].dataType.names) > 1
    edges, edges_small = _materialised(_sketched(base, width, k, ends), grouped)

    # Second read: cell 2 * (ends below v) + (v is an end), ordered like v; values kept inside brackets.
    side = F.broadcast(edges) if edges_small else edges     # proven small: never shuffle the big side

    # The columns become rows first: one search for all of them, short enough for the JVM to compile.
    values = F.array(*[F.struct(F.lit(i).alias("f"), F.col(f"_v{i}").alias("v")) for i in range(width)])
    placed = base.join(side, "_g").select("_g", "_s", F.explode(values).alias("_r")).where("_r.v IS NOT NULL").select(
        "_g", F.col("_r.f").alias("_f"), F.col("_r.v").alias("_v"), F.col("_s")[F.col("_r.f")].alias("_s"), F.lit(0).alias("_b"))

    def end(at: Column) -> Column:
        return F.get(F.col("_s")["e"], at)           # null past the last end

    # number of ends below v, by halving steps
    step = 1 << (width_e.bit_length() - 1)
    while step:
        placed = placed.select("_g", "_f", "_v", "_s", (
            F.col("_b") + F.when(end(F.col("_b") + (step - 1)) < F.col("_v"), step).otherwise(0)).alias("_b"))
        step //= 2

    at_end = F.coalesce(end(F.col("_b")) == F.col("_v"), F.lit(False))
    few = F.col("_s")["n"] * F.lit(delta) < 3     # a bracket narrower than a few rows: keep the group's values
    placed = placed.select("_g", "_f", "_v", "_b", few.alias("_few"), at_end.alias("_end"))
    kept = F.lit(True) if delta >= 1 else F.col("_few") | F.col("_end") | (F.col("_b") % 2 == 1)
    cells = placed.select("_g", "_f", (F.col("_b") * 2 + F.col("_end").cast("int")).alias("_c"), kept.alias("_kept"),
                          F.when(kept, F.col("_v")).alias("_v"))
    counted = cells.groupBy("_g", "_f", "_c", "_kept", "_v")
    table = checkpointed(counted.agg(F.count(F.lit(1)).alias("_m")))

    # Cells with the rows before them; wanted ranks find their cell as the last one that starts at or before them.
    group = Window.partitionBy("_g", "_f")
    cells = table.groupBy("_g", "_f", "_c", "_kept").agg(F.sum("_m").alias("_m"))
    cells = cells.select("_g", "_f", "_c", "_kept", F.sum("_m").over(group).alias("n"),
                         (F.sum("_m").over(group.orderBy("_c")) - F.col("_m")).alias("_at"))
    sizes = cells.select("_g", "_f", "n").distinct()
    h = (F.col("n") - 1).cast("double") * F.col("prob")
    ranks = sizes.select("_g", "_f", "n", F.posexplode(_doubles(probs)).alias("q_idx", "prob"))
    ranks = ranks.withColumn("_k", F.floor(h).cast("long")).select(
        "_g", "_f", "n", "q_idx", (h - F.col("_k")).alias("_frac"),
        F.posexplode(F.array(F.col("_k"), F.least(F.col("_k") + 1, F.col("n") - 1))).alias("side", "_at"))
    both = cells.withColumn("_o", F.lit(0)).unionByName(ranks.withColumn("_o", F.lit(1)), allowMissingColumns=True)
    upto = group.orderBy("_at", "_o").rowsBetween(Window.unboundedPreceding, 0)
    start = F.last(F.when(F.col("_o") == 0, F.struct("_c", "_kept", F.col("_at").alias("from"))), ignorenulls=True).over(upto)
    targets = both.withColumn("_t", start).where("_o = 1").select(
        "_g", "_f", "n", "q_idx", "_frac", "side", F.col("_at").alias("rank"), F.col("_t._c").alias("_c"),
        F.col("_t._kept").alias("_kept"), F.col("_t.from").alias("_from"))
    targets, targets_small = _materialised(targets, grouped)
    if not targets.where("NOT _kept").isEmpty():
        return None

    # Values of the wanted cells, by running counts inside each cell.
    run = Window.partitionBy("_g", "_f", "_c").orderBy("_v")
    values = table.where("_kept").withColumn("_cum", F.sum("_m").over(run))
    wanted = F.broadcast(targets) if targets_small else targets
    reach = F.col("rank") - F.col("_from")
    picked = values.join(wanted.drop("_kept"), ["_g", "_f", "_c"]).where(
        (F.col("_cum") - F.col("_m") <= reach) & (reach < F.col("_cum")))
    pair = picked.groupBy("_g", "_f", "q_idx", "_frac", "n").agg(
        F.max(F.when(F.col("side") == 0, F.col("_v"))).alias("_x0"), F.max(F.when(F.col("side") == 1, F.col("_v"))).alias("_x1"))
    return pair.select("_g", "_f", "q_idx", (F.col("_x0") + F.col("_frac") * (F.col("_x1") - F.col("_x0"))).alias("value"), "n")


def quantile_array(df: DataFrame, value: str, probs, by=(), **kw) -> DataFrame:
    """One row per group: ``(by..., edges array<double> ordered by prob, n)``."""
    by = list(by)
    q = quantiles(df, value, probs, by, **kw)
    arrays = (q.groupBy(*by).agg(
        F.array_sort(F.collect_list(F.struct("q_idx", "value"))).alias("_s"), F.first("n").alias("n"))
        .select(*by, F.transform("_s", lambda s: s["value"]).alias("edges"), "n"))
    return arrays if by else small(arrays)


def count_sorted(edges, value, n: int, strict: bool) -> Column:
    """Number of elements of a sorted array (static length ``n``) that are < (strict) or <= the value.

    A binary search written as nested CASE over element positions: about
    log2(n) comparisons per row, all inside whole-stage codegen (an
    interpreted ``filter`` lambda would touch every element). Long arrays use
    two levels - blocks of 32 by their last element, then positions inside the
    block at a data-dependent base - so the expression stays small.
    """
    e = F.col(edges) if isinstance(edges, str) else edges
    v = F.col(value) if isinstance(value, str) else value

    def below(item: Column) -> Column:
        return item < v if strict else item <= v

    def search(at, lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(below(at(mid)), search(at, mid + 1, hi)).otherwise(search(at, lo, mid))

    if n <= 64:
        return search(lambda i: e.getItem(i), 0, n)
    block = 32
    full = n // block
    # level 1: full blocks whose last element is below the value
    blocks_below = search(lambda k: e.getItem(k * block + block - 1), 0, full)
    base = blocks_below * F.lit(block)
    # level 2: inside the next block (positions past the end read null, i.e. "not below")
    inner = search(lambda j: F.get(e, base + F.lit(j)), 0, block)   # get(): null past the end
    return base + inner


def bin_of(value, edges, n: int | None = None) -> Column:
    """Right-closed bin index: number of edges strictly below the value."""
    v = F.col(value) if isinstance(value, str) else value
    e = F.col(edges) if isinstance(edges, str) else edges
    if n is None:
        return F.size(F.filter(e, lambda x: x < v))
    return count_sorted(e, v, n, strict=True)
