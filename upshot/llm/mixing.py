"""Mixing sources to target weights over a training run, with DataFrame functions only.

Each source has a target number of words and a weight schedule over training
time t in [0, 1]: its share rises or falls linearly, ``target * (1 + slope *
(2t - 1))``. The integral up to t is the source's cumulative demand, ``target *
(t + slope * (t * t - t))``. Documents of a source stand in hash order; the
words before a document, divided by the target, are the demand at which it is
due, and the inverse of the integral gives its training position. Documents
are range-sorted by position; a source that needs more words than it has
starts again from its first document.

Running sums inside a source are split by hash buckets, so a source with a
third of all rows is not one task's group: sums of (source, bucket) are added
up first, and only rows of one bucket are ordered together. A bucket is a range
of the hash, and the number of ranges grows with the number of rows; it deals
the work and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare

WEIGHTS = (3, 1, 2)
SLOPES = (-0.5, 0.5, 0.0)
TOTAL_SHARE, MOST_PASSES = 1.5, 2.0
ROWS_PER_BUCKET = 20_000


def n_words(text: Column) -> Column:
    """Runs of characters other than the six ASCII white-space characters; a null text has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _cycled(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (place % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, total_share: float = TOTAL_SHARE,
                   most_passes: float = MOST_PASSES) -> DataFrame:
    """Targets of the sources; ``sizes`` has one row for each source: source, source_size.

    Sources by code point, null last, take the weights in turn. Targets share
    ``total_share`` of all sizes by weight; one above ``most_passes`` times its
    source's size stops there and its excess goes to the others by weight. The
    level at which that ends follows from the sources sorted by size per
    weight: all up to some place are full, the rest share what is left. The
    windows here run over one row for each source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    s = sizes.select("source", "source_size", _cycled(weights, place).alias("weight"), _cycled(slopes, place).alias("slope"))
    s = s.withColumn("cap", F.col("source_size") * F.lit(most_passes))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(total_share)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    s = s.withColumn("full", F.col("cap") / F.col("weight") <= F.col("level"))
    # the first source that is not full has the common level; those after it compute a lower one
    shared = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)
    return s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(shared * F.col("weight"))).select(
        "source", "source_size", "slope", "target")


def _position(demand: Column, slope: Column) -> Column:
    """Training time at which a share ``demand`` of a source's target is due: the inverse of t + slope * (t*t - t)."""
    b = 1 - slope
    root = (F.sqrt(b * b + 4 * slope * demand) - b) / (2 * slope)
    return F.when(slope == 0, demand).otherwise(F.abs(root))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        rows_per_bucket: int = ROWS_PER_BUCKET, **targets) -> DataFrame:
    """One row for each row of ``docs``: doc_id, size, source_size, target, taken, position, positions.

    ``taken`` is the number of words the mix takes from the document, repeats
    counted: a whole number of passes; the last pass takes a document if its
    middle lies before the target. ``positions`` holds the training position of
    each pass and ``position`` the first (null if the document is left out).
    Rows come range-sorted by position, left-out ones last.

    Null sources are one source. Null and empty texts have size 0 and are
    never taken. A source is read in the order of a hash of the id (of the
    text, where the id is null). Rows equal in id and size are interchangeable. Extra columns
    are ignored. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    name = F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit(""))
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                           n_words(F.col(text_col)).alias("size"), F.md5(name.cast("binary")).alias("h")),
               "mixture-sizes")                 # the texts are read once
    # buckets are the leading bits of the hash: their number decides how the work is dealt, never the order
    bits = min(28, max(4, (rows.count() // rows_per_bucket).bit_length()))
    rows = rows.withColumn("bucket", F.shiftright(F.conv(F.substring("h", 1, 7), 16, 10).cast("long"), 28 - bits))

    key = F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s"))
    rows = rows.withColumn("key", key)
    parts = rows.groupBy("key", "bucket").agg(F.sum("size").alias("part"))
    of_source = parts.groupBy("key").agg(F.sum("part").alias("source_size"))
    goal = source_targets(of_source.select(F.when(~F.col("key.n"), F.col("key.s")).alias("source"), "source_size"), **targets)
    goal = goal.select(F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s")).alias("key"),
                       "source_size", "slope", "target")
    ahead = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("ahead", F.coalesce(F.sum("part").over(ahead), F.lit(0))).join(goal, "key").drop("part")

    inside = Window.partitionBy("key", "bucket").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["key", "bucket"])
    start = F.col("ahead") + F.col("upto") - F.col("size")
    # pass k takes the document if its middle, k sizes further on, lies before the target
    middle = start + F.col("size") / 2
    passes = F.when(F.col("size") > 0, F.greatest(F.ceil((F.col("target") - middle) / F.col("source_size")), F.lit(0)))
    passes = F.coalesce(passes, F.lit(0)).cast("int")
    rows = rows.withColumn("start", start).withColumn("passes", passes)
    due = F.transform(F.expr("filter(sequence(0, passes), k -> k < passes)"),
                      lambda k: _position((F.col("start") + k * F.col("source_size")) / F.col("target"), F.col("slope")))
    rows = rows.withColumn("positions", due)
    return rows.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"),
        F.try_element_at("positions", F.lit(1)).alias("position"), "positions",
    ).orderBy(F.col("position").asc_nulls_last(), "doc_id")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """(position, doc_id, size, copy): one row for each time a document is read, in training order."""
    return (mix(docs, **options).select("doc_id", "size", F.posexplode("positions").alias("copy", "position"))
            .orderBy("position", "doc_id"))
