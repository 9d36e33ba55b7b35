"""SimHash near-duplicates: fingerprints linked through a vantage-point tree over Hamming space.

Equal fingerprints are merged first, so copies cost nothing. A tree of vantage
points, fitted on a bounded sample of fingerprints, cuts the space into shards:
at each node a fingerprint within the radius of the vantage point goes inside,
any other goes outside, and one that lies at most ``max_distance`` beyond the
radius also goes inside. By the triangle inequality two linked fingerprints
then meet in one shard at least, whatever the sample was; the sample decides
only how even the shards are. Each shard is searched the same way in its task,
down to small blocks that are compared whole. A block gives one edge for each
linked fingerprint, to the smallest one it is linked with, never all pairs.
Edges of all shards are joined into components by large-star and small-star
rounds, whose state is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare

SAMPLE, SHARD, BLOCK, MAX_LEVELS = 60_000, 4_000, 400, 15
_PART = 1 << 15                 # shingles whose bits are counted at a time


def fingerprint_of(text: bytes, width: int = 3) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    words = text.lower().split()     # bytes: A-Z only, and exactly the six ASCII white-space characters
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.r_[0, ends[:-1]]
    n = max(len(words) - width + 1, 1)
    hash_of = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    first, last = starts[:n].tolist(), (ends[-n:] - 1).tolist()
    for s in range(0, n, _PART):
        hashes = np.array([hash_of(joined[a:b], 42) for a, b in zip(first[s:s + _PART], last[s:s + _PART], strict=True)], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, width: int = 3) -> Column:
    """Fingerprint column (long, the bits of the unsigned value). Null texts have none of the words: 0."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        values = texts.cast(pa.large_binary())
        return pa.array((fingerprint_of(v.as_py() or b"", width) for v in values), pa.int64())

    return simhash(F.coalesce(text.cast("string"), F.lit("")))


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def _vantage(points: np.ndarray) -> tuple[np.uint64, int]:
    """The one of a few points with the widest spread of distances, and the median distance."""
    best = max((points[i] for i in range(0, len(points), max(1, len(points) // 5))),
               key=lambda v: float(_distance(points, v).std()))
    return best, int(np.median(_distance(points, best)))


class VantageTree:
    """Routes fingerprints to shards. ``nodes[i]`` = (vantage, radius); children 2i+1 (inside), 2i+2; None: a shard."""

    def __init__(self, sample: np.ndarray, levels: int, reach: int):
        self.reach = reach
        self.nodes: dict[int, tuple[np.uint64, int]] = {}
        todo = [(0, sample, levels)]
        while todo:
            i, points, left = todo.pop()
            if left and len(points) >= 8:
                v, radius = self.nodes[i] = _vantage(points)
                d = _distance(points, v)
                todo += [(2 * i + 1, points[d <= radius + reach], left - 1), (2 * i + 2, points[d > radius], left - 1)]

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(shard, index of the point) for every shard a point belongs to."""
        shards, which = [], []
        todo = [(0, np.arange(len(points)))]
        while todo:
            i, at = todo.pop()
            if not len(at):
                continue
            if i not in self.nodes:
                shards.append(np.full(len(at), i))
                which.append(at)
                continue
            v, radius = self.nodes[i]
            d = _distance(points[at], v)
            todo += [(2 * i + 1, at[d <= radius + self.reach]), (2 * i + 2, at[d > radius])]
        return (np.concatenate(shards), np.concatenate(which)) if shards else (np.empty(0, np.int64),) * 2


def _blocks(points: np.ndarray, reach: int) -> Iterator[np.ndarray]:
    """Subsets of a shard in which every linked pair meets, small unless the points lie too close to part."""
    todo = [points]
    while todo:
        p = todo.pop()
        if len(p) <= BLOCK:
            yield p
            continue
        v, radius = _vantage(p)
        d = _distance(p, v)
        inside, outside = p[d <= radius + reach], p[d > radius]
        if len(inside) > 0.9 * len(p) or len(outside) > 0.9 * len(p):
            yield p
        else:
            todo += [inside, outside]


def _stars(points: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(point, smallest point of its component) for linked points of one block, compared in strips."""
    label = np.arange(len(points))
    order = np.argsort(points.view(np.int64))
    points = points[order]
    strips = range(0, len(points), 2048)
    changed = True
    while changed:      # labels only fall; a strip is one matrix of 2048 x 2048 at most
        changed = False
        for a in strips:
            for b in strips:
                if b < a:
                    continue
                left, right = points[a:a + 2048], points[b:b + 2048]
                i, j = np.nonzero(_distance(left[:, None], right[None, :]) <= reach)
                off = i + a != j + b
                i, j = i[off] + a, j[off] + b
                if len(i):
                    low = np.minimum(label[i], label[j])
                    if (label[i] != low).any() or (label[j] != low).any():
                        changed = True
                        np.minimum.at(label, i, low)
                        np.minimum.at(label, j, low)
    moved = label != np.arange(len(points))
    if moved.any():
        yield points[moved], points[label[moved]]


def links(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Edges (a, b), a > b, that connect exactly the fingerprints within ``max_distance``.

    ``prints`` has distinct fingerprints in column ``fp``.
    """
    spark = prints.sparkSession
    n = prints.count()
    levels = min(MAX_LEVELS, max(0, int(np.ceil(np.log2(max(n, 1) / SHARD)))))
    sample = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).toArrow()["fp"].to_numpy().view(np.uint64)
    tree = spark.sparkContext.broadcast(VantageTree(sample, levels, max_distance))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            points = b.column(0).to_numpy().view(np.uint64)
            shard, at = tree.value.route(points)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array(points[at].view(np.int64))], ["shard", "fp"])

    def search(table: pa.Table) -> pa.Table:
        points = table.column("fp").to_numpy().view(np.uint64)
        found = [s for block in _blocks(points, max_distance) for s in _stars(block, max_distance)]
        a, b = (np.concatenate([f[i] for f in found]) if found else np.empty(0, np.uint64) for i in (0, 1))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (prints.select("fp").mapInArrow(route, "shard long, fp long").groupBy("shard")
            .applyInArrow(search, "a long, b long").distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each component, for every node with an edge that is not its root.

    ``edges`` has columns a > b. Large-star and small-star rounds; each node's
    least neighbour is an aggregate and comes back by a join, so a hub is not
    one task's group.
    """
    edges = cut(edges, "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
                 .unionByName(least.withColumnRenamed("m", "b")).distinct())
        edges = cut(small, "stars")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def row_key(id_col: Column, text: Column) -> Column:
    """A name for a row's id and text; only equal rows share it."""
    return F.md5(F.concat_ws("\x00", F.coalesce(F.concat(F.lit("i"), id_col.cast("string")), F.lit("n")),
                             F.coalesce(text.cast("string"), F.lit(""))).cast("binary"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    max_distance: int = 3) -> DataFrame:
    """(id, key, fp, root, component): the smallest id reachable over links of at most ``max_distance`` bits.

    One row for each row of ``docs``; repeated rows and ids stay. Texts
    without words, null texts among them, have fingerprint 0 and are linked
    like any other. A null id never names a component; a component of null
    ids only has a null name. ``root`` is the component's smallest
    fingerprint, ``key`` names the row. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    own = cut(docs.select(F.col(id_col).alias("id"), row_key(F.col(id_col), F.col(text_col)).alias("key"),
                          fingerprint(F.col(text_col), width).alias("fp")), "prints")
    prints = own.groupBy("fp").agg(F.min("id").alias("least"))
    roots = components(links(prints, max_distance))
    named = cut(prints.join(roots, prints.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    return own.join(named.select("fp", "root").join(least, "root"), "fp").select("id", "key", "fp", "root", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
             max_distance: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (null ids last, then by key)."""
    found = near_duplicates(docs, id_col, text_col, width, max_distance)
    keep = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "key")).alias("one"))
    keep = keep.select(F.col("one.key").alias("__key"))
    rows = docs.withColumn("__key", row_key(F.col(id_col), F.col(text_col)))
    return rows.join(keep, "__key", "left_semi").dropDuplicates(["__key"]).drop("__key")
