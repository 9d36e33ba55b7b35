"""Approximate nearest neighbours by multiprobe p-stable hashing, reranked exactly.

Inner products become distances when every vector gets one more component that
lifts it to the largest norm, and queries are scaled to that norm. Each of
``TABLES`` hash tables rounds a few Gaussian projections to cells of width
``WIDTH``. A query visits cells in the order of estimated success: the chance
that a neighbour at the expected distance falls there, a product over the
projections; it goes on until the visited cells hold ``SUCCESS`` of that
chance. All vectors are indexed; the sample fits only the largest norm's and
the neighbour distance's estimate, so it changes recall but no score.

Equal vectors are merged first and keep the smallest ids that can be in an
answer, so copies never fill a cell. Cells are spread over shards by hash and,
if any cell is large, each over several shards. A shard's task ranks the
candidates of each query by exact double-precision inner products; only the
best of each shard meet.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upshot.llm.common import cut, prepare

TABLES, WIDTH, SUCCESS = 2, 3.0, 0.8
SAMPLE, SHARD_ROWS, COPY_SALTS = 2_000, 20_000, 32


def _projections(dim: int, functions: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(8)
    return rng.standard_normal((TABLES, functions, dim + 1)), rng.uniform(0, WIDTH, (TABLES, functions))


def _cells(codes: np.ndarray) -> np.ndarray:
    """One 64-bit name for each row of integer cell coordinates."""
    out = np.full(codes.shape[:-1], 0x243F6A8885A308D3, np.uint64)
    for i in range(codes.shape[-1]):
        out = (out ^ codes[..., i].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _probes(offset: np.ndarray, distance: float, success: float) -> list[tuple[int, ...]]:
    """Cell offsets in order of estimated success, until their chances add up to ``success``.

    ``offset``: place of the query in its cell for each projection, in [0, WIDTH).
    """
    def below(x: float) -> float:
        return 0.5 * (1 + math.erf(x / (distance * math.sqrt(2))))

    choices = []
    for x in offset:
        chance = [(below((d + 1) * WIDTH - x) - below(d * WIDTH - x), d) for d in range(-4, 5)]
        choices.append(sorted(chance, reverse=True))
    first = (0,) * len(choices)
    p0 = math.prod(c[0][0] for c in choices)
    heap, seen, out, total = [(-p0, first)], {first}, [], 0.0
    while heap and total < success:
        p, at = heapq.heappop(heap)
        out.append(tuple(choices[i][k][1] for i, k in enumerate(at)))
        total -= p
        for i, k in enumerate(at):
            if k + 1 < len(choices[i]):
                after = (*at[:i], k + 1, *at[i + 1:])
                if after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (p / choices[i][k][0] * choices[i][k + 1][0], after) if choices[i][k][0] else (0.0, after))
    return out


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): vectors without null or non-finite components, not zero, of the most frequent length."""
    v = F.col("v")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    found = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull()).where(ok)
    common = found.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return found.where(F.size("v") == (common[0]["d"] if common else 0))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            success: float = SUCCESS) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` largest inner products found for each query, ties to the smaller id.

    ``is_query`` is a condition on column ``id``. Every other row is a
    candidate, the query's own id is not. Vectors that are null or zero, or
    hold null or non-finite components, take no part, nor do those of another
    length than the most frequent one; null ids neither. Repeated (id, vector)
    rows count once. A query that found fewer than ``k`` is searched against
    all rows, so it gets ``k`` or all there are.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = usable(vectors, id_col, vec_col).distinct()
    some = Window.partitionBy("v", "salt").orderBy("id")
    units = (rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(COPY_SALTS)))
             .withColumn("n", F.row_number().over(some)).where(F.col("n") <= k + 1)
             .groupBy("v").agg(F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids")))
    units = cut(units.select(F.element_at("ids", 1).alias("u"), "ids", "v"), "units")
    queries = cut(rows.where(is_query).select(F.col("id").alias("q"), "v"), "queries")
    n, norm = units.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()
    empty = "query_id long, rank int, id long, score double"
    if not n:
        return spark.createDataFrame([], empty)
    norm = math.sqrt(norm)
    sample = units.orderBy(F.xxhash64("u"), "u").limit(SAMPLE).toPandas()
    x = np.array(sample.v.tolist(), np.float64)
    dim, size = x.shape[1], len(x)
    dots = (x[:200] / np.linalg.norm(x[:200], axis=1, keepdims=True)) @ x.T * norm
    place = min(size - 1, max(1, round(k * size / n)))          # a query's k-th neighbour stands about there in the sample
    near = np.median(np.sort(dots, axis=1)[:, ::-1][:, place]) if size > 1 else 0.0
    distance = math.sqrt(max(2 * norm * norm - 2 * near, 1e-6)) / norm
    functions = max(1, round(0.8 * math.log2(max(n / 64, 2))))
    shards = max(8, 2 * -(-n * TABLES // SHARD_ROWS))

    def codes(points: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = _projections(dim, functions)
        y = np.einsum("nd,tfd->ntf", np.concatenate([points, last[:, None]], axis=1) / norm, a) + b
        cell = np.floor(y / WIDTH)
        return cell.astype(np.int64), y - cell * WIDTH

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _matrix(b.column(1), dim)
            last = np.sqrt(np.maximum(norm * norm - (p * p).sum(axis=1), 0.0))
            names = _cells(codes(p, last)[0])
            for t in range(TABLES):
                yield pa.RecordBatch.from_arrays([pa.array(names[:, t] + t), b.column(0), b.column(1)], ["cell", "u", "v"])

    element = units.schema["v"].dataType.elementType.simpleString()
    cells = units.select("u", "v").mapInArrow(index, f"cell long, u long, v array<{element}>")
    largest = cells.groupBy("cell").count().agg(F.max("count")).first()[0]
    parts = -(-largest // SHARD_ROWS)                            # of each cell, over different shards

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column(1), dim)
            cell, offset = codes(q / np.linalg.norm(q, axis=1, keepdims=True) * norm, np.zeros(len(q)))
            of, name = [], []
            for i in range(len(q)):
                for t in range(TABLES):
                    steps = np.array(_probes(offset[i, t], distance, success))
                    name.append(_cells(cell[i, t] + steps) + t)
                    of.append(np.full(len(steps), i))
            at = pa.array(np.concatenate(of))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(name)), b.column(0).take(at)], ["cell", "q"])

    shard = F.pmod(F.xxhash64("cell", "part"), F.lit(shards))
    base = cells.withColumn("part", F.pmod(F.xxhash64("u"), F.lit(parts)).cast("int")).select(shard.alias("shard"), "cell", "u", "v")
    wanted = (queries.mapInArrow(probe, "cell long, q long").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
              .groupBy(shard.alias("shard"), "q").agg(F.collect_set("cell").alias("cells")).join(queries, "q")
              .select("shard", "q", "cells", "v"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"q": pa.array([], pa.int64()), "u": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        left = left.combine_chunks().sort_by([("cell", "ascending"), ("u", "ascending")]).combine_chunks()
        cell, u = left["cell"].to_numpy(), left["u"].to_numpy()
        points = _matrix(left["v"].combine_chunks(), dim)
        right = right.combine_chunks()
        lists = right["cells"].combine_chunks()
        q_of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        asked = lists.flatten().to_numpy()
        order = np.argsort(asked, kind="stable")
        q_of, asked = q_of[order], asked[order]
        qs, qid = _matrix(right["v"].combine_chunks(), dim), right["q"].to_numpy()
        best_q, best_u, best_s = [], [], []
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        for a, z in zip(starts, np.r_[starts[1:], len(cell)], strict=True):
            lo, hi = np.searchsorted(asked, cell[a], "left"), np.searchsorted(asked, cell[a], "right")
            for s in range(lo, hi, 512):
                who = q_of[s:min(s + 512, hi)]
                scores = qs[who] @ points[a:z].T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
                best_q.append(np.repeat(who, top.shape[1]))
                best_u.append(u[a:z][top].ravel())
                best_s.append(np.take_along_axis(scores, top, axis=1).ravel())
        if not best_q:
            return pa.table({"q": pa.array([], pa.int64()), "u": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        who, unit, score = (np.concatenate(b) for b in (best_q, best_u, best_s))
        order = np.lexsort((unit, -score, who))
        who, unit, score = who[order], unit[order], score[order]
        first = np.r_[True, (who[1:] != who[:-1]) | (unit[1:] != unit[:-1])]        # the same unit from another table
        who, unit, score = who[first], unit[first], score[first]
        begin = np.searchsorted(who, who, "left")
        keep = np.arange(len(who)) - begin <= k
        return pa.table({"q": qid[who[keep]], "u": unit[keep], "score": score[keep]})

    found = base.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(search, "q long, u long, score double")

    def ranked(hits: DataFrame) -> DataFrame:
        """(q, u, score) with repeats to the final k rows of each query."""
        once = hits.groupBy("q", "u").agg(F.max("score").alias("score"))
        order = Window.partitionBy("q").orderBy(F.desc("score"), "u")
        units_of = once.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        rows_of = units_of.join(units.select("u", "ids"), "u").select("q", "score", F.explode("ids").alias("id")).where("id <> q")
        last = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        return rows_of.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select(
            F.col("q").alias("query_id"), "rank", "id", "score")

    first = cut(ranked(found), "neighbours")
    enough = first.groupBy("query_id").count().where(F.col("count") >= k).select(F.col("query_id").alias("q"))
    short = cut(queries.join(enough, "q", "left_anti"), "short")
    missing = short.count()
    if not missing:
        return first
    blocks = -(-missing // 2_000)
    out = first.join(enough, first.query_id == enough.q, "left_semi")
    for i in range(blocks):     # a bounded block of queries against all rows
        block = short.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i).toPandas()
        if not len(block):
            continue
        sent = spark.sparkContext.broadcast((block.q.to_numpy(np.int64), np.array(block.v.tolist(), np.float64)))

        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, qs = sent.value
            for b in batches:
                u = b.column(0).to_numpy()
                order = np.argsort(u, kind="stable")
                scores = qs @ _matrix(b.column(1), dim)[order].T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids, top.shape[1])), pa.array(u[order][top].ravel()),
                     pa.array(np.take_along_axis(scores, top, axis=1).ravel())], ["q", "u", "score"])

        out = out.unionByName(ranked(units.select("u", "v").mapInArrow(scan, "q long, u long, score double")))
    return out
