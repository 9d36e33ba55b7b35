"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are present or not: words, word pairs, and pairs with one
and two words between them, hashed into ``2**bits`` slots. FTRL-proximal keeps
a learning rate for every coordinate and sets weights below the L1 strength to
zero, so the model is a short list that is broadcast (at most ``2**bits``
entries, a fixed bound). Training runs on shards of the labelled rows: each
shard (at most ``SHARD_ROWS`` rows) is one task that goes through its rows in
hash order; after each round the shards' states are averaged in Spark and sent out again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.llm.bytesarr import U64, mix, row_chunks, text_bytes
from upshot.llm.common import cut, prepare
from upshot.llm.words import word_table

#: Bound on the labelled rows a model is fitted on (those with the smallest hashes of the id).
TRAIN_ROWS = 24_000
SHARD_ROWS = 4_000
#: Rounds of training and averaging, and passes over its rows that a shard makes in each round.
BITS, ROUNDS, PASSES = 18, 2, 2
ALPHA, BETA, L2 = 1.0, 1.0, 1.0
#: L1 strength for each row of a shard, and the least strength (a slot seen once must stay at zero).
L1_ROW, L1_LEAST = 0.002, 1.5
CHUNK = 1_000_000


@dataclass(frozen=True)
class ToxicityModel:
    """Sparse weights (slot, weight) and the offset in log-odds."""

    slots: np.ndarray
    weights: np.ndarray
    offset: float
    bits: int


def features(raw: np.ndarray, off: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, slot) pairs, one array pair for each kind of feature; a feature may come more than once."""
    row, name = word_table(raw, off)
    down = U64(64 - bits)
    yield row, (mix(name, U64(1) + np.zeros_like(name)) >> down).astype(np.int64)
    for gap in (1, 2, 3):
        if len(name) > gap:
            same = row[gap:] == row[:-gap]
            a, b = name[:-gap][same], name[gap:][same]
            yield row[gap:][same], (mix(a, b, np.full_like(a, gap + 1)) >> down).astype(np.int64)


def _weights(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
    w = -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= l1, 0.0, w)


def _epoch(z: np.ndarray, n: np.ndarray, rows: Iterator[tuple[np.ndarray, float]], offset: float,
           l1: float) -> None:
    """One pass of FTRL-proximal over (slots, label), changing the state in place."""
    for slots, y in rows:
        zi, ni = z[slots], n[slots]
        w = _weights(zi, ni, l1)
        p = 1.0 / (1.0 + math.exp(-min(max(offset + w.sum(), -35.0), 35.0)))
        g = p - y
        root = np.sqrt(ni + g * g)
        z[slots] = zi + g - (root - np.sqrt(ni)) / ALPHA * w
        n[slots] = ni + g * g


def _slots(texts: pa.Array, bits: int) -> list[np.ndarray]:
    """Distinct slots of each text."""
    raw, off = text_bytes(texts)
    out: list[np.ndarray] = []
    for lo, hi in row_chunks(off, CHUNK):
        pairs = [row << bits | slot for row, slot in features(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], bits)]
        keys = np.unique(np.concatenate(pairs))
        cuts = np.searchsorted(keys, np.arange(hi - lo + 1) << bits)
        out += [(keys[a:b] & ((1 << bits) - 1)).astype(np.int32) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        train_rows: int = TRAIN_ROWS, bits: int = BITS, rounds: int = ROUNDS) -> ToxicityModel:
    """Learn from the labelled rows of ``docs``.

    At most ``train_rows`` labelled ids are used, those with the smallest
    hashes. Null labels are left out; an id with several labels counts with
    the largest. Null texts are empty. Without any label, every score is the
    prior of 0.05.
    """
    spark = docs.sparkSession
    prepare(spark)
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col)).cast("double").alias("__y"))
             .orderBy(F.xxhash64("__id"), "__id").limit(train_rows))
    known = cut(known, "known")      # at most train_rows pairs; the driver sees two numbers of them
    counts = known.agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("pos")).first()
    total, pos = counts["n"], counts["pos"] or 0.0
    offset = math.log((pos + 1.0) / (total - pos + 19.0))
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    shards = max(1, -(-total // SHARD_ROWS))
    l1 = max(L1_LEAST, L1_ROW * total / shards)
    if total:
        body = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
        train = (docs.join(F.broadcast(known), docs[id_col] == known["__id"])
                 .select(F.pmod(F.xxhash64("__id"), F.lit(shards)).alias("shard"),
                         F.xxhash64("__id", body).alias("place"), F.col("__y").alias("y"), body.alias("body")))
        train = cut(train, "train")
        for _ in range(rounds):
            state = spark.sparkContext.broadcast((z, n))

            def shard(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
                own_z, own_n = (x.copy() for x in state.value)
                rows = [x for b in batches for x in zip(_slots(b.column(1), bits), b.column(0).to_pylist(), strict=True)]
                for _ in range(PASSES):
                    _epoch(own_z, own_n, iter(rows), offset, l1)
                if rows:
                    at = np.flatnonzero(own_n)
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own_z[at]), pa.array(own_n[at])],
                                                     ["slot", "z", "n"])

            parts = (train.repartition(shards, "shard").sortWithinPartitions("shard", "place").select("y", "body")
                     .mapInArrow(shard, "slot long, z double, n double"))
            # a mean over the shards that saw the slot, so that rare words keep what one shard has learned
            merged = parts.groupBy("slot").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
            z, n = np.zeros(size), np.zeros(size)
            slot = merged["slot"].to_numpy()
            z[slot], n[slot] = merged["z"].to_numpy(), merged["n"].to_numpy()
            state.unpersist()
    w = _weights(z, n, l1)
    at = np.flatnonzero(w)
    return ToxicityModel(at, w[at], offset, bits)


def score(model: ToxicityModel, text: Column, docs: DataFrame) -> Column:
    """Score column in (0, 1) for whole texts; ``docs`` only names the session. Null texts are empty."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        m = sent.value
        weight = np.zeros(1 << m.bits)
        weight[m.slots] = m.weights
        raw, off = text_bytes(texts)
        out = []
        for lo, hi in row_chunks(off, CHUNK):
            keys = []
            for row, slot in features(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], m.bits):
                hit = weight[slot] != 0
                keys.append(row[hit] << m.bits | slot[hit])
            found = np.unique(np.concatenate(keys))
            out.append(np.bincount(found >> m.bits, weight[found & ((1 << m.bits) - 1)], minlength=hi - lo))
        odds = m.offset + np.concatenate(out) if out else np.empty(0)
        return pa.array(1.0 / (1.0 + np.exp(-np.clip(odds, -35, 35))))

    return toxicity(F.lower(F.coalesce(text.cast("string"), F.lit(""))))


def held_out(id_col: Column) -> Column:
    """True for the fifth of the ids that no model sees: crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0
