"""Exact copies by composable polynomial fingerprints, confirmed by comparing the texts chunk by chunk.

The fingerprint of bytes b0 b1 ... is the sum of (b_i + 1) * B^i modulo a prime,
for two primes. It composes: a text's value is the sum of its pieces' values,
each times B to the piece's offset. Inside a task a batch is hashed in pieces;
texts longer than ``SPREAD`` bytes are cut into chunks that are dealt over all
tasks, hashed there, and summed by document.

Equal fingerprints do not yet mean equal texts. Rows whose fingerprint occurs
once are done. A bounded bitmap of the repeated ones (a bit set by chance only
costs a comparison) picks the others; these are dealt by ranges of (fingerprint,
length, row), so that a hot group spreads over many tasks, and each task
streams through its rows in order and compares every text, chunk by chunk, with
the first text of its fingerprint. The first texts of the groups at the two
ends of each range are compared once more across ranges in the same way.

Defined cases: a null text is an empty text, and empty texts are copies of each
other; a null id is smaller than any other; of repeated rows with the same id
and text one stays; an empty table gives an empty result. The text is compared
as given: pass another column to normalise. Input columns ride in one struct,
so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upshot.llm.bytesarr import row_chunks, text_bytes
from upshot.llm.common import cut, prepare

#: Modulus and base of the two halves of a fingerprint.
FIELDS = ((2147483647, 911382323), (2147483629, 972663749))
PIECE = 1 << 15                 # bytes hashed against one table of powers (sums stay below 2^55)
SPREAD = 1 << 20                # longer texts are hashed chunk by chunk in many tasks
CHUNK = 1 << 16                 # bytes compared at a time
FILTER_BITS = 1 << 26           # bits of the bitmap of repeated fingerprints: 8 MB, whatever the data
_AT_ONCE = 1 << 20              # bytes of a batch worked on at a time
_tables: dict[tuple[int, int], np.ndarray] = {}


def _powers(prime: int, base: int) -> np.ndarray:
    """base^0 .. base^(PIECE-1) modulo the prime, by doubling."""
    if (prime, base) not in _tables:
        table = np.ones(1, np.int64)
        while len(table) < PIECE:
            table = np.concatenate([table, table * pow(base, len(table), prime) % prime])
        _tables[prime, base] = table
    return _tables[prime, base]


def polynomial(raw: np.ndarray, off: np.ndarray, prime: int, base: int) -> np.ndarray:
    """Value of each text in a batch (bytes and offsets): pieces are hashed alone, shifted and summed."""
    out = np.zeros(len(off) - 1, np.int64)
    table = _powers(prime, base)
    for lo, hi in row_chunks(off, _AT_ONCE):
        size = np.diff(off[lo:hi + 1])
        pieces = -(-size // PIECE)
        row = np.repeat(np.arange(lo, hi), pieces)
        if not len(row):
            continue
        which = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = off[row] + which * PIECE
        value = np.empty(len(row), np.int64)
        stop = np.minimum(start + PIECE, off[row + 1])
        for a, b in row_chunks(np.r_[start, stop[-1]], _AT_ONCE):
            first, last = start[a], stop[b - 1]
            place = np.arange(first, last) - np.repeat(start[a:b], (stop - start)[a:b])
            value[a:b] = np.add.reduceat((raw[first:last].astype(np.int64) + 1) * table[place], start[a:b] - first) % prime
        shifts = np.array([pow(base, k * PIECE, prime) for k in range(int(which.max()) + 1)], np.int64)
        texts = np.flatnonzero(which == 0)
        out[row[texts]] = np.add.reduceat(value * shifts[which] % prime, texts) % prime
    return out


def _both(halves: list[np.ndarray]) -> np.ndarray:
    return (halves[0] << 31) | halves[1]


def fingerprint(data: Column) -> Column:
    """62-bit fingerprint of a binary column (long)."""
    fields = FIELDS

    @F.arrow_udf("long")
    def poly(texts: pa.Array) -> pa.Array:
        raw, off = text_bytes(texts)
        return pa.array(_both([polynomial(raw, off, *f) for f in fields]), pa.int64())

    return poly(data)


def _shifted(data: Column, offset: Column) -> Column:
    """Both values of a chunk, times the base to the chunk's offset in its text."""
    fields = FIELDS

    @F.arrow_udf("struct<h0:long,h1:long>")
    def poly(chunks: pa.Array, offsets: pa.Array) -> pa.Array:
        raw, off = text_bytes(chunks)
        at = offsets.to_pylist()
        halves = [polynomial(raw, off, p, b) * np.array([pow(b, k, p) for k in at], np.int64) % p for p, b in fields]
        return pa.StructArray.from_arrays([pa.array(h, pa.int64()) for h in halves], ["h0", "h1"])

    return poly(data, offset)


def keyed(rows: DataFrame) -> DataFrame:
    """(row, id, body, n) with fp; long texts are hashed in chunks dealt over all tasks."""
    short = rows.where(F.col("n") <= SPREAD).withColumn("fp", fingerprint(F.col("body")))
    long = rows.where(F.col("n") > SPREAD)
    if long.isEmpty():
        return short
    long = cut(long.withColumn("no", F.monotonically_increasing_id()), "exact-long")
    offsets = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(SPREAD).cast("long"))
    chunks = long.select("no", "body", F.explode(offsets).alias("at")).select(
        "no", "at", F.expr(f"substring(body, cast(at + 1 as int), {SPREAD})").alias("chunk"))
    sums = chunks.repartition("no", "at").select("no", _shifted(F.col("chunk"), F.col("at")).alias("h"))
    sums = sums.groupBy("no").agg(*[(F.sum(f"h.h{k}") % FIELDS[k][0]).alias(f"h{k}") for k in (0, 1)])
    fp = F.shiftleft("h0", 31).bitwiseOR(F.col("h1")).alias("fp")
    return short.unionByName(long.join(sums.select("no", fp), "no").drop("no"))


def _slot() -> Column:
    return F.xxhash64("fp", "n").bitwiseAND(F.lit(FILTER_BITS - 1))


def _repeated(prints: DataFrame):
    """Boolean column function: may this (fp, n) occur more than once?"""
    twice = prints.groupBy("fp", "n").count().where("count > 1").select(_slot().alias("slot"))
    maps = twice.groupBy(F.shiftright("slot", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("slot").bitwiseAND(F.lit(32767))).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in maps.collect():         # at most FILTER_BITS / 32768 rows of 4 KB
        bits[r.part << 12:(r.part + 1) << 12] = np.frombuffer(r.bits, np.uint8)[:FILTER_BITS // 8]
    shared = prints.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def seen(slots: pa.Array) -> pa.Array:
        s = slots.to_numpy(zero_copy_only=False)
        return pa.array((shared.value[s >> 3] >> (s & 7) & 1).astype(bool))

    return seen(_slot())


def _same(a: bytes, b: np.ndarray) -> bool:
    """Chunkwise comparison of two texts of one length."""
    return all(a[k:k + CHUNK] == b[k:k + CHUNK].tobytes() for k in range(0, len(a), CHUNK))


class _Stream:
    """Rows in (fp, n) order come in; each gets the number of the first equal text of its key."""

    def __init__(self) -> None:
        self.key, self.firsts, self.keys = None, [], 0

    def number(self, key, text: np.ndarray, number: int) -> int:
        if key != self.key:
            self.key, self.firsts, self.keys = key, [], self.keys + 1
        for known, first in self.firsts:
            if _same(first, text):
                return known
        self.firsts.append((number, text.tobytes()))
        return number


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    raw, off = text_bytes(batch.column(name))
    for i, key in enumerate(zip(batch.column("fp").to_pylist(), batch.column("n").to_pylist(), strict=True)):
        yield key, raw[off[i]:off[i + 1]]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a range and their local group; ends with the first texts of both end groups."""
    names = ["row", "id", "uid", "gid", "fp", "n", "first"]
    stream, uid, kinds = _Stream(), TaskContext.get().partitionId() << 33, None
    ends: list = []

    def close():
        ends.extend((*stream.key, number, text) for number, text in stream.firsts)

    for b in batches:
        kinds = [b.schema.field(c).type for c in ("row", "id")]
        gid, start = [], uid
        for key, text in _texts(b, "body"):
            if stream.keys == 1 and key != stream.key:
                close()
            gid.append(stream.number(key, text, uid))
            uid += 1
        k = len(gid)
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), b.column("id"), pa.array(range(start, uid), pa.int64()), pa.array(gid, pa.int64()),
             pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], names)
    if stream.keys:
        close()
        for fp, n, gid, text in ends:
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, t) for t in kinds], pa.nulls(1, pa.int64()), pa.array([gid], pa.int64()),
                 pa.array([fp], pa.int64()), pa.array([n], pa.int64()), pa.array([text], pa.binary())], names)


def _join_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stream = _Stream()
    for b in batches:
        gids = b.column("gid").to_pylist()
        found = [stream.number(key, text, gid) for gid, (key, text) in zip(gids, _texts(b, "first"), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("gid"), pa.array(found, pa.int64())], ["gid", "cid"])


def _confirmed(rows: DataFrame) -> DataFrame:
    """(row, id, keep_id, group_size, kept) of the rows (row, id, body, n, fp) that may have copies."""
    fields = rows.schema
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    order = ["fp", "n", "tie"]
    out = T.StructType([fields["row"], fields["id"], *[T.StructField(c, T.LongType()) for c in ("uid", "gid", "fp", "n")],
                        T.StructField("first", T.BinaryType())])
    scanned = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .select("row", "id", "body", "fp", "n").mapInArrow(_scan, out), "exact-scanned")
    ends = scanned.where("first IS NOT NULL").select("fp", "n", "gid", "first")
    same = ends.repartition("fp", "n").sortWithinPartitions("fp", "n", "gid").mapInArrow(_join_ends, "gid long, cid long")
    members = scanned.where("first IS NULL").select("row", "id", "uid", "gid")
    local = members.groupBy("gid").agg(F.count("*").alias("size"), F.max(F.struct("id", "uid")).alias("best"))
    # a gid of the first and of the last group of a range is listed twice if the range has one group only
    local = cut(local.join(same.distinct(), "gid", "left").withColumn("cid", F.coalesce("cid", "gid")), "exact-local")
    whole = local.groupBy("cid").agg(F.sum("size").alias("group_size"), F.max("best").alias("best"))
    return members.join(local.select("gid", "cid").join(whole, "cid"), "gid").select(
        "row", "id", F.col("best.id").alias("keep_id"), "group_size", (F.col("best.uid") == F.col("uid")).alias("kept"))


def _grouped(docs: DataFrame, text: Column, id_col: str, keep: Iterable[str]) -> DataFrame:
    """(row, id, keep_id, group_size, kept) of every row; ``row`` holds the columns to keep."""
    prepare(docs.sparkSession)
    body = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.struct(F.lit(0).alias("__"), *keep).alias("row"), F.col(id_col).alias("id"), body.alias("body"))
    rows = keyed(rows.withColumn("n", F.octet_length("body").cast("long")))
    prints = cut(rows.drop("body"), "exact-prints")
    repeated = _repeated(prints)
    alone = prints.where(~repeated).select(
        "row", "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    return alone.unionByName(_confirmed(cut(rows.where(repeated), "exact-candidates")))


def exact_groups(docs: DataFrame, text: Column, id_col: str, keep: Iterable[str]) -> DataFrame:
    """Columns ``keep`` of every row and ``__exact``: struct(keep_id, group_size, kept).

    Rows are in one group if ``text`` (as string, null: empty) has the same
    bytes. The row with the largest id stays; ``keep_id`` is its id. The ids
    must be of a type that can be ordered.
    """
    found = _grouped(docs, text, id_col, keep)
    return found.select(*[F.col("row")[c].alias(c) for c in keep],
                        F.struct("keep_id", "group_size", "kept").alias("__exact"))


def drop_copies(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each text, the one with the largest id."""
    found = _grouped(docs, F.col(text_col), id_col, docs.columns).where("kept")
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])
