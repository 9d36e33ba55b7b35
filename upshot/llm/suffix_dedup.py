"""Exact repeated-substring removal by hashed names of anchored suffixes.

A byte string of ``length`` bytes is repeated if it starts at two places of the
corpus. Every such string holds ``length - gram + 1`` grams; the one with the
smallest hash (leftmost on ties) is its anchor. Equal strings have equal
anchors at equal distances, so only suffixes that start at anchors have to be
sorted into buckets, about one in eighty, and only strings of one bucket have
to be told apart:

1. Initial buckets: the anchor's gram. All strings in a row with one anchor
   are a *territory*. A bucket with one territory holds nothing repeated; one
   whose territories have the same bytes is repeated as a whole.
2. Refinement by content hashes, in three fixed levels: a bucket with different
   territories is split by the whole territory, then by blocks of ``BLOCK``
   strings (bytes common to the block), and last by the single strings. Each
   level refines the buckets of the one before, and only those that are still
   undecided; territories known to be equal are refined through one of them.

This stands in for the dealt refinement, in which buckets are sorted on the
bucket identifiers of later offsets again and again. Strings have a fixed
length, so a hash of all their bytes tells them apart at once, where pointers
would need a join with the buckets at a later offset for every doubling.

Each level is an aggregation with map-side partial sums (count, least and
greatest identifier) and a join back in which the rows of hot buckets are dealt
over many tasks, so a passage shared by a third of all documents never meets in
one. Identifiers are 64-bit names within
buckets that are 64-bit names themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upshot.llm.bytesarr import (U64, gram_names, mix, powers, prefix_names, row_chunks, slice_names, sliding_min,
                                 text_bytes)
from upshot.llm.common import cut, prepare

HOT, SALTS = 1000, 64            # a bucket with more than 1 in HOT of the rows is dealt over SALTS tasks
LENGTH, GRAM, BLOCK = 200, 40, 8
CHUNK, SEGMENT = 100_000, 400_000      # bytes of text handled at a time
_POS = U64(20)                         # low bits of a hash that hold a position; SEGMENT fits
# A place is one long: 24 bits of the text's hash, 31 bits of byte position, 8 bits of the number of strings.
_W, _P = 8, 31


def _packed(th: np.ndarray, p: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (th << (_W + _P)) | (p << _W) | w


def _territories(raw: np.ndarray, off: np.ndarray, length: int, gram: int):
    """(row, first string, strings, anchor name, territory name) of every territory of the texts ``off`` bounds."""
    n, width = len(raw), length - gram + 1
    if n < length:
        return None
    prefix = prefix_names(raw)
    grams = gram_names(prefix, gram)
    key = mix(grams)
    key >>= _POS
    key <<= _POS
    key |= np.arange(len(key), dtype=np.uint64)
    at = (sliding_min(key, width) & U64((1 << 20) - 1)).astype(np.int64)
    sizes = np.diff(off)
    row = np.repeat(np.arange(len(sizes)), np.maximum(sizes - length + 1, 0))
    if not len(row):
        return None
    first = np.cumsum(np.r_[0, np.maximum(sizes - length + 1, 0)])[:-1]
    p = np.arange(len(row)) - first[row] + off[row]
    a = at[p]
    edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (row[1:] != row[:-1])])
    lo, hi = p[edge], p[np.r_[edge[1:], len(p)] - 1]
    name = mix(slice_names(prefix, lo, lo + length), slice_names(prefix, hi, hi + length), (hi - lo).astype(np.uint64))
    return row[edge], lo, hi - lo + 1, grams[a[edge]], name


def _emit_territories(length: int, gram: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            raw, off = text_bytes(batch.column(2))
            out: list[tuple[np.ndarray, ...]] = []
            for r0, r1 in row_chunks(off, CHUNK):
                base = off[r0]
                if r1 - r0 > 1 or off[r1] - base <= SEGMENT:
                    parts = [(r0, 0, raw[base:off[r1]], off[r0:r1 + 1] - base)]
                else:   # one long text: pieces that share length - 1 bytes, so every string is in one piece
                    size = off[r1] - base
                    parts = [(r0, s, raw[base + s:base + min(s + SEGMENT + length - 1, size)], None)
                             for s in range(0, size - length + 1, SEGMENT)]
                for row0, shift, piece, o in parts:
                    o = np.array([0, len(piece)]) if o is None else o
                    if (found := _territories(piece, o, length, gram)) is not None:
                        row, lo, w, anchor, name = found
                        out.append((row + row0, _packed(th[row + row0], lo - o[row] + shift, w), anchor, name))
            if out:
                row, place, anchor, name = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row)), pa.array(place), pa.array(anchor.view(np.int64)),
                     pa.array(name.view(np.int64))], schema=schema)
    return run


def _contexts(raw: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """A row of ``width`` bytes from each start (bytes past the end repeat the last)."""
    return raw[np.minimum(start[:, None] + np.arange(width), len(raw) - 1)]


def _places(batch: pa.RecordBatch, column: int, fields: int):
    """Row number, unpacked place and further fields of a list<struct<place, ...>> column."""
    lists = batch.column(column)
    sizes = np.diff(lists.offsets.to_numpy())
    row = np.repeat(np.arange(len(batch)), sizes)
    flat = lists.flatten()
    place = flat.field(0).to_numpy(zero_copy_only=False)
    p, w = (place >> _W) & ((1 << _P) - 1), place & ((1 << _W) - 1)
    return row, p, w, [flat.field(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(1, fields)]


def _emit_blocks(length: int, gram: int, schema: pa.Schema):
    """Undecided territories cut into blocks of strings: bucket = bytes common to the block, name = all its bytes."""
    width = length - gram + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            raw, off = text_bytes(batch.column(2))
            rows, ps, ws, (anchors,) = _places(batch, 3, 2)
            for s in range(0, len(rows), 512):
                row, p, w, anchor = (x[s:s + 512] for x in (rows, ps, ws, anchors))
                prefix = prefix_names(_contexts(raw, off[row] + p, length + width))
                at = np.argmax(gram_names(prefix[:, :width + gram], gram) == anchor[:, None], axis=1)
                # string j starts at p + j, at distance at - j from its anchor; blocks are cut by distance
                top, bottom = at // BLOCK, (at - w + 1) // BLOCK
                count = top - bottom + 1
                i = np.repeat(np.arange(len(row)), count)
                k = top[i] - (np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count))
                j0 = np.maximum(at[i] - (k * BLOCK + BLOCK - 1), 0)
                j1 = np.minimum(at[i] - k * BLOCK, w[i] - 1)
                inverse = powers("down", prefix.shape[1])
                name = lambda a, b: (prefix[i, b] - prefix[i, a]) * inverse[a]
                core0 = at[i] - k * BLOCK                   # start of the last string of a whole block
                core = name(core0, core0 - BLOCK + 1 + length)
                bucket = mix(anchor[i], k.astype(np.uint64), core)
                whole = mix(name(j0, j1 + length), j0.astype(np.uint64) - at[i].astype(np.uint64), j1.astype(np.uint64)
                            - j0.astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[i])), pa.array(_packed(th[row[i]], p[i] + j0, j1 - j0 + 1)),
                     pa.array(bucket.view(np.int64)), pa.array(whole.view(np.int64))], schema=schema)
    return run


def _emit_strings(length: int, schema: pa.Schema):
    """Undecided blocks cut into single strings: bucket of the block, name of the string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, th = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
            raw, off = text_bytes(batch.column(2))
            rows, ps, ws, (buckets,) = _places(batch, 3, 2)
            for s in range(0, len(rows), 512):
                row, p, w, bucket = (x[s:s + 512] for x in (rows, ps, ws, buckets))
                names = gram_names(prefix_names(_contexts(raw, off[row] + p, length + BLOCK - 1)), length)
                i = np.repeat(np.arange(len(row)), w)
                j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[i])), pa.array(_packed(th[row[i]], p[i] + j, np.ones_like(j))),
                     pa.array(bucket[i].view(np.int64)), pa.array(names[i, j].view(np.int64))], schema=schema)
    return run


def _merged(lists, length: int):
    """Maximal removed runs [lo, hi) from the places of one text."""
    place = np.sort(np.asarray(lists, np.int64))
    lo, w = (place >> _W) & ((1 << _P) - 1), place & ((1 << _W) - 1)
    hi = np.maximum.accumulate(lo + w - 1 + length)
    new = np.flatnonzero(np.r_[True, lo[1:] > hi[:-1]])
    return lo[new], hi[np.r_[new[1:], len(lo)] - 1]


def _join_back(rows: DataFrame, summary: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``rows`` joined with a summary of theirs (keys, n, ...), hot buckets dealt over ``SALTS`` tasks.

    A bucket is hot if it holds more than one in ``HOT`` of the rows that
    count, so there are fewer than ``HOT`` of them, whatever the data. Their
    summary rows are repeated for each salt; a row's salt is a hash of its place.
    """
    summary = cut(summary, "buckets")
    total = summary.agg(F.sum("n")).first()[0] or 0
    hot = [r.bucket for r in summary.where(F.col("n") * F.lit(HOT) > F.lit(total)).select("bucket").distinct().collect()]
    summary = summary.drop("n")
    if not hot:
        return rows.join(summary, keys, how)
    is_hot = F.col("bucket").isin(hot)
    salted = rows.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("id", "place"), F.lit(SALTS))).otherwise(F.lit(0)))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))).cast("array<long>")
    return salted.join(summary.withColumn("salt", F.explode(every)), [*keys, "salt"], how).drop("salt")


def repeated_places(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(id, place): runs of repeated strings of each text; ``texts`` has columns id, th, body.

    ``place`` packs the text's hash bits, the first string's byte position and
    the number of consecutive strings that are repeated.
    """
    id_type = texts.schema["id"].dataType

    def fields(*names: str) -> T.StructType:
        return T.StructType([T.StructField("id", id_type), *[T.StructField(n, T.LongType()) for n in names]])

    def arrow(s: T.StructType) -> pa.Schema:
        from pyspark.sql.pandas.types import to_arrow_schema
        return to_arrow_schema(s)

    def buckets(df: DataFrame) -> DataFrame:
        """Buckets of two or more members, and whether their members differ."""
        return (df.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("lo"), F.max("name").alias("hi"))
                .where("n >= 2").select("bucket", "n", (F.col("lo") != F.col("hi")).alias("mixed")))

    def with_texts(places: DataFrame) -> DataFrame:
        """The texts that hold undecided places, with these places; one row for each distinct text."""
        lists = places.groupBy("id", F.shiftrightunsigned("place", _W + _P).alias("th")).agg(
            F.collect_set(F.struct("place", "bucket")).alias("places"))
        b = lists.select(F.col("id").alias("__id"), F.col("th").alias("__th"), "places")
        same = texts.id.eqNullSafe(b["__id"]) & (texts.th == b["__th"])
        return texts.join(b, same).select("id", "th", "body", "places")

    schema = fields("place", "bucket", "name")
    first = texts.mapInArrow(_emit_territories(length, gram, arrow(schema)), schema)
    shared = cut(_join_back(first, buckets(first), ["bucket"], "inner"), "territories")

    equal = shared.where("mixed").groupBy("bucket", "name").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("place", "id")).alias("one"))
    copies = _join_back(shared.where("mixed"), equal.where("n >= 2").select("bucket", "name", "n"), ["bucket", "name"], "left_semi")
    ones = equal.select("one.id", "one.place", "bucket")
    blocks = with_texts(ones).mapInArrow(_emit_blocks(length, gram, arrow(schema)), schema)
    split = cut(_join_back(blocks, buckets(blocks), ["bucket"], "inner"), "blocks")

    strings = with_texts(split.where("mixed")).mapInArrow(_emit_strings(length, arrow(schema)), schema)
    twice = strings.groupBy("bucket", "name").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    last = cut(_join_back(strings, twice, ["bucket", "name"], "left_semi"), "strings")
    return (shared.where("not mixed").select("id", "place").unionByName(copies.select("id", "place"))
            .unionByName(split.where("not mixed").select("id", "place")).unionByName(last.select("id", "place")))


REMOVED = ("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,kept_text:string,"
           "spans:array<struct<lo:bigint,hi:bigint>>>")
_RUN = pa.struct([("lo", pa.int64()), ("hi", pa.int64())])
ARROW_REMOVED = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                           ("kept_sha256", pa.string()), ("kept_text", pa.string()), ("spans", pa.list_(_RUN))])


def _cut_text(text: np.ndarray, places: np.ndarray, length: int, keep_text: bool) -> dict:
    """What is left of one text, as a record of ``REMOVED``."""
    if not len(places):
        kept = text.tobytes()
        return {"n_bytes": len(text), "n_removed": 0, "n_spans": 0, "kept_sha256": hashlib.sha256(kept).hexdigest(),
                "kept_text": kept.decode("utf-8", "replace") if keep_text else None, "spans": []}
    lo, hi = _merged(places, length)
    stays = np.ones(len(text), bool)
    for a, z in zip(lo, hi, strict=True):
        stays[a:z] = False
    left = None
    if keep_text:   # a character's bytes run from its lead byte on; it goes only as a whole
        lead = np.flatnonzero((text & 0xC0) != 0x80)
        whole = np.repeat(np.logical_or.reduceat(stays, lead), np.diff(np.r_[lead, len(text)]))
        left = text[whole].tobytes().decode("utf-8", "replace")
    return {"n_bytes": len(text), "n_removed": int((hi - lo).sum()), "n_spans": len(lo),
            "kept_sha256": hashlib.sha256(text[stays].tobytes()).hexdigest(), "kept_text": left,
            "spans": [{"lo": int(a), "hi": int(z)} for a, z in zip(lo, hi, strict=True)]}


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, keep_text: bool = True, name: str = "__removed") -> DataFrame:
    """``docs`` with one struct column more: what is left when every repeated byte is removed.

    A byte is repeated if a ``length``-byte string over it starts anywhere
    else too, in this text or another. Fields: ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256`` of the remaining bytes,
    ``spans`` (the runs, in bytes) and with ``keep_text`` ``kept_text``, the
    text without the characters that lie wholly in removed runs (a run may
    begin or end inside a character; such a character stays).

    Null texts are empty. Texts shorter than ``length`` keep all. Rows with
    the same id, null among them, are texts of their own; equal rows repeat
    each other, so both lose all strings. Extra columns pass unchanged.
    """
    prepare(docs.sparkSession)
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = F.shiftrightunsigned(F.xxhash64(body), 64 - 24)
    texts = docs.select(F.col(id_col).alias("id"), hashed.alias("th"), body.alias("body"))
    spans = repeated_places(texts, length, gram).groupBy(
        F.col("id").alias("__id"), F.shiftrightunsigned("place", _W + _P).alias("__th")).agg(
        F.collect_set("place").alias("__places"))
    rows = docs.withColumn("__hash", hashed)

    @F.arrow_udf(REMOVED)
    def cut_texts(bodies: pa.Array, places: pa.Array) -> pa.Array:
        raw, off = text_bytes(bodies)
        runs = places.fill_null(pa.scalar([], places.type))
        starts, values = runs.offsets.to_numpy(), runs.values.to_numpy(zero_copy_only=False)
        return pa.array([_cut_text(raw[off[i]:off[i + 1]], values[starts[i]:starts[i + 1]], length, keep_text)
                         for i in range(len(runs))], ARROW_REMOVED)

    same = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__th"))
    return (rows.join(spans, same, "left").withColumn(name, cut_texts(body, F.col("__places")))
            .drop("__hash", "__id", "__th", "__places"))
