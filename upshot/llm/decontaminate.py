"""Benchmark decontamination by bisection in the sorted windows of the benchmark.

The dealt method, a suffix array of the training text in which every test
suffix is searched, is turned round: the windows that start at a benchmark word
are sorted (as 64-bit word names). In every batch of training texts the word
positions whose first words start a test window are sorted by the words that
follow, and each is bisected in the test windows; the other positions cannot
match. Neighbouring finds on one diagonal of one item grow into longest
verbatim matches with their places in both texts, over all places of a window.

The benchmark is read in blocks of bounded size; each block's suffixes are
broadcast in turn. Training texts are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.llm.bytesarr import row_chunks, text_bytes
from upshot.llm.common import prepare
from upshot.llm.words import ngram_names, word_table

WINDOW = 13
#: Bytes of benchmark text in one broadcast block (about; a longer item is a block of its own).
BLOCK_BYTES = 32_000_000
SHARD_BYTES = 4_000_000
MATCH = ("struct<n_words:bigint,runs:array<struct<lo:bigint,hi:bigint>>,items:array<bigint>,"
         "longest:struct<words:bigint,doc_word:bigint,item:bigint,item_word:bigint>>")
ARROW_MATCH = pa.struct([
    ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
    ("items", pa.list_(pa.int64())),
    ("longest", pa.struct([("words", pa.int64()), ("doc_word", pa.int64()), ("item", pa.int64()),
                           ("item_word", pa.int64())]))])


@dataclass(frozen=True)
class TestSuffixes:
    """Distinct windows of one length: sorted keys, and the (item, word) places of each."""

    length: int
    names: np.ndarray        # windows x length word names
    first: np.ndarray        # sorted names of the leading words
    starts: np.ndarray       # places of window i: starts[i]:starts[i + 1]
    items: np.ndarray
    words: np.ndarray


def test_suffixes(items: list[int], texts: list[str | None], window: int = WINDOW) -> list[TestSuffixes]:
    """The windows of a block of items, by window length; an item of fewer words is one window."""
    raw, off = text_bytes(pa.array(texts, pa.large_string()))
    row, name = word_table(raw, off)
    count = np.bincount(row, minlength=len(texts))
    begin = np.cumsum(count) - count
    out = []
    for length in sorted({int(min(c, window)) for c in count if c}):
        whole = [i for i, c in enumerate(count) if c and min(c, window) == length]
        at = np.concatenate([begin[i] + np.arange(count[i] - length + 1) for i in whole])
        names = name[at[:, None] + np.arange(length)]
        order = np.lexsort(names.T[::-1])
        names, at = names[order], at[order]
        new = np.flatnonzero(np.r_[True, (names[1:] != names[:-1]).any(axis=1)])
        owner = row[at]
        lead = min(3, length)
        out.append(TestSuffixes(length, names[new], np.unique(ngram_names(names[:, :lead].ravel(), lead)[::lead]),
                                np.r_[new, len(at)], np.asarray(items, np.int64)[owner], at - begin[owner]))
    return out


def _search(row: np.ndarray, name: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """(position, window) of every occurrence of a test window: binary search in the shard's suffix array."""
    n, lead = tests.length, min(3, tests.length)
    empty = np.empty(0, np.int64)
    if len(name) < n:
        return empty, empty
    starts = ngram_names(name, lead)[:len(name) - n + 1]
    i = np.minimum(np.searchsorted(tests.first, starts), len(tests.first) - 1)
    at = np.flatnonzero(tests.first[i] == starts)
    at = at[row[at] == row[at + n - 1]]
    if not len(at):
        return empty, empty
    suffixes = name[at[:, None] + np.arange(n)]
    order = np.lexsort(suffixes.T[::-1])
    suffixes, at = suffixes[order], at[order]
    # suffix array and test suffixes are both sorted: rank the distinct suffixes, then search them
    new = np.r_[True, (suffixes[1:] != suffixes[:-1]).any(axis=1)]
    distinct, group = suffixes[new], np.cumsum(new) - 1
    lo, hi = np.zeros(len(distinct), np.int64), np.full(len(distinct), len(tests.names))
    for k in range(n):      # narrow each suffix's range of test windows word by word
        column = tests.names[:, k]
        lo, hi = _narrow(column, distinct[:, k], lo, hi)
    found = hi > lo
    hit = found[group]
    return at[hit], lo[group[hit]]


def _narrow(column: np.ndarray, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Within each range [lo, hi) of a column that is sorted there, the subrange that equals the value."""
    bounds = []
    for right in (False, True):
        a, z = lo.copy(), hi.copy()
        while (open_ := a < z).any():
            mid = (a + z) // 2
            seen = column[np.minimum(mid, len(column) - 1)]
            below = open_ & ((seen <= value) if right else (seen < value))
            a = np.where(below, mid + 1, a)
            z = np.where(open_ & ~below, mid, z)
        bounds.append(a)
    return bounds[0], bounds[1]


def _places(block: np.ndarray, window: np.ndarray, blocks: list[TestSuffixes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(find, item, word) of every place of the windows found."""
    out = []
    for b, t in enumerate(blocks):
        find = np.flatnonzero(block == b)
        first = t.starts[window[find]]
        n = t.starts[window[find] + 1] - first
        at = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        out.append((np.repeat(find, n), t.items[at], t.words[at]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _shard(raw: np.ndarray, off: np.ndarray, blocks: list[TestSuffixes]) -> Iterator[dict]:
    """A match record for each text of a shard."""
    row, name = word_table(raw, off)
    size = len(off) - 1
    count = np.bincount(row, minlength=size)
    begin = np.cumsum(count) - count
    position, length, block, window = [], [], [], []
    pairs = []
    for k, t in enumerate(blocks):
        at, win = _search(row, name, t)
        position.append(at)
        length.append(np.full(len(at), t.length))
        block.append(np.full(len(at), k))
        window.append(win)
        for r, w in np.unique(np.stack([row[at], win]), axis=1).T if len(at) else ():
            pairs.append((int(r), np.unique(t.items[t.starts[w]:t.starts[w + 1]])))
    position, length, block, window = (np.concatenate(x) if x else np.empty(0, np.int64)
                                       for x in (position, length, block, window))
    of_row: dict[int, set[int]] = {}
    for r, found in pairs:
        of_row.setdefault(r, set()).update(found.tolist())
    by_row: dict[int, np.ndarray] = {}
    order = np.lexsort((position, row[position]))
    edges = np.searchsorted(row[position][order], np.arange(size + 1))
    for r in of_row:
        by_row[r] = order[edges[r]:edges[r + 1]]
    for r in range(size):
        record = {"n_words": int(count[r]), "runs": [], "items": sorted(of_row.get(r, ())), "longest": None}
        if r in by_row:
            k = by_row[r]
            lo, hi = position[k] - begin[r], position[k] - begin[r] + length[k]
            top = np.maximum.accumulate(hi)
            new = np.flatnonzero(np.r_[True, lo[1:] > top[:-1]])
            record["runs"] = [{"lo": int(a), "hi": int(z)} for a, z in
                              zip(lo[new], top[np.r_[new[1:], len(lo)] - 1], strict=True)]
            # finds that follow each other on one diagonal of one item are one verbatim match; a window has many places
            find, item, word = _places(block[k], window[k], blocks)
            lo, hi = lo[find], hi[find]
            diagonal = np.lexsort((lo, lo - word, item))
            d_item, d_shift, d_lo, d_hi = (x[diagonal] for x in (item, lo - word, lo, hi))
            starts = np.flatnonzero(np.r_[True, (d_item[1:] != d_item[:-1]) | (d_shift[1:] != d_shift[:-1])
                                          | (d_lo[1:] > d_hi[:-1])])
            last = np.r_[starts[1:], len(diagonal)] - 1
            best = int(np.argmax(d_hi[last] - d_lo[starts]))
            s = starts[best]
            record["longest"] = {"words": int(d_hi[last[best]] - d_lo[s]), "doc_word": int(d_lo[s]),
                                 "item": int(d_item[s]), "item_word": int(d_lo[s] - d_shift[s])}
        yield record


def benchmark_blocks(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text",
                     block_bytes: int = BLOCK_BYTES) -> Iterator[list[TestSuffixes]]:
    """The benchmark's test suffixes, one bounded block after the other."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), text.alias("body")).where("id is not null")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "body"), F.lit(blocks)) == b).toArrow()
        yield test_suffixes(part["id"].to_pylist(), part["body"].to_pylist(), window)


def matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES, name: str = "__match") -> DataFrame:
    """``docs`` with one column more, a struct: ``n_words``, ``runs`` (maximal ranges of word positions inside
    occurrences of test windows), ``items`` (items with occurring windows), ``longest`` (the longest verbatim
    match: words, place in the text, item and place in the item; the item named is one of those that hold it).

    Null texts have no words; items without words or with a null id have no windows. With one block of
    benchmark text rows are only extended in place; further blocks add one column each, in place too.
    """
    spark = docs.sparkSession
    prepare(spark)

    def column(block: list[TestSuffixes]) -> Column:
        sent = spark.sparkContext.broadcast(block)

        @F.arrow_udf(MATCH)
        def find(texts: pa.Array) -> pa.Array:
            raw, off = text_bytes(texts)
            records = [r for lo, hi in row_chunks(off, SHARD_BYTES)
                       for r in _shard(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo], sent.value)]
            return pa.array(records, ARROW_MATCH)

        return find(F.coalesce(F.col(text_col).cast("string"), F.lit("")))

    out = docs
    for i, block in enumerate(benchmark_blocks(benchmark, window, block_bytes=block_bytes)):
        if not i:
            out = out.withColumn(name, column(block))
            continue
        more = f"{name}_{i}"
        out = out.withColumn(more, column(block)).withColumn(name, _joined(F.col(name), F.col(more))).drop(more)
    return out


def _joined(a: Column, b: Column) -> Column:
    """Matches of two blocks as one."""
    runs = F.aggregate(
        F.array_sort(F.concat(a.runs, b.runs)), F.expr("cast(array() as array<struct<lo:bigint,hi:bigint>>)"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1).hi >= x.lo),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
                                  F.element_at(acc, -1).lo.alias("lo"),
                                  F.greatest(F.element_at(acc, -1).hi, x.hi).alias("hi")))))
        .otherwise(F.concat(acc, F.array(x))))
    return F.struct(a.n_words.alias("n_words"), runs.alias("runs"),
                    F.array_sort(F.array_union(a["items"], b["items"])).alias("items"),
                    F.greatest(a.longest, b.longest).alias("longest"))


def hit_words(match: Column) -> Column:
    return F.aggregate(match.runs, F.lit(0).cast("long"), lambda acc, x: acc + x.hi - x.lo)


def contaminated(match: Column) -> Column:
    """A text is contaminated if at least a twentieth of its words, and at least one, lies in test windows."""
    return (hit_words(match) > 0) & (20 * hit_words(match) >= match.n_words)
