"""Token counts with a two-tier lookup of pre-token lengths.

A byte-level BPE tokenizer splits a text into pre-tokens and encodes each by
itself, so a text's count is the sum over its pre-tokens. The first tier is a
compact table of frequent pre-tokens and their counts, at most ``TABLE`` of
them, found in a bounded sample of documents and broadcast. The second tier is
a cache in each worker: a pre-token seen for the first time is encoded by the
library. Pre-tokens are never shuffled; documents stay where they are read.
The sample decides only which lookups are fast, not any count.

Texts that hold a special token's string, or characters outside the ranges on
which the pattern below and the library agree, go to the library whole.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upshot.llm.common import prepare

SAMPLE_DOCS, TABLE, CACHE = 2_000, 32_768, 400_000
#: How byte-level BPE splits text (fixed by the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Anything but ASCII without control characters other than white space, Latin letters with marks, common punctuation.
_OTHER = r"[^\t\n\r\x20-\x7E¡-ȳ‐-‧‰-⁞€]"
_workers: dict[str, object] = {}


class _Counter:
    """A worker's tokenizer and cache."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = regex.compile(PATTERN).findall
        self.cache: dict[str, int] = {}
        with open(path, encoding="utf-8") as f:
            loaded = json.load(f)
        special = [t["content"] for t in loaded.get("added_tokens", ())]
        pre = loaded.get("pre_tokenizer") or {}
        by_word = (loaded.get("model", {}).get("type") == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                   and not pre.get("add_prefix_space") and not loaded.get("normalizer"))
        whole = "|".join([_OTHER, *map(regex.escape, special)]) if by_word else r"[\s\S]"
        self.whole = regex.compile(whole).search

    def library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False))

    def count(self, text: str, table: dict[str, int]) -> int:
        if not text:
            return 0
        if self.whole(text):
            return self.library(text)
        cache, total = self.cache, 0
        for word in self.split(text):
            n = table.get(word) or cache.get(word)
            if n is None:
                if len(cache) >= CACHE:     # forgets; later misses are encoded again
                    cache.clear()
                n = self.library(word)
                if len(word) < 64:
                    cache[word] = n
            total += n
        return total


def _worker(path: str) -> _Counter:
    if path not in _workers:
        _workers[path] = _Counter(path)
    return _workers[path]  # type: ignore[return-value]


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", sample_docs: int = SAMPLE_DOCS,
                     size: int = TABLE) -> dict[str, int]:
    """The first tier: at most ``size`` pre-tokens, the most frequent in ``sample_docs`` documents by hash."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.agg(F.count(F.lit(1))).first()[0]
    share = min(1.0, sample_docs / max(rows, 1))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        tool = _worker(path)
        for b in batches:
            for text in b.column(0).to_pylist():
                if not tool.whole(text):
                    seen.update(w for w in tool.split(text) if len(w) < 64)
        top = seen.most_common(size)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in top], pa.string()),
                                          pa.array([n for _, n in top], pa.int64())], ["word", "n"])

    sample = docs.select(body.alias("body")).where(F.pmod(F.xxhash64("body"), F.lit(1_000_000)) < int(share * 1_000_000))
    top = (sample.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "word").limit(size).toPandas())
    tool = _worker(path)
    return {w: tool.library(w) for w in top.word}


def token_counts(docs: DataFrame, path: str, text: Column) -> Column:
    """Token count column of whole texts as the library gives it, without special tokens at the ends.

    Null and empty texts have none. ``path`` is the tokenizer file, readable
    on every executor.
    """
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs.select(text.alias("text")), path))

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        tool, table = _worker(path), sent.value
        return pa.array((tool.count(t.as_py() or "", table) for t in texts), pa.int64())

    return count(F.coalesce(text.cast("string"), F.lit("")))
