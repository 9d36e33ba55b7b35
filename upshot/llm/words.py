"""Vectorised word tables over batches of UTF-8 texts."""

from __future__ import annotations

import numpy as np

from upshot.llm.bytesarr import prefix_names, slice_names

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
#: Bytes of words after lower-casing A-Z: digits, a-z and everything outside ASCII.
_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[0x80:] = True
PIECE = 1 << 17


def word_table(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, name) of every word of the texts bounded by ``off``, in order.

    Works on pieces of about ``PIECE`` bytes that end between words, so memory
    beyond the result does not grow with the texts (a longer word is one piece).
    """
    n = len(raw)
    inside = _WORD[_LOWER[raw]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    bounds = off[(off > 0) & (off < n)]
    begins[bounds] = inside[bounds]
    ends[bounds - 1] = inside[bounds - 1]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    names, i = [], 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(stop, start[i] + PIECE, side="right")))
        base = start[i]
        prefix = prefix_names(_LOWER[raw[base:stop[j - 1]]])
        names.append(slice_names(prefix, start[i:j] - base, stop[i:j] - base))
        i = j
    return np.searchsorted(off, start, side="right") - 1, np.concatenate(names)


def ngram_names(names: np.ndarray, width: int) -> np.ndarray:
    """Names of all runs of ``width`` words (runs over text ends included; the caller drops them)."""
    if len(names) < width:
        return np.empty(0, np.uint64)
    from upshot.llm.bytesarr import mix
    return mix(*(names[i:len(names) - width + 1 + i] for i in range(width)))
