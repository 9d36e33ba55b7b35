"""Numpy helpers on UTF-8 text batches, used inside Spark tasks.

A batch of texts is handled as one byte array plus offsets. Callers take it in
chunks of bounded size, so that a task's working arrays stay small however
many or however long the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_STEP = 0x9E3779B97F4A7C15          # odd, so it has an inverse modulo 2^64
_BYTE = np.random.default_rng(20240607).integers(0, 2**64, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, max_bytes: int) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``max_bytes`` bytes each, or of one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def powers(kind: str, n: int) -> np.ndarray:
    """Powers of the step ('up') or of its inverse ('down'), at least n of them."""
    if len(_powers.get(kind, ())) < n:
        base = np.full(max(n, 1 << 12), _STEP if kind == "up" else pow(_STEP, -1, 2**64), np.uint64)
        base[0] = 1
        _powers[kind] = np.multiply.accumulate(base)
    return _powers[kind][:n]


def prefix_names(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which the 64-bit name of any slice follows (last axis; bytes or 64-bit symbols)."""
    symbols = _BYTE[values] if values.dtype == np.uint8 else values
    out = np.zeros((*values.shape[:-1], values.shape[-1] + 1), np.uint64)
    np.cumsum(symbols * powers("up", values.shape[-1]), axis=-1, out=out[..., 1:])
    return out


def slice_names(prefix: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Names of the slices [start, stop) of a one-dimensional ``prefix_names``."""
    return (prefix[stop] - prefix[start]) * powers("down", len(prefix))[start]


def gram_names(prefix: np.ndarray, width: int) -> np.ndarray:
    """Names of all slices of one width, along the last axis."""
    n = prefix.shape[-1] - width
    return (prefix[..., width:] - prefix[..., :n]) * powers("down", n)


def mix(*parts: np.ndarray) -> np.ndarray:
    """One 64-bit name for a tuple of 64-bit names."""
    out = parts[0]
    for p in parts[1:]:
        out = (out ^ (out >> U64(31))) * U64(0xC2B2AE3D27D4EB4F) + p
    out = (out ^ (out >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    return out ^ (out >> U64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    out, k = values, 1
    while 2 * k <= width:
        out = np.minimum(out[:-k], out[k:])
        k *= 2
    rest = width - k
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out
