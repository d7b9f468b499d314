"""Vectorised work on the UTF-8 bytes of Arrow string columns.

All functions take one contiguous byte buffer that holds many documents, and
the documents' offsets in it.  Batches are cut into slices of about a megabyte
(`slices`), so memory does not grow with the size of an Arrow batch; a single
document is never cut.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULT = np.uint64(0x9E3779B97F4A7C15)        # odd, so it has an inverse mod 2^64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls are empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, docs: int = 8192) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of documents with about ``most`` bytes (one document at least)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n, i + docs)
        yield i, j
        i = j


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 65536)
        base = _MULT if kind == "up" else _INV
        out = np.full(size, base, np.uint64)
        out[0] = 1
        out = np.multiply.accumulate(out)
        if size > 16 * SLICE_BYTES:     # tables for a huge document are not kept
            return out
        _powers[kind] = have = out
    return have


def give_back() -> None:
    """Freed memory goes back to the system: Python workers are reused, and allocators keep it else."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def in_turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what the work on one has freed goes back to the system before the next."""
    for b in batches:
        yield b
        del b
        give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A finalising bijection of 64-bit integers (SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RangeHash:
    """64-bit hashes of any byte ranges of a buffer, by prefix sums of a polynomial."""

    def __init__(self, data: np.ndarray, values: np.ndarray = _BYTE_VALUE):
        n = len(data)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * _power("up", n)[:n], out=self.prefix[1:])
        self.down = _power("down", n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.prefix[end] - self.prefix[start]
        out *= self.down[start]
        return mix(out ^ (np.asarray(end - start).astype(np.uint64) << np.uint64(40)))

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` bytes at each position (not finalised)."""
        out = self.prefix[width:] - self.prefix[:-width]
        out *= self.down[:len(out)]
        return out


SECOND_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of each run of bytes other than space, tab to carriage return."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~IS_SPACE[data]
    cut = np.zeros(n + 1, bool)          # a document starts here
    cut[offsets] = True
    start = solid.copy()
    start[1:] &= ~solid[:-1] | cut[1:n]
    end = solid.copy()
    end[:-1] &= ~solid[1:] | cut[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def per_doc(flag: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of each document's bytes have the flag."""
    total = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
