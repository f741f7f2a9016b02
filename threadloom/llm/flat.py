"""Words, lines and 64-bit hashes of a batch of texts as flat numpy arrays, and slicing of Arrow batches by bytes.

A word is a run of bytes outside space and 0x09-0x0D; those are ASCII, so words of UTF-8 bytes are words of the text.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
HASH_BITS = 52
_BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 5


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.full(_BLOCK + 1, _BASE, np.uint64)
    down = np.full(_BLOCK + 1, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _letters(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    if lower:
        values[65:91] = values[97:123]
    return values


LETTERS = {False: _letters(False), True: _letters(True)}


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every span of ``raw``; spans are in order. ``lower`` folds A-Z."""
    out = np.empty(len(starts), np.uint64)
    up, down = powers()
    i = 0
    while i < len(starts):
        first = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, first + _BLOCK, "right")))
        part = raw[first:int(ends[j - 1])]
        if len(part) > _BLOCK:
            data = part.tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(data.lower() if lower else data, digest_size=8).digest(), "little")
        else:
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(LETTERS[lower][part] * up[:len(part)], out=sums[1:])
            begin, end = starts[i:j] - first, ends[i:j] - first
            out[i:j] = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
        i = j
    return out


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offsets of its rows; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the row of each."""
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~SPACE[raw]
    begin = inside[1:] & ~inside[:-1]
    end = inside[:-1] & ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(raw))]
    joined = cuts[inside[cuts] & inside[cuts + 1]]
    begin[joined] = True
    end[joined] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def windows(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one row, and the place of each run's first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:n] == rows[size - 1:])
    out = hashes[at].copy()
    for k in range(1, size):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[at + k]
    return mix(out), at


def keyed_by_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One value per (row, hash) that sorts by row: 12 bits of row (a slice has at most 4,096) and 52 of the hash."""
    return (rows.astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes >> np.uint64(64 - HASH_BITS))


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with at most ``limit`` bytes in ``column`` and ``SLICE_ROWS`` rows, or one row."""
    at = raw_bytes(batch.column(batch.schema.get_field_index(column)))[1]
    i = 0
    while i < batch.num_rows:
        j = min(max(i + 1, int(np.searchsorted(at, at[i] + limit, "right")) - 1), i + SLICE_ROWS, batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


def release() -> None:
    """Give freed memory of this Python worker back to the system; workers are reused by later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over a task's batches, with ``release`` at its end."""

    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return whole
