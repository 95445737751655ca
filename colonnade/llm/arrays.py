"""Numpy helpers for batches of documents given as lists of 64-bit word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

GOLDEN = np.uint64(0x9E3779B97F4A7C15)  # fixed values of a 64-bit finaliser
FIRST = np.uint64(0xBF58476D1CE4E5B9)
SECOND = np.uint64(0x94D049BB133111EB)


def seeded(i: int) -> np.uint64:
    """The i-th multiple of ``GOLDEN``."""
    return np.uint64(i * int(GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of ``x`` over the whole word; ``x`` is overwritten."""
    x ^= x >> np.uint64(30)
    x *= FIRST
    x ^= x >> np.uint64(27)
    x *= SECOND
    x ^= x >> np.uint64(31)
    return x


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, end to end, and where each row's values begin (one more entry for the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("null list")
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values.view(np.uint64) if values.dtype == np.int64 else values, offsets - offsets[0]


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each value the row it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def window_starts(offsets: np.ndarray, width: int) -> np.ndarray:
    """Where windows of ``width`` values start that lie within one row."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return np.flatnonzero(np.arange(len(ends)) + width <= ends)


def window_hashes(values: np.ndarray, starts: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the sequence in each window: a weighted sum of mixed word hashes, mixed again."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = mix(values + seeded(seed + 1))
    weights = mix(np.arange(1, width + 1, dtype=np.uint64) * GOLDEN) | np.uint64(1)
    n = len(values) - width + 1
    if width <= 16:
        total = np.zeros(n, np.uint64)
        for i in range(width):
            total += words[i : i + n] * weights[i]
    else:
        # Powers of one odd base: a window's sum is a difference of two prefix sums, scaled back to its start.
        base = weights[0]
        power = np.cumprod(np.full(len(words), base))
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power)])
        inverse = np.cumprod(np.full(n, np.uint64(pow(int(base), -1, 1 << 64))))
        total = (prefix[width : width + n] - prefix[:n]) * inverse
    return mix(total[starts])
