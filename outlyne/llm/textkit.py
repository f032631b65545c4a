"""Whole-batch text work on Arrow buffers: words, word hashes and shingle hashes without a loop over words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_M = np.uint64(0x9E3779B97F4A7C15 | 1)
_MI = np.uint64(pow(int(_M), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def rest() -> None:
    """Gives freed memory back to the system at the end of a task: worker processes live on and serve other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x + np.uint64((0x632BE59BD9B4E019 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n + 1:
        n = max(n + 1, CHUNK + (1 << 17))
        for name, m in (("up", _M), ("down", _MI)):
            a = np.full(n, m, np.uint64)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    off = np.frombuffer(off, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of rows of about CHUNK bytes; a row is never cut."""
    data, off = utf8(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + CHUNK, "right")) - 1)
        yield a, b, data[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the lower-cased words of all rows, and each row's offsets among them."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    ink = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(ink & (edge[:-1] | ~np.concatenate(([False], ink[:-1]))))
    ends = np.flatnonzero(ink & (edge[1:] | ~np.concatenate((ink[1:], [False])))) + 1
    up, down = _power(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return h, np.searchsorted(starts, off)


def shingles(words: np.ndarray, width: int = 5) -> np.ndarray:
    """Hashes of all windows of so many words; fewer words make one window of all; none makes none."""
    n = len(words)
    if n <= width:
        return mix(_fold([words[i : i + 1] for i in range(n)]), 7) if n else words
    return mix(_fold([words[i : n - width + 1 + i] for i in range(width)]), 7)


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        h = h * _M + p
    return h
