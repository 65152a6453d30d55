"""Flat numpy views of Arrow text batches: word boundaries, segment hashes, exact groups.

All functions work on the UTF-8 bytes of many texts laid end to end, so no
Python object exists per word. Words are maximal runs of bytes outside
\\x20 and \\x09-\\x0D; every byte of a multi-byte character is above \\x7F, so
byte-wise splitting equals code-point-wise splitting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: The low n bytes of a little-endian word.
_LOW = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of runs of whole texts of about `limit`
    bytes; a longer text is a chunk of its own. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_null(column.type) else pa.array([b""] * len(column), pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        yield a, raw[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, word offset per text) of all words; none spans two texts."""
    ink = ~SPACE[raw]
    edge = np.empty(len(raw) + 1, bool)
    edge[0] = edge[-1] = True
    np.not_equal(ink[1:], ink[:-1], out=edge[1:-1])
    edge[off] = True
    cut = np.flatnonzero(edge)
    inside = ink[cut[:-1]] if len(raw) else np.zeros(0, bool)
    start, end = cut[:-1][inside], cut[1:][inside]
    return start, end, np.searchsorted(start, off)


def _blocks(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(8-byte blocks of every byte segment, zero-filled; block offset per segment)."""
    count = (end - start + 7) >> 3
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(count, out=off[1:])
    at = np.repeat(start - 8 * off[:-1], count) + 8 * np.arange(off[-1])
    left = np.minimum(np.repeat(end, count) - at, 8)
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    every = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))
    return every[at] & _LOW[left], off


def _block_hashes(block: np.ndarray, off: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Sums of mixed (block, position) pairs: no arithmetic relation between
    positions survives the mixing, whatever the symbols."""
    turn = np.arange(len(block)) - np.repeat(off[:-1], np.diff(off))
    total = np.zeros(len(block) + 1, np.uint64)
    np.cumsum(mix(mix(block + _BASE) ^ mix(turn.astype(np.uint64) + np.uint64(seed << 40 | 1))), out=total[1:])
    return mix(total[off[1:]] - total[off[:-1]] + size.astype(np.uint64))


def segment_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every byte segment [start, end); `lower` folds A-Z to a-z."""
    block, off = _blocks(_LOWER[raw] if lower else raw, start, end)
    return _block_hashes(block, off, end - start, 0)


def equal_segments(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first segment of each group, group of each segment) of equal byte segments:
    grouped by hash, then every segment is compared with its group's first one, so
    unequal segments are never taken for equal."""
    block, off = _blocks(raw, start, end)
    size = end - start
    seed = 0
    while True:
        _, first, group = np.unique(_block_hashes(block, off, size, seed), return_index=True, return_inverse=True)
        of = first[group]
        if np.array_equal(size, size[of]):
            twin = np.repeat(off[of] - off[:-1], np.diff(off)) + np.arange(len(block))
            if np.array_equal(block, block[twin]):
                return first, group
        seed += 1


def equal_rows(*columns: np.ndarray) -> np.ndarray:
    """The group of each row of integer columns; rows of a group are equal in all of them."""
    seed = 0
    while True:
        h = np.full(len(columns[0]), seed + 1, np.uint64)
        for c in columns:
            h = mix(h * _BASE + c.astype(np.uint64))
        _, first, group = np.unique(h, return_index=True, return_inverse=True)
        if all(np.array_equal(c, c[first[group]]) for c in columns):
            return group
        seed += 1


def windows(word_hash: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, window offset per text) of all runs of k words inside one text."""
    n = len(word_hash)
    per = np.maximum(np.diff(off) - (k - 1), 0)
    out = np.zeros(len(off), np.int64)
    np.cumsum(per, out=out[1:])
    if n < k:
        return np.zeros(0, np.uint64), out
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _BASE + word_hash[i : n - k + 1 + i]
    h = mix(h)
    first = np.repeat(off[:-1] - out[:-1], per) + np.arange(out[-1])
    return h[first], out


def spread(off: np.ndarray) -> np.ndarray:
    """The text number of each item, from item offsets."""
    return np.repeat(np.arange(len(off) - 1), np.diff(off))
