"""Vectorised words and hashes over Arrow string columns.

A column of texts is seen as one array of UTF-8 bytes and the offset at which
each text begins. Words are the maximal runs without a byte of 0x20 or
0x09-0x0D, which in UTF-8 equals the pattern `[^\\x20\\x09-\\x0D]+`.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 18
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """The finalising permutation of splitmix64, element by element."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_LOWER_VALUE = _VALUE[_LOWER]
_POW = _powers(_GOLDEN, 3 * _BLOCK)
_INV = _powers(pow(_GOLDEN, -1, 1 << 64), 3 * _BLOCK)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): byte range of every word; first[d] is the index of text d's first word."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    begins[heads] = inside[heads]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    finishes[tails] = inside[tails]
    start, end = np.flatnonzero(begins), np.flatnonzero(finishes) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each word's bytes; `lower` folds A-Z first. Memory stays near one block whatever the text's length."""
    table = _LOWER_VALUE if lower else _VALUE
    out = np.empty(len(start), np.uint64)
    total = np.empty(2 * _BLOCK + 1, np.uint64)
    total[0] = 0
    i, n = 0, len(start)
    while i < n:
        base = start[i]
        j = int(np.searchsorted(start, base + _BLOCK))
        if end[j - 1] - base > 2 * _BLOCK:
            j -= 1
        if j <= i:  # one word longer than two blocks
            word = data[base : end[i]]
            word = _LOWER[word].astype(np.uint8) if lower else word
            out[i] = int.from_bytes(hashlib.blake2b(word.tobytes(), digest_size=8).digest(), "little")
            i += 1
            continue
        part = data[base : end[j - 1]]
        np.cumsum(table[part] * _POW[: len(part)], out=total[1 : len(part) + 1])
        a, b = start[i:j] - base, end[i:j] - base
        out[i:j] = (total[b] - total[a]) * _INV[a]
        i = j
    return mix(out)


def _level(levels: dict[int, np.ndarray], m: int) -> np.ndarray:
    """The hashes of runs of m, from those of its halves; levels[1] are the values. No closure: one that calls itself would keep the arrays until the next collection."""
    if m not in levels:
        a, b = _level(levels, m // 2), _level(levels, m - m // 2)
        n = len(levels[1]) - m + 1
        levels[m] = mix(a[:n] * np.uint64(_GOLDEN) + b[m // 2 : m // 2 + n] + np.uint64(m))
    return levels[m]


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of k consecutive values (len(h) - k + 1 of them), built by doubling."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    return _level({1: mix(h + np.uint64((seed * 0x632BE59BD9B4E019) % 2**64)) if seed else h}, k)


def repeat_index(first: np.ndarray) -> np.ndarray:
    """The text that each word belongs to, from split_words' `first`."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (length[0] of them), then those of start[1], and so on."""
    total = int(length.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start - before, length)


def bucket_bits(entries: int, per_bucket: int) -> int:
    """log2 of the number of buckets that so many entries are dealt to."""
    return max(0, math.ceil(math.log2(max(1, entries) / per_bucket)))


def bucket_runs(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, cuts): which buckets, by their highest bits, sorted hashes fall in, and where the next bucket's begin."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return bucket[np.concatenate(([0], cuts))], cuts


def tidy() -> None:
    """Give unused memory of this worker back: it may idle beside a task that needs the memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(function):
    """A mapInArrow function that gives its worker's unused memory back when a task ends."""

    def run(batches):
        try:
            yield from function(batches)
        finally:
            tidy()

    return run


def tidied_group(function):
    """An applyInArrow function that gives its worker's unused memory back after each large group."""

    def run(table):
        large = table.nbytes > 1 << 22
        try:
            return function(table)
        finally:
            if large:  # giving back takes as long as a small group does
                tidy()

    return run


def slices(table: pa.Table | pa.RecordBatch, column: str, limit: int = 4 << 20):
    """Parts of the rows that hold about `limit` bytes of `column` each; one row is never cut."""
    n = table.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(table.column(column)), 0)
    sizes = (sizes.combine_chunks() if isinstance(sizes, pa.ChunkedArray) else sizes).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), n]):
        yield table.slice(a, b - a)
