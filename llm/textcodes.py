"""Vectorised byte, word and shingle codes for Arrow batches of texts.

Everything here works on one batch of whole texts at a time, laid end to end in
one byte array.  Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z only, so
UTF-8 sequences pass through untouched.  Codes are unsigned 64-bit polynomial
hashes, mixed; equal words always have equal codes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
_POWERS = {"b": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}

#: Bytes of text that are worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20


def _powers(which: str, n: int) -> np.ndarray:
    have = _POWERS[which]
    if len(have) < n:
        step = np.full(max(n, CHUNK_BYTES + 1), BASE if which == "b" else _INVERSE, np.uint64)
        step[0] = 1
        have = _POWERS[which] = np.cumprod(step)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer, so that all bits of a code depend on all of its input."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)


def byte_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``most`` bytes; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def lower(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def prefix(data: np.ndarray) -> np.ndarray:
    """prefix[j] - prefix[i] is the code of data[i:j], times BASE**i."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers("b", len(data)), out=out[1:])
    return out


def spans_code(pre: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Codes of the byte spans [start, end)."""
    return mix((pre[end] - pre[start]) * _powers("i", len(pre))[start])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, words before each row) of the words of each row."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = ~solid[:-1]
    first[offsets] = True
    last = np.ones(len(data), bool)
    last[:-1] = ~solid[1:]
    cuts = offsets[(offsets > 0)] - 1
    last[cuts] = True
    start = np.flatnonzero(solid & first[:-1])
    end = np.flatnonzero(solid & last) + 1
    return start, end, np.searchsorted(start, offsets)


def word_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all words of lower-cased texts, words before each row)."""
    low = lower(data)
    start, end, at = words(low, offsets)
    return spans_code(prefix(low), start, end), at


def shingles(codes: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each row: (codes sorted within a row, shingles before each row).

    A row of 1 to k-1 words has its whole sequence as one shingle, a row without words none.
    """
    n = np.diff(at)
    count = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    row = np.repeat(np.arange(len(n)), count)
    begin = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + at[:-1][row]
    size = np.minimum(n, k)[row]
    code = size.astype(np.uint64)
    for j in range(k):
        inside = size > j
        nxt = codes[np.where(inside, begin + j, 0)] if len(codes) else np.zeros(0, np.uint64)
        code = np.where(inside, mix(code * BASE + nxt), code)
    order = np.lexsort((code, row))
    code, row = code[order], row[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (row[1:] != row[:-1])
    code, row = code[new], row[new]
    return code, np.searchsorted(row, np.arange(len(n) + 1))
