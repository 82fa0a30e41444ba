"""Words and n-grams of many texts as numpy arrays, straight from Arrow's UTF-8 buffers.

A word is a run of bytes other than ASCII white space (U+0009 to U+000D and U+0020), which in UTF-8 is the same as
a run of code points other than those. Every word gets a 64-bit polynomial hash with wrap-around, taken from a running
sum over the bytes, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or of the inverse; kept and extended as needed."""
    name, base = ("inverse", _INVERSE) if inverse else ("base", _BASE)
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 20), base, np.uint64)
        out[0] = 1
        _powers[name] = have = np.multiply.accumulate(out)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that their low and high bits can be used alike."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def slices(batches, column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with about `most` bytes of text; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after the other, and the n + 1 places where texts begin; null is empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[at[0] : at[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


class Words(NamedTuple):
    """Of each word, in order: first byte, byte after the last, row of its text, hash. `first`: n + 1 places of words."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences, shifted back, are the hashes of byte ranges."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * powers(len(data)), out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start):
        return np.zeros(0, np.uint64)
    back = powers(len(sums), inverse=True)
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, at: np.ndarray, lower: bool = False, outside: np.ndarray = _SPACE) -> Words:
    """The words of texts laid one after the other; `lower` folds A-Z before hashing; `outside`: bytes between words."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~outside[data]
    begins, ends = inside[1:-1] > inside[:-2], inside[1:-1] > inside[2:]
    edge = at[(at > 0) & (at < len(data))]  # a word ends with its text
    begins[edge] |= inside[1:-1][edge] > 0
    ends[edge - 1] |= inside[1:-1][edge - 1] > 0
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    return Words(start, end, row, range_hash(prefix_hash(_LOWER[data] if lower else data), start, end), first)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n neighbours, over row ends too (see `inside`); shorter input has none."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * np.uint64(_BASE) + hashes[k : k + m]
    return mix(out)


def inside(row: np.ndarray, n: int) -> np.ndarray:
    """Which of the `grams` lie in one row."""
    m = len(row) - n + 1
    return row[:m] == row[n - 1 :] if m > 0 else np.zeros(0, bool)


def shingles(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every n-word shingle, in order; a text of one to n - 1 words is one shingle."""
    keep = inside(found.row, n)
    row, value = found.row[: len(keep)][keep], grams(found.hash, n)[keep]
    count = np.diff(found.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        whole = [grams(found.hash[found.first[r] : found.first[r + 1]], count[r])[0] for r in short]
        row = np.concatenate([row, short])
        value = np.concatenate([value, mix(np.array(whole, np.uint64) + count[short].astype(np.uint64))])
        order = np.argsort(row, kind="stable")
        row, value = row[order], value[order]
    return row, value


def distinct_shingles(text: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text, words folded to lower case in A-Z."""
    data, at = utf8(text)
    row, value = shingles(words(data, at, lower=True), n)
    ends = np.searchsorted(row, np.arange(len(at)))
    return [np.unique(value[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
