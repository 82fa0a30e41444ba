"""Hashed n-grams of many texts as (row, bucket) arrays."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from riskloom.llm.wordarrays import Words, grams, inside, mix


def byte_grams(data: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every n neighbouring bytes of a text."""
    m = max(0, len(data) - n + 1)
    value = np.zeros(m, np.uint64)
    for k in range(n):
        value = value * np.uint64(257) + data[k : k + m]
    row = np.repeat(np.arange(len(at) - 1, dtype=np.int32), np.diff(at))
    keep = row[:m] == row[n - 1 :] if m else np.zeros(0, bool)
    return row[:m][keep], mix(value[keep] + np.uint64(n * 1_000_003))


def word_grams(found: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every n neighbouring words of a text."""
    keep = inside(found.row, n)
    return found.row[: len(keep)][keep].astype(np.int32), mix(grams(found.hash, n)[keep] + np.uint64(n))


def hashed(
    data: np.ndarray, at: np.ndarray, found: Words, bits: int, in_words: Sequence[int], in_bytes: Sequence[int]
) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all word and byte n-grams of the given lengths, in 2**bits buckets."""
    parts = [word_grams(found, n) for n in in_words] + [byte_grams(data, at, n) for n in in_bytes]
    row = np.concatenate([r for r, _ in parts])
    return row, (np.concatenate([h for _, h in parts]) >> np.uint64(64 - bits)).astype(np.int64)
