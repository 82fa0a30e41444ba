"""Product codes of vectors in whole numbers, with nearest entries looked up by memoised grid cells.

A component x becomes floor(256 x). Vectors are cut into equal parts; the codebook of a part position starts as that part of
the vectors with the smallest ids, and each round assigns all parts and moves every entry to the mean of its parts, rounded
down. Everything is integer arithmetic, so the result does not depend on how rows are spread.

Nearest entry of a part: the part's coarse cell (its components shifted right) is hashed. The first time a task meets a cell,
it compares the cell's box with all entries: an entry whose smallest distance to the box exceeds the largest distance of
another is dominated there and can be nearest to no point of the box. The others are kept with the cell, and only they are
evaluated for each part that falls into it. Two cells of one hash are told apart by their coordinates; the later one
is evaluated against all entries. A task keeps at most `keep` cells for a part position and starts anew beyond, which costs
time only.

A round sums parts by entry inside the tasks; a task passes on one row for each entry in use, and the driver collects
`parts * entries` rows, whatever the table's size.

Defined cases: a row whose vector is null, or holds a null or a component that is not finite, is left out; so is one whose
length differs from that of the smallest id (of lengths that parts divide), which cannot be cut alike. Of equal ids the vector smaller in order comes first, and null ids
come last. With fewer vectors than `entries` the codebooks have that many. Repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored. A component of 65,536 or more in size raises an error, since
sums might not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.packing import ragged
from riskloom.llm.tables import set_down
from riskloom.llm.wordarrays import mix
from riskloom.operators.joins import left_join, own_shuffle

SCALE = 256  # fixed value
LARGEST = 1 << 24


def whole(column: pa.Array, dim: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, integer vectors) of the sound vectors of each length, or of length `dim` only."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.values
    at = np.asarray(column.offsets).astype(np.int64)
    x = np.asarray(values.cast(pa.float64()).fill_null(float("nan")))
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(x), dtype=np.int64)])
    size = np.diff(at)
    sound = np.asarray(column.is_valid()) & (bad[at[1:]] == bad[at[:-1]]) & (size > 0)
    out = []
    for n in np.unique(size[sound]):
        if dim is None or n == dim:
            rows = np.flatnonzero(sound & (size == n))
            v = np.floor(x[ragged(at[rows], size[rows])].reshape(-1, n) * SCALE)
            if np.abs(v).max() >= LARGEST:
                raise ValueError(f"vector components must lie below {LARGEST // SCALE} in size")
            out.append((rows, v.astype(np.int64)))
    return out


class Cells:
    """Entries that can be nearest, by the cells of one part position."""

    def __init__(self, book: np.ndarray, shift: int, keep: int):
        self.book, self.shift, self.keep = book, shift, keep
        self._forget()

    def _forget(self) -> None:
        self.hash, self.at = np.zeros(0, np.uint64), np.zeros((0, self.book.shape[1]), np.int64)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.int32)

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        """Which entries no other entry dominates over the whole box of each cell."""
        low = (cells << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        outside = np.maximum(np.maximum(low - self.book, self.book - high), 0)
        across = np.maximum(np.abs(self.book - low), np.abs(high - self.book))
        return (outside**2).sum(2) <= (across**2).sum(2).min(1)[:, None]

    def _learn(self, hashes: np.ndarray, cells: np.ndarray) -> None:
        if len(self.hash) + len(hashes) > self.keep:
            self._forget()
        some = np.concatenate([self._undominated(cells[k : k + 1024]) for k in range(0, len(cells), 1024)])
        size = some.sum(1)
        begin = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, np.nonzero(some)[1].astype(np.int32)])
        where = np.searchsorted(self.hash, hashes)
        self.hash, self.at = np.insert(self.hash, where, hashes), np.insert(self.at, where, cells, axis=0)
        self.begin, self.size = np.insert(self.begin, where, begin), np.insert(self.size, where, size)

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        k = np.searchsorted(self.hash, hashes)
        inner = k < len(self.hash)
        inner[inner] = self.hash[k[inner]] == hashes[inner]
        return inner

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) of each part; of equal distances the lower entry."""
        cells = parts >> self.shift
        value = np.zeros(len(parts), np.uint64)
        for k in range(parts.shape[1]):
            value = mix(value * np.uint64(31) + cells[:, k].astype(np.uint64))
        unique, first = np.unique(value, return_index=True)
        new = ~self._known(unique)
        if new.any():
            self._learn(unique[new], cells[first[new]])
            if not self._known(unique).all():  # the older cells were let go
                self._learn(unique, cells[first])
        k = np.searchsorted(self.hash, value)
        same = (self.at[k] == cells).all(1)
        every = len(self.pool)  # where all entries stand, for a cell that shares its hash with another
        pool = self.pool if same.all() else np.concatenate([self.pool, np.arange(len(self.book), dtype=np.int32)])
        begin, size = np.where(same, self.begin[k], every), np.where(same, self.size[k], len(self.book))
        entry = pool[ragged(begin, size)].astype(np.int64)
        row = np.repeat(np.arange(len(parts)), size)
        far = ((parts[row] - self.book[entry]) ** 2).sum(1)
        best = np.minimum.reduceat(far * len(self.book) + entry, np.cumsum(size) - size)
        return best % len(self.book), best // len(self.book)


def blocks(batches, most: int = 8192) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, most):
            yield batch.slice(k, most)


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, position) from the vectors with the smallest ids."""

    def smallest(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in blocks(batches):
            ids = batch.column("vec_id").to_pylist()
            for rows, v in whole(batch.column("embedding")):
                if v.shape[1] % parts:
                    continue
                some = held.get(v.shape[1], []) + [((ids[r] is None, ids[r] or 0), x) for r, x in zip(rows, v.tolist(), strict=True)]
                held[v.shape[1]] = sorted(some)[:entries]
        rows = [(None if k[0] else k[1], x) for some in held.values() for k, x in some]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int64()))], ["vec_id", "v"]
        )

    few = vectors.mapInArrow(smallest, "vec_id long, v array<long>")
    order = [F.col("vec_id").asc_nulls_last(), "v"]
    top = few.orderBy(*order).limit(1).collect()
    if not top:
        return np.zeros((parts, 0, 0), np.int64)
    dim = len(top[0]["v"])
    rows = few.where(F.size("v") == dim).orderBy(*order).limit(entries).collect()
    return np.array([r["v"] for r in rows], np.int64).reshape(len(rows), parts, dim // parts).transpose(1, 0, 2)


def moved(vectors: DataFrame, books: np.ndarray, shift: int, keep: int) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape
    names = ["part", "entry", "n", *(f"s{k}" for k in range(width))]

    def add(batches) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, shift, keep) for b in books]
        n, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in blocks(batches):
            for _, v in whole(batch.column("embedding"), parts * width):
                cut = v.reshape(-1, parts, width)
                for p in range(parts):
                    entry, _ = cells[p].nearest(np.ascontiguousarray(cut[:, p]))
                    n[p] += np.bincount(entry, minlength=entries)
                    np.add.at(sums[p], entry, cut[:, p])
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part, entry, n[part, entry], *sums[part, entry].T)], names)

    added = vectors.mapInArrow(add, ", ".join(f"{c} long" for c in names)).groupBy("part", "entry").agg(*(F.sum(c).alias(c) for c in names[2:]))
    after = books.copy()
    for r in added.collect():  # at most parts * entries rows
        after[r["part"], r["entry"]] = [r[c] // r["n"] for c in names[3:]]
    return after


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def coded(
    vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, shift: int = 4, keep: int = 50_000
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every sound vector; `shift`: a cell is 2**shift wide."""
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    plain = vectors.select("vec_id", "embedding")
    books = first_books(plain, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = moved(plain, books, shift, keep)
    width = books.shape[2]

    def code(batches) -> Iterator[pa.RecordBatch]:
        cells = [Cells(b, shift, keep) for b in books]
        digits = np.frombuffer("".join(f"{k:02x}" for k in range(max(256, entries))).encode(), np.uint8)[:512].reshape(-1, 2)
        for batch in blocks(batches):
            for rows, v in whole(batch.column("embedding"), parts * width) if width else []:
                cut = v.reshape(-1, parts, width)
                found = [cells[p].nearest(np.ascontiguousarray(cut[:, p])) for p in range(parts)]
                text = digits[np.stack([e for e, _ in found], 1)].reshape(len(rows), -1)
                at = np.arange(len(rows) + 1, dtype=np.int32) * (2 * parts)
                codes = pa.StringArray.from_buffers(len(rows), pa.py_buffer(at.tobytes()), pa.py_buffer(text.tobytes()))
                kept = [batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")]
                yield pa.RecordBatch.from_arrays([*kept, codes, pa.array(sum(d for _, d in found))], ["vec_id", "label", "code", "error"])

    if entries > 256:
        raise ValueError("codes have two hex digits for each part")
    kind = vectors.schema["label"].dataType.simpleString()
    found = set_down(vectors.mapInArrow(code, f"vec_id long, label {kind}, code string, error long"), "vector-codes")
    totals = own_shuffle(found.groupBy("label").agg(F.sum("error").alias("label_error")), "label")
    return left_join(found, totals, "label", null_safe=True).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
