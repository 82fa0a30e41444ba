"""Benchmark items that reappear in documents, whole or slightly changed.

1. Every item gets windows of a size that fits it: a passage whose shingles agree to `percent` % with an item has a stretch
   of unchanged words (see `clean_run`), and a window and its stride together are no longer than that stretch. So one
   of the windows laid over the document at that stride equals one of the item's windows, which start at every word.
2. A window is a 64-bit SimHash of its words. Fingerprints within `radius` bits agree in at least one of `radius + 1`
   blocks of bits, so looking up each block finds them all; the distance is then taken exactly.
3. A pair of windows says near which words the item would lie in the document. All stretches there, of any start and end,
   that are not too short or long for `percent` % are compared with the item: bags of shingles weighted by how often each
   occurs (sum of minima over sum of maxima). The most similar one is reported, of equal ones the first.

Documents are read once and never shuffled. Items come in blocks of `most` bytes, so what tasks receive is bounded.

Defined cases: null, empty or blank texts and items match nothing; an item of fewer words than a shingle is one shingle;
equal items are all reported; repeated rows and null ids are reported row by row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import DOCUMENT_COLUMNS, texts
from riskloom.llm.wordarrays import grams, mix, slices, utf8, words

# Window sizes; each item takes the largest that leaves room for a stride.
SIZES = (1, 2, 3, 4, 5, 6, 8, 11, 16, 22, 32, 45, 64, 90, 128, 181, 256, 362, 512)


def clean_run(n: int, percent: int, width: int) -> int:
    """Words in a row that a passage similar to an item of n words has unchanged.

    A break inside (a word more, fewer or other) costs at least width - 1 shingles of the item and adds as many of its
    own; what similarity remains may be spent on words missing at the ends. The least run over all such ways counts.
    """
    spare = (100 - percent) / 100 * max(1, n - width + 1)
    cost = width - 1 + percent / 100 * (width - 1)
    least = [(n - k - int(spare - cost * k)) // (k + 1) for k in range(int(spare / cost) + 1)]
    return max(1, min(least))


def simhash(sums: np.ndarray, start: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of windows from the sums of the words' bits: a bit is set if most words have it."""
    ones = (sums[start + size] - sums[start]).view(np.uint8 if sums.shape[1] == 8 else np.uint16)
    return np.packbits(ones > size // 2, axis=1, bitorder="little").view(np.uint64).ravel()


def bit_sums(hashes: np.ndarray, largest: int) -> np.ndarray:
    """Running sums of each of the 64 bits, several counters to a 64-bit number.

    Counters overflow into their neighbours, but the difference of two sums is that of a window of at most `largest`
    words, whose counters have room.
    """
    bits = np.unpackbits(mix(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = (bits if largest < 256 else bits.astype(np.uint16)).view(np.uint64)
    sums = np.zeros((len(hashes) + 1, packed.shape[1]), np.uint64)
    np.cumsum(packed, axis=0, out=sums[1:])
    return sums


class Item(NamedTuple):
    item_id: int
    width: int  # words of a shingle
    m: int  # its shingles, of which `shingles` are the distinct ones, sorted, and `counts` how often each occurs
    shingles: np.ndarray
    counts: np.ndarray


class Windows(NamedTuple):
    """The fingerprints of all items with one window size."""

    size: int
    stride: int
    value: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    order: list[np.ndarray]  # for each block of bits: fingerprints in the order of the block's value
    first: list[np.ndarray]  # and where each value begins

    def lookup(self, query: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, fingerprint) pairs within `radius` bits, each once."""
        pairs = []
        for block, (order, first) in enumerate(zip(self.order, self.first, strict=True)):
            key = block_value(query, block, radius)
            count = first[key + 1] - first[key]
            asked = np.flatnonzero(count)
            q = np.repeat(asked, count[asked])
            k = np.arange(len(q)) - np.repeat(np.cumsum(count[asked]) - count[asked], count[asked])
            k = order[first[key[q]] + k]
            near = np.bitwise_count(query[q] ^ self.value[k]) <= radius
            pairs.append(np.stack([q[near], k[near]]))
        both = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return both[0], both[1]


def block_bounds(radius: int) -> list[int]:
    return [64 * k // (radius + 1) for k in range(radius + 2)]


def block_value(value: np.ndarray, block: int, radius: int) -> np.ndarray:
    low, high = block_bounds(radius)[block : block + 2]
    high = min(high, low + 22)  # tables of at most 2**22 entries; fewer bits only ask for more checks
    return ((value >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)).astype(np.int64)


class Benchmark:
    """What tasks need to know of the items."""

    def __init__(self, rows: list[tuple], width: int = 5, percent: int = 80, radius: int = 3):
        self.width, self.percent, self.radius = width, percent, radius
        self.items: list[Item] = []
        data, at = utf8(pa.array([t for _, t in rows], pa.string()))
        found = words(data, at, lower=True)
        by_size: dict[int, list[tuple]] = {}
        for (item_id, _), a, b in zip(rows, found.first, found.first[1:], strict=False):
            n, hashes = int(b - a), found.hash[a:b]
            if not n:
                continue
            run = clean_run(n, percent, width) if n >= width else n
            size = max(s for s in SIZES if s <= max(1, 3 * run // 4)) if n >= width else n
            by_size.setdefault(size, []).append((len(self.items), run, hashes))
            own = grams(hashes, min(n, width))
            self.items.append(Item(item_id, min(n, width), len(own), *np.unique(own, return_counts=True)))
        self.windows = [self._windows(size, group) for size, group in sorted(by_size.items())]

    def _windows(self, size: int, group: list[tuple]) -> Windows:
        value, item, offset = [], [], []
        for number, _, hashes in group:
            start = np.arange(len(hashes) - size + 1)
            value.append(simhash(bit_sums(hashes, size), start, size))
            item.append(np.full(len(start), number))
            offset.append(start)
        value = np.concatenate(value)
        order, first = [], []
        for block in range(self.radius + 1):
            low, high = block_bounds(self.radius)[block : block + 2]
            key = block_value(value, block, self.radius)
            order.append(np.argsort(key, kind="stable"))
            first.append(np.concatenate([[0], np.cumsum(np.bincount(key, minlength=1 << min(high - low, 22)))]))
        stride = max(1, min(run for _, run, _ in group) - size + 1)
        return Windows(size, stride, value, np.concatenate(item), np.concatenate(offset), order, first)

    def _longest(self, item: Item) -> int:
        """Shingles that a stretch similar enough to the item has at most."""
        return 100 * item.m // self.percent

    def _compare(self, item: Item, shingles: np.ndarray) -> tuple[float, int]:
        """(similarity, first shingle) of the stretch most similar to the item, over all first and last shingles."""
        least, most = -(-self.percent * item.m // 100), self._longest(item)
        kind = np.minimum(np.searchsorted(item.shingles, shingles), len(item.shingles) - 1)
        place = np.flatnonzero(item.shingles[kind] == shingles)  # the best stretch begins and ends at one of these
        end = np.searchsorted(place, place + most)
        starts = np.flatnonzero(end - np.arange(len(place)) >= least)
        if not len(starts):
            return 0.0, 0
        # A shingle counts unless the stretch holds as many equal ones before it as the item has: it begins after `back`.
        kind = kind[place]
        order = np.argsort(kind, kind="stable")
        allowed = item.counts[kind[order]]
        over = np.flatnonzero(np.arange(len(order)) - np.searchsorted(kind[order], kind[order]) >= allowed)
        back = np.full(len(place), -1)
        back[order[over]] = order[over - allowed[over]]
        best = (0.0, 0)
        span = int((end - np.arange(len(place)))[starts].max())
        rows = max(1, (1 << 18) // span)
        for some in np.split(starts, range(rows, len(starts), rows)):
            last = some[:, None] + np.arange(span)
            within = last < end[some][:, None]
            last = np.minimum(last, len(place) - 1)
            both = np.cumsum(within & (back[last] < some[:, None]), axis=1)
            like = np.where(within, both / (item.m + place[last] - place[some][:, None] + 1 - both), 0)
            top = like.max(axis=1)
            first = int(top.argmax())
            if top[first] > best[0]:
                best = (float(top[first]), int(place[some[first]]))
            if best[0] == 1:
                break
        return best

    def search(self, column: pa.Array) -> dict[tuple[int, int], tuple[float, int]]:
        """(row, number of item) -> (similarity, first word) of the best place with enough similarity."""
        data, at = utf8(column)
        found = words(data, at, lower=True)
        if not len(found.hash):
            return {}
        sums = bit_sums(found.hash, max((w.size for w in self.windows), default=0))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        shingles: dict[int, np.ndarray] = {}  # of all texts, by words of a shingle
        longest, widths = np.array([self._longest(i) for i in self.items]), np.array([i.width for i in self.items])
        for w in self.windows:
            # Windows start every `stride` words of their own text, and once more at its end.
            count = np.diff(found.first)
            nth = np.arange(len(found.hash)) - found.first[found.row]
            room = count[found.row] - nth
            start = np.flatnonzero((room >= w.size) & ((nth % w.stride == 0) | (room == w.size)))
            if not len(start):
                continue
            q, k = w.lookup(simhash(sums, start, w.size), self.radius)
            if not len(q):
                continue
            # Shingles of any stretch that is short enough and holds the window; overlapping ones are searched as one.
            row, number = found.row[start[q]], w.item[k]
            most, width = longest[number], widths[number]
            low = np.maximum(nth[start[q]] + w.size - most - width + 1, 0)
            high = np.minimum(nth[start[q]] + most, count[row] - width + 1)
            order = np.lexsort((low, number, row))
            row, number, low, high = row[order], number[order], low[order], high[order]
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(row) != 0) | (np.diff(number) != 0) | (low[1:] > high[:-1])
            begin = np.flatnonzero(new)
            ends = high[np.append(begin[1:], len(row)) - 1]
            for r, i, a, b in zip(row[begin].tolist(), number[begin].tolist(), low[begin].tolist(), ends.tolist(), strict=True):
                if best.get((r, i), (0.0, 0))[0] == 1:
                    continue
                item, at = self.items[i], int(found.first[r])
                if item.width not in shingles:
                    shingles[item.width] = grams(found.hash, item.width)
                like, place = self._compare(item, shingles[item.width][at + a : at + b])
                if 100 * like >= self.percent - 1e-9 and like > best.get((r, i), (0.0, 0))[0]:
                    best[r, i] = (like, a + place)
        return best


def benchmarks(benchmark: DataFrame, most: int = 16 << 20, **options) -> Iterator[Benchmark]:
    """The items in blocks of about `most` bytes of text."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = 1 + size // most
    for k in range(blocks):
        part = items.where((F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) & F.col("text").isNotNull())
        yield Benchmark([(r["item_id"], r["text"]) for r in part.collect()], **options)


LEAK = "doc_id long, item_id long, similarity double, first_word long"


def leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, similarity, first_word) of every item found in a document."""

    def finder(bench: Benchmark):
        def find(batches) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                hits, ids = bench.search(batch.column("text")), batch.column("doc_id")
                rows = [(ids[r].as_py(), bench.items[k].item_id, like, at) for (r, k), (like, at) in sorted(hits.items())]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64()]
                    columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "similarity", "first_word"])

        return find

    parts = [texts(docs).mapInArrow(finder(b), LEAK) for b in benchmarks(benchmark, **options)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no item is found, with the columns of `documents`."""

    def keeper(bench: Benchmark):
        def keep(batches) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                stay = np.ones(batch.num_rows, bool)
                stay[[r for r, _ in bench.search(batch.column("text"))]] = False
                yield batch.filter(pa.array(stay))

        return keep

    out = docs.select(DOCUMENT_COLUMNS)
    for bench in benchmarks(benchmark, **options):
        out = out.mapInArrow(keeper(bench), out.schema)
    return out
