"""Packing of tokenised documents into training sequences of a fixed number of tokens.

1. Every document becomes token ids and an end id. Only documents longer than a sequence are cut; the remainder comes
   first, so that all other pieces of such a document are full. (Arrow batches; only lengths and checksums leave the task.)
2. How many pieces there are of each length is all that packing needs: at most `capacity` counts reach the driver,
   whatever the number of documents. Equal bins are one *pattern* with a multiplicity, so the plan is as small.
3. A best-fit start is improved by local search over underfull patterns: move one piece or two, exchange one for one, one
   for two or two for one, always so that the sum of squared fills grows, until no step helps or the bins are as few as
   the tokens allow.
4. The k-th piece of a length takes the k-th place that the plan has for that length. Ranks come from salted windows, so
   that a length held by a third of all pieces is still shared out over many tasks.

Defined cases: a null or empty text is its end id alone; repeated rows and repeated or null ids are separate documents;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import json
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down, texts
from riskloom.llm.wordarrays import prefix_hash, range_hash, slices, utf8

# Bytes that begin no white space. Other white space than ASCII begins with C2, E1, E2 or E3 in UTF-8; not cutting
# before such a byte is always safe.
_GOES_ON = np.ones(256, bool)
_GOES_ON[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3]] = False
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class ChunkEncoder:
    """Token ids of texts, with the ids of chunks already met kept in sorted arrays.

    The byte-level pre-tokeniser always cuts before a space that a character other than white space follows, and what
    stands behind a cut does not change what stands before it. So a text's ids are the ids of its chunks, cut there, one
    after the other, and chunks of different texts may be encoded in one run. The arrays hold at most `keep` chunks and
    start anew beyond; that costs time only.
    """

    def __init__(self, path: str, keep: int = 1_000_000):
        self.keep, self.ranks, self.tokenizer = keep, rank_encoding(path), None
        if self.ranks:
            sizes = {i: len(x) for x, i in self.ranks._mergeable_ranks.items()}
            self.id_bytes = np.array([sizes.get(i, 0) for i in range(max(sizes) + 1)], np.int64)
        else:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True  # the names of special tokens are ordinary text here
        self._forget()

    def _forget(self) -> None:
        self.hash, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.filled = np.zeros(1 << 16, np.uint32), 0

    def _run(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encode chunks laid one after the other: all ids, and the number of ids of each chunk."""
        raw = data[ragged(start, size)]
        text = raw.tobytes().decode()
        if self.ranks:
            ids = np.array(self.ranks.encode_ordinary(text), np.uint32)
            token_ends, ends = np.cumsum(self.id_bytes[ids]), np.cumsum(size)
        else:
            encoded = self.tokenizer.encode(text, add_special_tokens=False)
            ids, token_ends = np.array(encoded.ids, np.uint32), np.array([b for _, b in encoded.offsets], np.int64)
            ends = np.cumsum(np.add.reduceat((raw & 0xC0) != 0x80, np.cumsum(size) - size, dtype=np.int64))
        return ids, np.diff(np.searchsorted(token_ends, ends, side="right"), prepend=0)

    def _learn(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, value: np.ndarray) -> None:
        """Add chunks that are not known, each once, in the order of their hashes."""
        joint = data[start] == 0x20  # only the first chunk of a text may begin otherwise
        runs = [np.array([k]) for k in np.flatnonzero(~joint)]
        together = np.flatnonzero(joint)
        runs += np.array_split(together, 1 + int(size[together].sum()) // 50_000) if len(together) else []
        begin, counts = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for run in runs:
            ids, counts[run] = self._run(data, start[run], size[run])
            while self.filled + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.filled : self.filled + len(ids)] = ids
            begin[run] = self.filled + np.cumsum(counts[run]) - counts[run]
            self.filled += len(ids)
        at = np.searchsorted(self.hash, value)
        self.hash = np.insert(self.hash, at, value)
        self.begin = np.insert(self.begin, at, begin)
        self.size = np.insert(self.size, at, counts)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the n + 1 places where texts begin."""
        data, at = utf8(column)
        if len(self.hash) > self.keep:
            self._forget()
        cut = np.zeros(len(data) + 1, bool)
        cut[: max(0, len(data) - 1)] = (data[:-1] == 0x20) & _GOES_ON[data[1:]]
        cut[at[1:-1][at[1:-1] > 0] - 1] = False  # the last byte of a text
        cut[at] = True
        start = np.flatnonzero(cut[:-1])
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        size = np.diff(start, append=len(data))
        value = range_hash(prefix_hash(data), start, start + size)
        unique, where, back = np.unique(value, return_index=True, return_inverse=True)
        k = np.searchsorted(self.hash, unique)
        new = np.ones(len(unique), bool)
        inner = k < len(self.hash)
        new[inner] = self.hash[k[inner]] != unique[inner]
        if new.any():
            self._learn(data, start[where[new]], size[where[new]], unique[new])
            k = np.searchsorted(self.hash, unique)
        begin, counts = self.begin[k][back], self.size[k][back]
        places = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(start, at)]
        return self.pool[ragged(begin, counts)], places


def rank_encoding(path: str):
    """The same vocabulary for tiktoken, several times as fast, if ids follow the order of merges; else None."""
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    vocabulary, merges = model.get("vocab", {}), [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    plain = model.get("type") == "BPE" and not model.get("ignore_merges") and not spec.get("normalizer")
    level = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    if not (plain and level and all(vocabulary.get(a + b) == 256 + k for k, (a, b) in enumerate(merges))):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]  # these bytes stand for themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in vocabulary.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ragged(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), then the same for start[1] and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of n tokens: the remainder first, then full ones."""
    rest = n % capacity
    return ([rest] if rest else []) + [capacity] * (n // capacity)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenise and cut: (doc_id, piece, start, length, ids_crc32)."""
    end = np.array([end_id], "<u4")

    def cut(batches) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder(tokenizer)
        for batch in slices(batches, most=1 << 21):
            rows = []
            ids, at = encoder.encode(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), at, at[1:], strict=False):
                raw, start = np.append(ids[a:b], end).astype("<u4").tobytes(), 0
                for k, length in enumerate(piece_lengths(len(raw) // 4, capacity)):
                    rows.append((doc_id, k, start, length, zlib.crc32(raw[4 * start : 4 * (start + length)])))
                    start += length
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return texts(docs).mapInArrow(cut, PIECES)


# A pattern is a tuple of lengths, longest first; a plan counts how many bins have each pattern.
Plan = Counter


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Longest first, each length into the fullest bins with room for it, many equal bins at a time."""
    by_room: dict[int, Counter] = defaultdict(Counter)
    full: Plan = Counter()

    def put(pattern: tuple, times: int) -> None:
        room = capacity - sum(pattern)
        (by_room[room] if room else full)[pattern] += times

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            room = min((r for r in by_room if r >= size), default=None)
            if room is None:
                fit = min(capacity // size, left)
                put((size,) * fit, left // fit)
                left %= fit
                continue
            pattern, times = by_room[room].popitem()
            if not by_room[room]:
                del by_room[room]
            fit = min(room // size, max(1, left // times), left)
            used = min(times, left // fit)
            put(pattern + (size,) * fit, used)
            if times > used:
                put(pattern, times - used)
            left -= used * fit
    for group in by_room.values():
        full.update(group)
    return full


def _options(pattern: tuple) -> list[tuple[int, tuple]]:
    """Nothing, one piece or two pieces of a pattern, with their length together, each choice of lengths once."""
    held = Counter(pattern)
    pairs = [*itertools.combinations(held, 2), *((x, x) for x, n in held.items() if n > 1)]
    return [(0, ()), *((x, (x,)) for x in held), *((x + y, (x, y)) for x, y in pairs)]


def _best_step(low: tuple, highs: list[tuple], capacity: int) -> tuple[tuple, tuple, tuple] | None:
    """(high, taken, given): a move, one for one, two for one or one for two that shifts most from `low` to `high`."""
    takes = sorted(x for x in _options(low) if x[1])
    sums = np.array([x[0] for x in takes])
    gives = [(high, n, given) for high in highs for n, given in _options(high)]
    back = np.array([n for _, n, _ in gives])
    pair = np.array([len(given) == 2 for _, _, given in gives])
    limit = back + np.array([capacity - sum(high) for high, _, _ in gives])
    single = np.array([len(t) == 1 for _, t in takes])
    best = None
    for wanted, allowed in ((np.ones(len(takes), bool), ~pair), (single, pair)):
        some = np.flatnonzero(wanted)
        if not len(some) or not allowed.any():
            continue
        k = np.searchsorted(sums[some], limit, side="right") - 1
        gain = np.where(allowed & (k >= 0), sums[some][k] - back, 0)
        top = int(np.argmax(gain))
        if gain[top] > 0 and (best is None or gain[top] > best[0]):
            best = (gain[top], (gives[top][0], takes[some[k[top]]][1], gives[top][2]))
    return best and best[1]


def _without(pattern: tuple, gone: tuple) -> list[int]:
    out = list(pattern)
    for x in gone:
        out.remove(x)
    return out


def improve(plan: Plan, capacity: int, least: int) -> int:
    """One pass over the underfull patterns, emptiest first, in place; the number of steps made."""
    steps, bins = 0, sum(plan.values())
    heap = [(sum(p), p) for p in plan if sum(p) < capacity]
    heapq.heapify(heap)
    while heap and bins > least:
        fill, low = heapq.heappop(heap)
        if not plan.get(low):
            continue
        highs = [p for p in plan if fill <= sum(p) < capacity and (p != low or plan[p] > 1)]
        found = _best_step(low, highs, capacity) if highs else None
        if not found:
            continue
        steps += 1
        high, taken, given = found
        times = min(plan[low], plan[high]) if high != low else plan[low] // 2
        for old in (low, high):
            plan[old] -= times
            if not plan[old]:
                del plan[old]
        changed = [tuple(sorted([*_without(high, given), *taken], reverse=True))]
        changed.append(tuple(sorted([*_without(low, taken), *given], reverse=True)))
        for new in changed:
            if new:
                plan[new] += times
            else:
                bins -= times
        for p in {*changed, low, high}:
            if p and plan.get(p) and sum(p) < capacity:
                heapq.heappush(heap, (sum(p), p))
    return steps


def local_search(plan: Plan, capacity: int) -> Plan:
    """Shift pieces from emptier bins to fuller ones until no step helps, or no fewer bins can hold the tokens.

    A step moves a piece, exchanges one for one, one for two or two for one. The receiving bin is at least as full as the
    giving one, so every step raises the sum of squared fills, and the search ends. A pattern without a step may get
    one by the changes of others, so passes are repeated until one makes no step.
    """
    plan = Counter(plan)
    least = -(-sum(sum(p) * n for p, n in plan.items()) // capacity)
    while improve(plan, capacity, least):
        pass
    return plan


def places(plan: Plan) -> dict[str, np.ndarray]:
    """Runs of places by length and rank: sequence = base + (rank - from) // per, offset = at + (rank - from) % per * length."""
    used: Counter = Counter()
    rows, base = [], 0
    for pattern, times in sorted(plan.items(), reverse=True):
        at = 0
        for size, per in sorted(Counter(pattern).items(), reverse=True):
            rows.append((size, used[size], base, at, per))
            used[size] += per * times
            at += size * per
        base += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("size", "from", "base", "at", "per"), table.T, strict=True))


def pack(found: DataFrame, capacity: int = 1024) -> DataFrame:
    """Add `sequence_id` and `offset` to a table with `length` (1 to `capacity`) and a key `doc_id`, `piece`."""
    found = set_down(found, "pieces")  # counted and ranked below: both must see the same rows
    counts = {int(r["length"]): int(r["n"]) for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(local_search(best_fit(counts, capacity), capacity))
    salts = min(1 << 16, max(64, sum(counts.values()) // 2_000_000))
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(salts)))
    group = Window.partitionBy("length", "_salt")
    before = (
        salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")).drop("_n")
    )
    ranked = salted.withColumn("_k", F.row_number().over(group.orderBy("doc_id", "piece"))).join(before, ["length", "_salt"])
    ranked = ranked.select(*found.columns, (F.col("_before") + F.col("_k") - 1).alias("_rank"))

    names = found.columns

    def place(batches) -> Iterator[pa.RecordBatch]:
        start = where["size"] * (1 << 44) + where["from"]
        for batch in batches:
            size, rank = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "_rank"))
            k = np.searchsorted(start, size * (1 << 44) + rank, side="right") - 1
            nth = rank - where["from"][k]
            sequence = where["base"][k] + nth // where["per"][k]
            offset = where["at"][k] + nth % where["per"][k] * size
            kept = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in found.dtypes)
    return ranked.mapInArrow(place, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Tokenise, cut and pack: one row for each piece with its place."""
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
