"""Bytes covered by a string of `width` bytes that starts in two places or more, found by sorting sampled suffixes.

A difference cover samples suffixes by their place, which for a corpus is more rows than may be held. Here the sample is
drawn by content, which keeps what the cover is for: equal strings hold the same sampled suffix at the same place. Of the
`width // 4` first suffixes of a string, its anchor is the one whose first bytes have the smallest hash (the leftmost of
equal ones). Every string has an anchor within itself, and as no more than `width` bytes of a suffix are ever compared,
hashes of the compared bytes are names.

1. Names of all anchors (the bytes that lie in the string wherever it starts) are counted. A string whose anchor's name
   occurs once is unique.
2. Every other anchor gets the name of its surroundings: all bytes of the strings that it is the anchor of. If that name
   occurs twice, so do all these strings. This settles all but the edges of repeats.
3. The remaining strings (edges, and one example of each kind of surroundings they may equal) are named in full and sorted
   by name over all tasks, and neighbours are compared; a name that many texts hold may span several tasks, whose first and
   last names are compared afterwards.

Equal texts are one text throughout, each task passes on a text once, and counts are summed in the tasks before any
shuffle. Texts are only shuffled if a bitmap of 4 MB at most doesn't rule them out: for step 3 it has those with a shared
anchor, for the cutting those that lose some of their bytes. Names are 64-bit hashes: among n names two differing strings
agree with a probability of about n**2 / 2**65.

Defined cases: a null or empty text has no bytes; a text shorter than `width` keeps all; repeated rows are copies, so they
lose all their bytes if long enough; null and repeated ids are reported row by row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down, texts
from riskloom.llm.wordarrays import prefix_hash, range_hash, slices
from riskloom.operators.joins import own_shuffle

PLACES = "name long, t long, start int, stop int, wanted boolean"
CHUNK = 1 << 16  # starts that are looked at together; a power of two


class Anchors(NamedTuple):
    """Of each anchor of a text, in order: its strings start at `lo` to `hi` - 1; `name` and `around` are hashes."""

    lo: np.ndarray
    hi: np.ndarray
    name: np.ndarray
    around: np.ndarray


def smallest(values: np.ndarray, w: int) -> np.ndarray:
    """The place of the smallest of each `w` neighbours, the leftmost of equal ones; at most 2 * CHUNK values."""
    low = np.uint64(2 * CHUNK - 1)
    least = (values & ~low) | np.arange(len(values), dtype=np.uint64)
    k = 1
    while 2 * k <= w:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if k < w:
        least = np.minimum(least[: k - w], least[w - k :])
    return (least & low).astype(np.int64)


def anchors(data: np.ndarray, width: int) -> tuple[np.ndarray, Anchors]:
    """Running sums of one text and the anchors of its strings of `width` bytes."""
    w = max(1, width // 4)
    if w >= CHUNK:
        raise ValueError(f"width must be below {4 * CHUNK}")
    sums = prefix_hash(data)
    n, gram = len(data) - width + 1, width - w + 1
    los, ats, values = [], [], []
    for a in range(0, n, CHUNK):
        begin = np.arange(a, min(a + CHUNK, n) + w - 1)
        value = range_hash(sums, begin, begin + gram)
        at = smallest(value, w)
        turn = np.append(0, np.flatnonzero(np.diff(at)) + 1)
        if ats and ats[-1][-1] == at[0] + a:  # the anchor of the chunk before goes on
            turn = turn[1:]
        los.append(turn + a)
        ats.append(at[turn] + a)
        values.append(value[at[turn]])
    if not los:
        none = np.zeros(0, np.int64)
        return sums, Anchors(none, none, none.view(np.uint64), none.view(np.uint64))
    lo, at = np.concatenate(los), np.concatenate(ats)
    hi = np.append(lo[1:], n)
    return sums, Anchors(lo, hi, np.concatenate(values), range_hash(sums, lo, hi - 1 + width) ^ (at - lo).astype(np.uint64))


def fresh(batches) -> Iterator[pa.RecordBatch]:
    """The rows whose text this task meets for the first time."""
    seen: set[int] = set()
    for batch in batches:
        first = []
        for t in batch.column("t").to_pylist():
            first.append(t not in seen)
            seen.add(t)
        yield batch.filter(pa.array(first, pa.bool_()))


def once(docs: DataFrame) -> DataFrame:
    """(t, text): every text once from each task; t is its hash."""
    return docs.mapInArrow(fresh, "t long, text string")


def each_text(batches) -> Iterator[tuple]:
    for batch in slices(batches):
        for t, text in zip(batch.column("t").to_pylist(), batch.column("text").to_pylist(), strict=True):
            yield t, np.frombuffer(text.encode(), np.uint8)


BITS = 1 << 25  # of a bitmap: 4 MB


def possible(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Adds `possible`, which is true wherever `keys` has the row's t, and by chance elsewhere (a share of keys / BITS)."""
    slot = F.pmod("t", F.lit(BITS))
    bits = keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("position"))
    # Shuffled as positions: bitmaps of single tasks would be 4 KB for almost every key.
    bits = bits.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("position").alias("bits"))
    position = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(byte, (position % 8).cast("int")) == 1
    found = docs.withColumn("bucket", F.bitmap_bucket_number(slot)).join(F.broadcast(bits), "bucket", "left")
    return found.select(*docs.columns, F.coalesce(bit, F.lit(False)).alias("possible"))


def sampled(docs: DataFrame, width: int) -> DataFrame:
    """(t, place, name, around) of every anchor; `place` counts the anchors of a text."""

    def sample(batches) -> Iterator[pa.RecordBatch]:
        names = ["t", "place", "name", "around"]
        parts: list[tuple] = []
        held = 0
        for t, data in each_text(fresh(batches)):
            _, own = anchors(data, width)
            n = len(own.lo)
            parts.append((np.full(n, t, np.int64), np.arange(n, dtype=np.int32), own.name.view(np.int64), own.around.view(np.int64)))
            held += n
            if held > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)
                parts, held = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)

    return docs.mapInArrow(sample, "t long, place int, name long, around long")


def settled(found: DataFrame) -> DataFrame:
    """For each text the anchors whose name occurs elsewhere: (t, list of (place, twice, shown)).

    `twice`: its surroundings occur elsewhere too; `shown`: it stands for its kind of surroundings among several kinds.
    """
    # Names that occur once go first, by narrow rows: few anchors are left for the wider steps.
    again = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    found = set_down(found.join(own_shuffle(again, "name"), "name", "left_semi"), "shared-samples")
    kinds = found.groupBy("name", "around").agg(
        F.min(F.struct("t", "place")).alias("first"), F.max(F.struct("t", "place")).alias("last")
    )
    per_name = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.max((F.col("first") != F.col("last")).cast("int")).alias("again"))
    per_name = per_name.where("kinds > 1 or again = 1").select("name", "kinds")
    kinds = kinds.join(own_shuffle(per_name, "name"), "name").select("name", "around", "first", "kinds", (F.col("first") != F.col("last")).alias("twice"))
    rows = found.join(own_shuffle(kinds, ["name", "around"]), ["name", "around"])
    shown = (F.col("kinds") > 1) & (F.struct("t", "place") == F.col("first"))
    return rows.groupBy("t").agg(F.sort_array(F.collect_set(F.struct("place", "twice", shown.alias("shown")))).alias("marks"))


def undecided(docs: DataFrame, marks: DataFrame, width: int) -> DataFrame:
    """Stretches of starts that are settled (name null), and the names of single starts that are not."""

    def place(batches) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PLACES.split(", ")]
        for batch in slices(fresh(batches)):
            for t, text, some in zip(*(batch.column(c).to_pylist() for c in ("t", "text", "marks")), strict=True):
                sums, own = anchors(np.frombuffer(text.encode(), np.uint8), width)
                at = np.array([m["place"] for m in some])
                twice, shown = np.array([m["twice"] for m in some]), np.array([m["shown"] for m in some])
                lo, hi = own.lo[at], own.hi[at]
                begin, end = lo[twice], hi[twice]
                if len(begin):
                    apart = begin[1:] != end[:-1]
                    begin, end = begin[np.append(True, apart)], end[np.append(apart, True)]
                tell = ~twice | shown
                size = (hi - lo)[tell]
                named = np.repeat(lo[tell] - np.cumsum(size) + size, size) + np.arange(size.sum())
                value = range_hash(sums, named, named + width).view(np.int64)
                total = len(begin) + len(named)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([np.zeros(len(begin), np.int64), value]), mask=np.arange(total) < len(begin)),
                        pa.array(np.full(total, t, np.int64)),
                        pa.array(np.concatenate([begin, named]).astype(np.int32)),
                        pa.array(np.concatenate([end, named + 1]).astype(np.int32)),
                        pa.array(np.concatenate([np.zeros(len(begin), bool), np.repeat(~twice[tell], size)])),
                    ],
                    names,
                )

    # A text none of whose anchors is shared holds no repeated string.
    # Equal texts of several tasks meet in one, which looks at the first.
    return docs.repartition("t").join(marks.repartition("t"), "t").mapInArrow(place, PLACES)


HITS = "name long, t long, start int, stop int, wanted boolean, equal boolean, edge boolean"


def neighbours(places: DataFrame) -> DataFrame:
    """Of names in sorted order, those equal to a neighbour and wanted: (t, start, stop).

    The order goes on by text and start, so that one name may fill several tasks; the first and last row of every task are
    compared with those of the others.
    """
    names = [x.split()[0] for x in HITS.split(", ")]

    def rows_of(rows: list[np.ndarray], equal: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        some = edge | (equal & rows[4])
        return pa.RecordBatch.from_arrays([pa.array(c[some]) for c in (*rows, equal, edge)], names)

    def compare(batches) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, until its right neighbour is known; whether it equals its left one; whether it is the first
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.asarray(batch.column(c)) for c in names[:5]]
            begins = held is None
            if not begins:
                rows = [np.concatenate([h, r]) for h, r in zip(held[0], rows, strict=True)]
            # A text that two tasks passed on is no second place.
            same = (rows[0][1:] == rows[0][:-1]) & ((rows[1][1:] != rows[1][:-1]) | (rows[2][1:] != rows[2][:-1]))
            equal = np.append(False, same) | np.append(same, False)
            edge = np.zeros(len(equal), bool)
            equal[0] |= not begins and held[1]
            edge[0] = begins or held[2]
            yield rows_of([r[:-1] for r in rows], equal[:-1], edge[:-1])
            held = ([r[-1:] for r in rows], bool(equal[-1]), bool(edge[-1]))
        if held is not None:
            yield rows_of(held[0], np.array([held[1]]), np.array([True]))

    compared = set_down(places.repartitionByRange("name", "t", "start").sortWithinPartitions("name", "t", "start").mapInArrow(compare, HITS), "hits")
    edges = compared.where("edge")
    several = edges.groupBy("name").agg(F.countDistinct("t", "start").alias("n")).where("n > 1").select("name")
    at_edges = edges.where("wanted and not equal").join(own_shuffle(several, "name"), "name", "left_semi")
    return compared.where("wanted and equal").select("t", "start", "stop").unionByName(at_edges.select("t", "start", "stop"))


def cut(data: bytes, ranges: list[tuple[int, int]], width: int) -> tuple[int, int, bytes]:
    """(bytes removed, runs removed, what is left) for stretches of starts."""
    out, end, removed, runs = [], 0, 0, 0
    for start, stop in sorted(ranges):
        stop += width - 1
        if start > end or not runs:
            runs += 1
            out.append(data[end:start])
        removed += max(0, stop - max(start, end))
        end = max(end, stop)
    return removed, runs, b"".join([*out, data[end:]])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def without_repeats(docs: DataFrame, width: int = 400) -> DataFrame:
    """One row for each document: how many bytes it has, how many go, in how many runs, and the digest of the rest."""
    docs = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    long = docs.where(F.octet_length("text") >= width).select(F.xxhash64("text").alias("t"), "text")
    marks = set_down(settled(set_down(sampled(long, width), "samples")), "marks")
    shared = possible(long, marks).where("possible").select("t", "text")
    places = set_down(undecided(once(shared), marks, width), "places")
    hits = neighbours(places.where("name is not null")).unionByName(places.where("name is null").select("t", "start", "stop"))
    per_text = hits.groupBy("t").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    copies = long.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    found = set_down(per_text.join(copies.where("n > 1").select("t", F.lit(True).alias("copied")), "t", "full"), "ranges")

    columns = ["doc_id", "size", "digest", "text", "ranges", "copied"]
    nothing = hashlib.sha256(b"").hexdigest()

    def finish(batches) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in RESULT.split(", ")]
        for batch in slices(batches):
            rows = []
            for doc_id, size, digest, text, ranges, copied in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if copied:
                    rows.append((doc_id, size, size, 1, nothing))
                elif not ranges:
                    rows.append((doc_id, size, 0, 0, digest))
                else:
                    removed, runs, rest = cut(text.encode(), [(r["start"], r["stop"]) for r in ranges], width)
                    rows.append((doc_id, size, removed, runs, hashlib.sha256(rest).hexdigest()))
            kinds = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    # Of texts that lose nothing or all, size and digest are enough.
    keyed = possible(docs.withColumn("t", F.xxhash64("text")), found.where("copied is null"))
    rows = keyed.select("t", "doc_id", F.octet_length("text").alias("size"), F.sha2("text", 256).alias("digest"), F.when(F.col("possible"), F.col("text")).alias("text"))
    return rows.join(own_shuffle(found, "t"), "t", "left").select(*columns).mapInArrow(finish, RESULT)
