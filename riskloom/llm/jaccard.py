"""Documents whose sets of word shingles have a Jaccard similarity of at least `percent` %: an exact T-occurrence join.

1. Equal sets are one *node* (a 64-bit hash of the sorted set), so copies are never compared with each other.
2. A sketch of bounded size counts the shingles of the whole corpus. It orders shingles, rare ones first; any order gives
   right results, this one keeps what many documents share out of the index.
3. Two similar sets share one of their first `n - ceil(t n) + 1` shingles. These and a few more go into inverted lists,
   spread by shingle; lists that may be long are salted. A shingle whose list holds no other set of near size counts as
   one that is not shared. What a set then still has to look up are its shortest lists, and most sets, those that have
   less than their common part with others, have none. A list that some set needs is cut into bands of size, since similar
   sets are of similar size, and each band and its neighbours are tied by edges to one set that needs it.
4. The components of those edges are blocks: all links lie inside them. In a block each set, smallest first, is a query
   against the inverted lists of those before it (DivideSkip): a heap merges the short lists and keeps the sets that occur
   often enough, the longest lists are only probed by binary search, and sets that reach the overlap are linked. Sets of
   the query's own component need no second link, so a large group of near copies costs one link for each set.
5. A block above `most` shingles is cut into parts by hash, and every pair of parts is a block of its own: memory stays
   bounded and no pair of sets is left out.

Defined cases: a null, empty or blank text has an empty set and links with nothing; a text of fewer words than a shingle
is one shingle; repeated rows share a set and so a component; a row with a null id is returned with a null component and
links with nothing; an empty table gives an empty result; other columns are ignored. Two different sets have the same
hash with a probability of about sets**2 / 2**65.
"""

from __future__ import annotations

import heapq
import math
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.repeats import possible
from riskloom.llm.tables import DOCUMENT_COLUMNS, set_down, texts
from riskloom.llm.wordarrays import distinct_shingles, mix, powers, slices
from riskloom.operators.joins import own_shuffle

SKETCH_BITS = (16, 22)  # four-byte counters, about one for every eight words: 256 KB to 16 MB, whatever the corpus
CHUNK = 1 << 14
FULL = (1 << 16) - 1  # where the counters of one task stop
SPARE = 16  # of so many shingles of a set one more is listed
PACK = 1 << 19  # postings that a task packs at once, and about those of a part
_SALTS = mix(np.arange(65, dtype=np.uint64))
MU = 0.0085  # share of a list's cost that a binary search saves, as usual for DivideSkip


def set_hash(shingles: np.ndarray) -> int:
    """A signed 64-bit hash of a sorted set."""
    value = (mix(shingles) * powers(len(shingles))).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([value], np.uint64)).view(np.int64)[0])


def sketch_bits(docs: DataFrame) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return min(max(math.ceil(math.log2(1 + size / 48)), SKETCH_BITS[0]), SKETCH_BITS[1])


def bucket(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(65 - len(sketch).bit_length())).astype(np.int64)


def described(docs: DataFrame, width: int) -> tuple[DataFrame, np.ndarray]:
    """(doc_id, text_hash, n_shingles, node) of every document, and the sketch of all sets."""
    bits = sketch_bits(texts(docs))

    def describe(batches) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(1 << bits, np.uint16)
        names = ["doc_id", "text_hash", "n_shingles", "node", "chunk", "counters"]
        for batch in slices(batches):
            sets = distinct_shingles(batch.column("text"), width)
            met, times = np.unique(bucket(np.concatenate(sets), counters), return_counts=True)
            counters[met] = np.minimum(counters[met].astype(np.int64) + times, FULL)
            n = len(sets)
            nodes = pa.array([set_hash(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), sizes, nodes, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
        for k in range(len(counters) // CHUNK):
            part = counters[k * CHUNK : (k + 1) * CHUNK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(1, pa.int64()) for _ in range(4)), pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], names
                )

    schema = "doc_id long, text_hash long, n_shingles long, node long, chunk int, counters binary"
    out = set_down(texts(docs).withColumn("text_hash", F.xxhash64("text")).mapInArrow(describe, schema), "sets")

    def add(batches) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("counters").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(zlib.decompress(raw), np.uint16).astype(np.int64)
        counters = [np.minimum(v, np.iinfo(np.int32).max).astype(np.int32).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(counters, pa.binary())], ["chunk", "counters"])

    parts = out.where("chunk is not null").select("chunk", "counters").repartition("chunk").mapInArrow(add, "chunk int, counters binary")
    sketch = np.zeros(1 << bits, np.int32)
    for r in parts.toLocalIterator():  # 4 * 2**bits bytes in all
        sketch[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counters"], np.int32)
    return out.where("chunk is null").select("doc_id", "text_hash", "n_shingles", "node"), sketch


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set similar to it."""
    return -(-percent * n // 100)


def prefix(n: int, percent: int) -> int:
    """How many shingles of a set of n hold one at least of any set similar to it."""
    return n - least_overlap(n, percent) + 1


def spare(n: int, percent: int) -> int:
    """How many shingles beyond those go into the lists: so many of a set's longest lists need no look."""
    return min(n - prefix(n, percent), 1 + n // SPARE)


BLOB = "part int, tokens binary, salts binary, places binary, nodes binary, sizes binary"


def postings(docs: DataFrame, width: int, percent: int, sketch: np.ndarray, hot: int | None = None, parts: int = 8) -> DataFrame:
    """The first shingles of every set, packed: a row holds those of many sets that lie in one of `parts` parts of all shingles.

    `places` numbers the sets in `nodes` and `sizes`. `salts` is 0 unless a list may be longer than `hot`, which lies above
    what shingles that merely share a counter come to.
    """
    hot = 254 + 2 * int(sketch.mean()) if hot is None else hot
    names = [x.split()[0] for x in BLOB.split(", ")]

    def packed(tokens: list, salts: list, nodes: list, sizes: list) -> pa.RecordBatch:
        place = np.repeat(np.arange(len(tokens), dtype=np.int32), [len(t) for t in tokens])
        token, salt, node, size = np.concatenate(tokens), np.concatenate(salts), np.array(nodes, np.int64), np.array(sizes, np.int32)
        part = ((token + _SALTS[salt]) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        rows = []
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            own, at = np.unique(place[some], return_inverse=True)
            at = at.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32)
            rows.append((int(part[some[0]]), *(x.tobytes() for x in (token[some], salt[some], at, node[own], size[own]))))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(zip(*rows, strict=True))], names)

    def emit(batches) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # copies inside a task
        held, n_held = ([], [], [], []), 0
        for batch in slices(batches):
            for shingles in distinct_shingles(batch.column("text"), width):
                n = len(shingles)
                if not n or (node := set_hash(shingles)) in seen:
                    continue
                seen.add(node)
                count = sketch[bucket(shingles, sketch)]
                first = np.lexsort((shingles, count))[: prefix(n, percent) + spare(n, percent)]
                for x, values in zip((shingles[first], np.where(count[first] > hot, 1 + node % 64, 0).astype(np.uint8), node, n), held, strict=True):
                    values.append(x)
                n_held += len(first)
            if n_held > PACK:
                yield packed(*held)
                held, n_held = ([], [], [], []), 0
        if n_held:
            yield packed(*held)

    return texts(docs).where("doc_id is not null").mapInArrow(emit, BLOB)


SHARED = "token long, node long, band int, spare int, others long, salted boolean"


def shared(lists: DataFrame, percent: int) -> DataFrame:
    """(token, node, band, spare, others, salted) of the postings whose list holds other sets of a size near enough.

    The sizes of similar sets lie in the same band or in neighbouring ones; `others` counts these sets, in the list of one
    salt where it is salted.
    """
    names, step = [x.split()[0] for x in BLOB.split(", ")], math.log(100 / percent)

    def together(blobs: list[dict]) -> pa.RecordBatch:
        token, salt = (np.concatenate([np.frombuffer(r[c], kind) for r in blobs]) for c, kind in (("tokens", np.int64), ("salts", np.uint8)))
        node, size = [], []
        for r in blobs:
            own = np.frombuffer(r["nodes"], np.int64)
            at = np.frombuffer(r["places"], np.uint16 if len(own) <= 1 << 16 else np.uint32)
            node.append(own[at])
            size.append(np.frombuffer(r["sizes"], np.int32)[at])
        node, size = np.concatenate(node), np.concatenate(size)
        band = np.floor(np.log(size.astype(np.float64)) / step + 1e-9).astype(np.int32)
        order = np.lexsort((node, band, token))
        # Copies of a set in several tasks.
        token, node = token[order], node[order]
        first = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))
        order, token, node = order[first], token[first], node[first]
        salt, size, band = salt[order], size[order], band[order]
        key = np.append(0, np.cumsum(token[1:] != token[:-1])) * (1 << 32) + band
        others = np.searchsorted(key, key + 1, "right") - np.searchsorted(key, key - 1, "left") - 1
        some = (others > 0) | (salt > 0)
        kinds, back = np.unique(size[some], return_inverse=True)
        extra = np.array([spare(int(n), percent) for n in kinds], np.int32)[back]
        columns = (token[some], node[some], band[some], extra, others[some].astype(np.int64), salt[some] > 0)
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [x.split()[0] for x in SHARED.split(", ")])

    def gather(batches) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch[c][k].as_py() for c in names}
                if held and row["part"] != held[0]["part"]:
                    yield together(held)
                    held = []
                held.append(row)
        if held:
            yield together(held)

    dealt = lists.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(gather, SHARED)


def candidate_edges(lists: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect every two sets that may be similar.

    Of two similar sets let A be the one whose listed shingles end first in the common order: all those that the other one,
    B, has too are in B's lists. A shingle of A in a list without other sets of near size is not in B. These and the
    shortest of the other lists, `prefix` in all, hold one at least that both have, so A needs a look into those lists only,
    and none if there are `prefix` shingles of the first kind. In each of them the sets are tied to one that needs the list.
    """
    rows = set_down(shared(lists, percent), "shared-shingles")
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    salted = rows.where("salted")
    # Lists of several salts are counted together.
    count = salted.groupBy("token", "band").agg(F.count(F.lit(1)).alias("n"))
    count = count.select("token", near.alias("band"), "n").groupBy("token", "band").agg((F.sum("n") - 1).alias("others"))
    counted = salted.drop("others").join(own_shuffle(count, ["token", "band"]), ["token", "band"]).where("others > 0")
    columns = ["token", "node", "band", "spare", "others"]
    counted = rows.where("not salted").select(columns).unionByName(counted.select(columns))
    own = Window.partitionBy("node")
    looks = counted.select(
        "token", "node", "band", "spare", F.row_number().over(own.orderBy("others", "token")).alias("place"), F.count(F.lit(1)).over(own).alias("n")
    ).where("place <= n - spare")
    centres = looks.groupBy("token", "band").agg(F.min("node").alias("b"))
    centres = set_down(centres.select("token", near.alias("band"), "b"), "lists")
    wanted = possible(rows.select("token", "band", F.col("node").alias("a"), F.col("token").alias("t")), centres.select(F.col("token").alias("t")))
    ties = wanted.where("possible").select("token", "band", "a").join(own_shuffle(centres, ["token", "band"]), ["token", "band"])
    return ties.where("a <> b").select("a", "b").distinct()


class Index:
    """Inverted lists over sets given smallest first, searched by T-occurrence."""

    def __init__(self, percent: int):
        self.percent, self.lists, self.sizes = percent, {}, []

    def add(self, tokens: list[int], size: int) -> None:
        k = len(self.sizes)
        self.sizes.append(size)
        for t in tokens:
            self.lists.setdefault(t, []).append(k)

    def search(self, tokens: list[int], size: int, skip=lambda k: False) -> Iterator[int]:
        """The sets so far, none larger than the query, that are similar to it; `skip` is asked before each check."""
        low = bisect_left(self.sizes, least_overlap(size, self.percent))
        least = least_overlap(size, self.percent)  # with a set no larger than itself
        found = [x for x in (self.lists.get(t) for t in tokens) if x and x[-1] >= low]
        if len(found) < least:
            return
        found.sort(key=len)
        n_long = min(least - 1, int(least / (MU * math.log2(len(found[-1]) + 1) + 1)))
        short, long = found[: len(found) - n_long], found[len(found) - n_long :]
        need = least - n_long
        merged = heapq.merge(*(x[bisect_left(x, low) :] if x[0] < low else x for x in short))
        for k, same in groupby(merged):
            count = sum(1 for _ in same)
            if count < need or skip(k):
                continue
            # 100 * overlap >= percent * (size + other - overlap), in whole numbers
            enough = -(-self.percent * (size + self.sizes[k]) // (100 + self.percent))
            left = len(long)
            for x in long:
                if count >= enough or count + left < enough:
                    break
                left -= 1
                at = bisect_left(x, k)
                count += at < len(x) and x[at] == k
            if count >= enough:
                yield k


def root(parent: list[int], k: int) -> int:
    while parent[k] != k:
        parent[k] = parent[parent[k]]
        k = parent[k]
    return k


def linked(sets: list[np.ndarray], percent: int) -> list[int]:
    """For each set the smallest number of those it is linked with, directly or by others."""
    order = sorted(range(len(sets)), key=lambda k: len(sets[k]))
    _, back, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.split(np.where(count[back] > 1, back, -1), np.cumsum([len(s) for s in sets])[:-1])
    parent, index = list(range(len(sets))), Index(percent)
    for k in order:
        tokens = shared[k][shared[k] >= 0].tolist()
        for j in index.search(tokens, len(sets[k]), lambda j, k=k: root(parent, order[j]) == root(parent, k)):
            a, b = root(parent, k), root(parent, order[j])
            parent[max(a, b)] = min(a, b)
        index.add(tokens, len(sets[k]))
    return [root(parent, k) for k in range(len(sets))]


def links(docs: DataFrame, blocks: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect exactly the linked sets; `blocks`: (doc_id, node, block, other), one row for each block of a set."""

    def solve(rows: list[tuple]) -> tuple[list[int], list[int]]:
        nodes, sets = [], []
        for text, node in rows:
            shingles = distinct_shingles(pa.array([text]), width)[0]
            # A repeated doc_id may bring other texts along.
            if len(shingles) and set_hash(shingles) == node and node not in nodes[-1:]:
                nodes.append(node)
                sets.append(shingles)
        to = linked(sets, percent) if len(sets) > 1 else []
        pairs = [(nodes[k], nodes[j]) for k, j in enumerate(to) if j != k]
        return [a for a, _ in pairs], [b for _, b in pairs]

    def search(batches) -> Iterator[pa.RecordBatch]:
        def edges(rows):
            a, b = solve(rows)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        now, rows = None, []
        for batch in slices(batches):
            columns = [batch.column(c).to_pylist() for c in ("block", "other", "text", "node")]
            for block, other, text, node in zip(*columns, strict=True):
                if (block, other) != now and rows:
                    yield edges(rows)
                    rows = []
                now = (block, other)
                rows.append((text, node))
        if rows:
            yield edges(rows)

    # Most texts are in no block; a bitmap rules nearly all of them out before the shuffle.
    found = possible(texts(docs).withColumn("t", F.xxhash64("doc_id")), blocks.select(F.xxhash64("doc_id").alias("t")))
    wanted = found.where("possible").select("doc_id", "text").join(own_shuffle(blocks, "doc_id"), "doc_id").select("block", "other", "node", "text")
    together = wanted.repartition("block", "other").sortWithinPartitions("block", "other", "node")
    return together.mapInArrow(search, "a long, b long")


def in_blocks(nodes: DataFrame, candidates: DataFrame, most: int) -> DataFrame:
    """(doc_id, node, block, other): components of candidates as blocks; large ones as all pairs of their parts."""
    labelled = nodes.join(own_shuffle(components(candidates), "node"), "node")
    size = labelled.groupBy("label").agg(F.ceil(F.sum("n_shingles") / most).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    rows = labelled.join(own_shuffle(size, "label"), "label").withColumn("part", part).withColumn("with", F.explode(others))
    pair = F.least("part", "with") * F.col("parts").cast("long") + F.greatest("part", "with")
    return rows.select("doc_id", "node", F.col("label").alias("block"), pair.alias("other"))


def labelled_sets(docs: DataFrame, width: int, percent: int, most: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, label, component_id) of every document; no label without a set or an id."""
    sets, sketch = described(docs, width)
    listed = sets.agg(F.sum("n_shingles")).first()[0] or 0
    candidates = candidate_edges(postings(docs, width, percent, sketch, parts=1 + listed * (100 - percent) // 100 // PACK), percent)
    nodes = sets.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    blocks = set_down(in_blocks(nodes, candidates, most), "blocks")
    found = components(links(docs, blocks, width, percent))
    labelled = nodes.join(own_shuffle(found, "node"), "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("label"))
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_node = labelled.join(own_shuffle(smallest, "label"), "label").select("node", "label", "component_id")
    with_set = sets.join(own_shuffle(by_node, "node"), "node", "left")
    known = F.col("doc_id").isNotNull()
    alone = F.coalesce("component_id", F.when(F.col("node").isNull(), F.col("doc_id")))
    return with_set.select(
        "doc_id", "text_hash", "n_shingles", F.when(known, F.col("label")).alias("label"), F.when(known, alone).alias("component_id")
    )


def groups(docs: DataFrame, width: int = 5, percent: int = 80, most: int = 1_000_000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: the smallest doc_id that links reach."""
    return labelled_sets(docs, width, percent, most).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, most: int = 1_000_000) -> DataFrame:
    """One document of every group, with the columns of `documents`: the smallest doc_id, of its texts the smallest hash.

    A document is an id with a text: of an id with two texts each belongs to the group of its own. Of rows equal in
    doc_id and text one stays; rows with a null id all stay.
    """
    docs = docs.select(DOCUMENT_COLUMNS)
    grouped = labelled_sets(docs, width, percent, most).where("doc_id is not null").select("label", "doc_id", "text_hash")
    grouped = set_down(grouped, "near-copies")
    key = ["doc_id", "text_hash"]
    kept = grouped.where("label is not null").groupBy("label").agg(F.min(F.struct(*key)).alias("first"))
    gone = grouped.join(own_shuffle(kept, "label"), "label").where(F.struct(*key) != F.col("first")).select(key).distinct()
    twice = grouped.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    touched = set_down(gone.withColumn("gone", F.lit(True)).unionByName(twice.withColumn("gone", F.lit(False))), "touched")
    t = F.xxhash64(*key).alias("t")
    known = docs.where("doc_id is not null").withColumn("text_hash", F.xxhash64(F.col("text").cast("string"))).select("*", t)
    # Only rows that may go or be repeated are shuffled, a share of all; a bitmap tells the others.
    known = possible(known, touched.select(t))
    some = known.where("possible").join(own_shuffle(touched.where("gone"), key), key, "left_anti").dropDuplicates([*key, "text"])
    left = known.where("not possible").select(DOCUMENT_COLUMNS).unionByName(some.select(DOCUMENT_COLUMNS))
    return left.unionByName(docs.where("doc_id is null"))
