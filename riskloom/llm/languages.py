"""Language of a text, by one bit-sliced Bloom filter that tells for each n-gram which languages use it.

Learning. Of every language about `most` documents are taken: those whose hashed id lies below a cut that follows from the
language's number of documents, so nothing is ranked. The byte n-grams of their whole texts (words folded to lower case, with a
space at either end) are counted by language. A language's filter holds an n-gram if the language uses it at least `share`
times as often, for its size, as the language that uses it most, and `least` times or more.

Filter. One row of bits for each place and one bit in it for each language: an n-gram sets the bits of its languages in `hashes`
rows. Reading those rows and taking their logical product gives the mask of all languages at once. Its size follows from the number
of n-grams, 2**`bits` rows at most, so it can be sent to all tasks; it is put together from parts of a fixed size.

Deciding. Per-language counts of set bits over all n-grams of a text are its hits. A slice of which a share `f` of bits is set
answers yes by mistake with a probability of f**hashes; hits are corrected for it, and the language with the most
corrected hits is predicted. The score is its part of the corrected hits of all languages.

Defined cases: null or empty text, or one without a letter of any script, is `und` with score 0; a text with letters and no hits
gets the smallest language by name, with score 0; of equal hits the smaller name is predicted. Without any
text to learn from all are `und`. A row with a null id is neither held out nor learned from. Repeated rows are separate documents; an empty table
gives an empty result; other columns are ignored. Languages are few: their names and totals reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down
from riskloom.llm.wordarrays import mix, slices, utf8

UNKNOWN = "und"
LENGTHS = (3, 4)
CHUNK = 1 << 13
_PLAIN = np.zeros(256, bool)  # ASCII letters
_PLAIN[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_WORD = _PLAIN.copy()
_WORD[0x80:] = True


def grams(text: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each length (row, hash) of the byte n-grams of words, in order; a gap may stand at an end, never inside."""
    data, at = utf8(pc.utf8_lower(pc.binary_join_element_wise(" ", pc.fill_null(text, ""), " ", "")))
    data = np.where(_WORD[data], data, 0x20).astype(np.uint64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    gaps = np.concatenate([[0], np.cumsum(data == 0x20)])
    out = []
    for n in LENGTHS:
        m = max(0, len(data) - n + 1)
        start = np.arange(m)
        inner = (gaps[start + n - 1] == gaps[start + 1]) & (row[start] == row[start + n - 1]) if m else np.zeros(0, bool)
        start = start[inner]
        value = np.full(len(start), n, np.uint64)
        for k in range(n):
            value = value * np.uint64(257) + data[start + k]
        out.append((row[start], mix(value)))
    return out


def places(value: np.ndarray, size: int, hashes: int) -> list[np.ndarray]:
    """The filter rows of each hash."""
    step = (value >> np.uint64(32)) | np.uint64(1)
    return [((value + np.uint64(k) * step) & np.uint64(size - 1)).astype(np.int64) for k in range(hashes)]


def counted(sample: DataFrame) -> DataFrame:
    """(gram, lang, n) over a table (text, lang)."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            langs = batch.column("lang").dictionary_encode()
            row, value = (np.concatenate(x) for x in zip(*grams(batch.column("text")), strict=True))
            unique, k = np.unique(value, return_inverse=True)
            key, n = np.unique(k * len(langs.dictionary) + np.asarray(langs.indices)[row], return_counts=True)
            names = langs.dictionary.take(pa.array(key % len(langs.dictionary)))
            yield pa.RecordBatch.from_arrays([pa.array(unique[key // len(langs.dictionary)].view(np.int64)), names, pa.array(n)], ["gram", "lang", "n"])

    return sample.mapInArrow(count, "gram long, lang string, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n"))


def bloom(kept: DataFrame, langs: list[str], size: int, hashes: int) -> np.ndarray:
    """The bit-sliced filter of (gram, langs): `size` rows of enough 64-bit words."""
    words, code = -(-len(langs) // 64), {x: k for k, x in enumerate(langs)}
    schema, names = "chunk int, bits binary", ["chunk", "bits"]

    def chunks(table: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(table), pa.int32()), pa.array([v.tobytes() for v in table.values()], pa.binary())], names)

    def insert(batches) -> Iterator[pa.RecordBatch]:
        table = np.zeros((size, words), np.uint64)
        for batch in batches:
            lists = batch.column("langs")
            count = np.diff(np.asarray(lists.offsets))
            k = np.array([code[x] for x in lists.flatten().to_pylist()], np.int64)
            value = np.repeat(np.asarray(batch.column("gram")).view(np.uint64), count)
            for at in places(value, size, hashes):
                np.bitwise_or.at(table, (at, k // 64), np.uint64(1) << (k % 64).astype(np.uint64))
        parts = {k: table[k * CHUNK : (k + 1) * CHUNK] for k in range(-(-size // CHUNK))}
        yield chunks({k: v for k, v in parts.items() if v.any()})

    def merge(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column("chunk").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                held[k] = held.get(k, 0) | np.frombuffer(raw, np.uint64)
        yield chunks(held)

    table = np.zeros((size, words), np.uint64)
    for r in kept.mapInArrow(insert, schema).repartition("chunk").mapInArrow(merge, schema).toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint64).reshape(-1, words)
        table[r["chunk"] * CHUNK : r["chunk"] * CHUNK + len(part)] = part
    return table


def bit_columns(masks: np.ndarray, n: int) -> np.ndarray:
    """The first n bits of each row of words, as columns of 0 and 1."""
    raw = masks.astype("<u8").view(np.uint8)[:, : -(-n // 8)]
    return np.unpackbits(raw, axis=1, bitorder="little")[:, :n]


class Filter:
    """A filter with the rate at which each language's slice errs."""

    def __init__(self, table: np.ndarray, langs: list[str], hashes: int):
        self.table, self.langs, self.hashes = table, langs, hashes
        fill = sum((bit_columns(table[k : k + CHUNK], len(langs)).sum(0, dtype=np.int64) for k in range(0, len(table), CHUNK)), np.zeros(len(langs), np.int64))
        self.errs = np.minimum((fill / max(1, len(table))) ** hashes, 0.999)

    def hits(self, found: list[tuple[np.ndarray, np.ndarray]], rows: int) -> np.ndarray:
        """Corrected hits of each text in each language."""
        hits, n = np.zeros((rows, len(self.langs))), np.zeros((rows, 1))
        for row, value in found:
            first, *rest = places(value, len(self.table), self.hashes)
            masks = self.table[first]
            for at in rest:
                masks &= self.table[at]
            begin = np.searchsorted(row, np.arange(rows + 1))
            some = begin[1:] > begin[:-1]
            if some.any():
                hits[some] += np.add.reduceat(bit_columns(masks, len(self.langs)), begin[:-1][some], axis=0, dtype=np.int64)
            n[:, 0] += np.diff(begin)
        return np.maximum((hits - self.errs * n) / (1 - self.errs), 0)


def learned(docs: DataFrame, most: int, share: float, least: int, hashes: int, bits: tuple[int, int]) -> Filter:
    """The filter from (doc_id, text, lang) rows that may be learned from."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes, key=str.encode)
    if not langs:
        return Filter(np.zeros((1, 1), np.uint64), [], hashes)
    cuts = docs.sparkSession.createDataFrame([(x, int(2**31 * most / n)) for x, n in sizes.items()], "lang string, cut long")
    sample = docs.join(F.broadcast(cuts), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(2**31)) < F.col("cut")).select("text", "lang")
    found = set_down(counted(sample), "language-grams")
    totals = found.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = found.join(F.broadcast(totals), "lang").withColumn("rate", F.col("n") / F.col("total"))
    chosen = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where((F.col("rate") >= share * F.col("top")) & (F.col("n") >= least))
    kept = set_down(chosen.groupBy("gram").agg(F.collect_set("lang").alias("langs")), "language-filter")
    size = 1 << min(max(math.ceil(math.log2(1 + 8 * kept.count())), bits[0]), bits[1])
    return Filter(bloom(kept, langs, size, hashes), langs, hashes)


def has_letter(text: pa.Array) -> np.ndarray:
    data, at = utf8(text)
    seen = np.concatenate([[0], np.cumsum(_PLAIN[data], dtype=np.int64)])
    out = seen[at[1:]] > seen[at[:-1]]
    for k in np.flatnonzero(~out & (np.diff(at) > 0)):
        out[k] = any(c.isalpha() for c in text[k].as_py())
    return out


def predicted(
    docs: DataFrame, most: int = 3_000, share: float = 0.5, least: int = 2, hashes: int = 3, bits: tuple[int, int] = (16, 22)
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document; learned from labelled documents that are not held out."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3))
    filter_ = learned(docs.where((rest != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()), most, share, least, hashes, bits)
    names = pa.array([*filter_.langs, UNKNOWN])

    def predict(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, text = batch.num_rows, batch.column("text")
            best, score = np.full(n, len(filter_.langs)), np.zeros(n)
            if filter_.langs:
                hits = filter_.hits(grams(text), n)
                lettered = has_letter(text)
                best = np.where(lettered, hits.argmax(1), best)
                total = hits.sum(1)
                score = np.where(lettered & (total > 0), hits.max(1) / np.where(total > 0, total, 1), 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), names.take(pa.array(best)), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"]
            )

    marked = docs.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "text")
    return marked.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")

