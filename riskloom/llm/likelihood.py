"""Quality rules and a hashed n-gram likelihood ratio between trusted and raw text.

Two multinomials over hashed word and byte n-grams are counted with partial sums in every task: the raw one over the
whole corpus, the trusted one over all documents labelled 1. Documents and trusted ids are dealt into blocks by a hash of
the id, a block for every `block` trusted ids or so; one block's ids after the other are broadcast to the tasks that count
its documents. So the broadcast is bounded, every text is counted once, and no text is shuffled. A document's score is the mean log ratio of its n-grams, so
that length does not matter. Every document is judged by the same threshold: the middle of the best cut between the
labelled documents' scores. Nothing is drawn at random.

Defined cases: a null or empty text has no words and fails the rules; an n-gram that no trusted text has is smoothed by
`prior`; a document with several labels counts as trusted if one is 1; labels of unknown or null ids are ignored;
repeated rows are separate documents; without trusted text every score is 0; without
labels of both kinds the threshold is `default`; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.features import hashed
from riskloom.llm.tables import set_down, texts
from riskloom.llm.wordarrays import _SPACE, grams, inside, mix, prefix_hash, range_hash, slices, utf8, words

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
IN_WORDS, IN_BYTES = (1, 2), (2, 3)

RULES = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True


def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each row's stretch."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[at[1:]] - sums[at[:-1]]


def repeated_lines(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of each text, lines with a word that equal an earlier line."""
    cut = np.unique(np.concatenate([at, np.flatnonzero(data == 0x0A) + 1]))
    start, end = cut[:-1], cut[1:]
    row = np.searchsorted(at, start, side="right") - 1
    end = end - (data[np.maximum(end - 1, 0)] == 0x0A)  # without the line's end
    wordy = np.concatenate([[0], np.cumsum(~_SPACE[data], dtype=np.int64)])
    some = wordy[end] > wordy[start]
    start, end, row = start[some], end[some], row[some]
    value = range_hash(prefix_hash(data), start, end)
    unique = np.unique(mix(value + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    n = len(at) - 1
    return np.bincount(row, minlength=n) - np.bincount(row[unique], minlength=n)


def repeated_words(found, n: int, width: int = 3) -> np.ndarray:
    """Of each of n texts, words in windows of `width` words that the text has twice or more."""
    keep = np.flatnonzero(inside(found.row, width))
    value = grams(found.hash, width)[keep] + found.row[keep].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    _, back, count = np.unique(mix(value), return_inverse=True, return_counts=True)
    twice = keep[count[back] > 1]
    cover = np.zeros(len(found.row) + 1, np.int32)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + width, -1)
    return per_row(np.cumsum(cover[:-1]) > 0, found.first)


def multinomials(docs: DataFrame, trusted: DataFrame, bits: int, blocks: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Counts of hashed n-grams over the trusted texts and over all texts; `trusted` holds their doc_id once each."""
    of = F.pmod(F.xxhash64("doc_id"), F.lit(blocks))
    found = (block_counts(docs.where(of == k), F.broadcast(trusted.where(of == k)), bits) for k in range(blocks))
    return tuple(np.sum(x, axis=0) for x in zip(*found, strict=True))


def block_counts(docs: DataFrame, trusted: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(trusted, raw) counts of one block."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
        for batch in slices(batches):
            data, at = utf8(batch.column("text"))
            row, bucket = hashed(data, at, words(data, at), bits, IN_WORDS, IN_BYTES)
            raw += np.bincount(bucket, minlength=1 << bits)
            sure = np.asarray(batch.column("trusted").fill_null(False))
            target += np.bincount(bucket[sure[row]], minlength=1 << bits)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"])

    marked = texts(docs).join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left").select("text", "trusted")
    sums = marked.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(1 << bits), np.zeros(1 << bits)
    for r in sums.collect():  # at most 2**bits rows
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    return target, raw


def log_ratio(target: np.ndarray, raw: np.ndarray, prior: float = 1.0) -> np.ndarray:
    if not target.any():
        return np.zeros(len(raw))  # nothing is trusted: no text is more like it than another
    t, r = target + prior, raw + prior
    return np.log(t / t.sum()) - np.log(r / r.sum())


def measured(docs: DataFrame, ratio: np.ndarray, bits: int) -> DataFrame:
    """The rules' counts and the score of every document."""

    def measure(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, at = utf8(batch.column("text"))
            found, n = words(data, at), batch.num_rows
            row, bucket = hashed(data, at, found, bits, IN_WORDS, IN_BYTES)
            total = np.bincount(row, weights=ratio[bucket], minlength=n)
            columns = [
                np.diff(found.first), per_row(~_SPACE[data] & ((data & 0xC0) != 0x80), at), per_row(_SYMBOL[data], at),
                repeated_lines(data, at), repeated_words(found, n), total / np.maximum(np.bincount(row, minlength=n), 1),
            ]
            names = [x.split()[0] for x in RULES.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], names)

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return texts(docs).mapInArrow(measure, RULES).withColumn("base_failed", failed)


def best_cut(bins: list[tuple[float, int, int]], default: float) -> float:
    """The middle of the widest cut with fewest errors, from (score, labelled 1, labelled 0) bins."""
    bins = sorted(bins)
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    if not good or not bad:
        return default
    # Errors of a cut below bin k, above all bins before it; both kinds weigh alike whatever their numbers.
    below_good = np.concatenate([[0], np.cumsum([b[1] for b in bins])]) / good
    below_bad = np.concatenate([[0], np.cumsum([b[2] for b in bins])]) / bad
    errors = below_good + 1 - below_bad
    edges = np.array([bins[0][0] - 1] + [b[0] for b in bins] + [bins[-1][0] + 1])
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    k = max(least, key=lambda i: (edges[i + 1] - edges[i], -i))
    return float((edges[k] + edges[k + 1]) / 2)


def judged(
    docs: DataFrame, labels: DataFrame, bits: int = 16, default: float = -0.2, digits: int = 3, block: int = 2_000_000
) -> DataFrame:
    """Every document with its counts, score, `base_failed` and `kept`."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    trusted = known.where("quality = 1").select("doc_id")
    target, raw = multinomials(texts(docs), trusted, bits, max(1, -(-trusted.count() // block)))
    scored = set_down(measured(docs, log_ratio(target, raw), bits), "likelihood")
    passed = scored.where(~F.col("base_failed")).join(known, "doc_id")
    good = F.sum((F.col("quality") == 1).cast("long"))
    bins = passed.groupBy(F.round("score", digits).alias("at")).agg(good.alias("good"), F.count(F.lit(1)).alias("n")).collect()
    cut = best_cut([(r["at"], r["good"], r["n"] - r["good"]) for r in bins], default)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= F.lit(cut)))
