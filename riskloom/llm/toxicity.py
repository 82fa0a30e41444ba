"""Toxicity: embeddings of subwords, averaged over a text, into a linear softmax, trained together in numpy.

A word is its own bucket and those of its character n-grams (in UTF-8 bytes, with marks for its ends), so that an unseen
misspelling shares most vectors with the word it hides. A text is the mean of its words' means. Embeddings and softmax
are fitted together on the driver, on at most `most` labelled documents (smallest hash of the id), as (text, word, count)
and (word, bucket) lists. Since the model is linear after the embedding, a bucket's part in the score is one number, and
scoring needs one lookup for each subword of each distinct word.

Labels of documents with crc32(doc_id) mod 5 = 0 are never read for the fit. Scores use nothing but the text.

Defined cases: a null, empty or blank text gets the share of label 1 in training; labels of unknown or null ids are
ignored; of several labels of a document the highest counts; with no label 1 or no label 0 every score is the share of
label 1 (0 without labels); a null id is held out; repeated rows are scored alike; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.features import byte_grams
from riskloom.llm.packing import ragged
from riskloom.llm.tables import texts
from riskloom.llm.wordarrays import _LOWER, mix, slices, utf8, words

BITS, GRAMS = 20, (3, 4, 5, 6)


class Model(NamedTuple):
    part: np.ndarray  # what each bucket adds to the log odds
    bias: float
    empty: float  # the score of a text without words


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def subwords(data: np.ndarray, start: np.ndarray, end: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of word, bucket) of every subword of the words that begin at `start`; `value` has the words' hashes."""
    size = end - start
    at = np.concatenate([[0], np.cumsum(size + 2)])
    marked = np.zeros(at[-1], np.uint8)
    marked[at[:-1]], marked[at[1:] - 1] = 0x02, 0x03  # marks for the ends of a word
    marked[ragged(at[:-1] + 1, size)] = _LOWER[data[ragged(start, size)]]
    parts = [byte_grams(marked, at, n) for n in GRAMS]
    row = np.concatenate([np.arange(len(start), dtype=np.int32), *(r for r, _ in parts)])
    shift = np.uint64(64 - BITS)
    return row, np.concatenate([(h >> shift).astype(np.int32) for h in (mix(value), *(h for _, h in parts))])


class Bags(NamedTuple):
    """Texts as (row, word, share of the text's words), words as (word, bucket, share of the word's subwords)."""

    n: int
    row: np.ndarray
    word: np.ndarray
    share: np.ndarray
    of_word: np.ndarray
    bucket: np.ndarray
    part: np.ndarray


def bags(column: pa.Array) -> Bags:
    data, at = utf8(column)
    found, n = words(data, at, lower=True), len(at) - 1
    unique, where, back = np.unique(found.hash, return_index=True, return_inverse=True)
    pair, count = np.unique(found.row * max(1, len(unique)) + back, return_counts=True)
    row, word = np.divmod(pair, max(1, len(unique)))
    of_word, bucket = subwords(data, found.start[where], found.end[where], unique)
    size = np.bincount(of_word, minlength=len(unique))
    return Bags(n, row, word, count / np.diff(found.first)[row], of_word, bucket, (1 / np.maximum(size, 1)).astype(np.float32)[of_word])


class Sums:
    """Sums of rows by an index, for many value tables with the same index."""

    def __init__(self, index: np.ndarray, n: int):
        self.order, self.n = np.argsort(index, kind="stable"), n
        self.present, self.first = np.unique(index[self.order], return_index=True)

    def __call__(self, values: np.ndarray, rows: np.ndarray, scale: np.ndarray) -> np.ndarray:
        """Sums of values[rows] * scale."""
        out = np.zeros((self.n, values.shape[1]), values.dtype)
        if len(self.first):
            picked = values[rows[self.order]]
            picked *= scale[self.order, None]
            out[self.present] = np.add.reduceat(picked, self.first, axis=0)
        return out


def fit(b: Bags, label: np.ndarray, width: int = 4, steps: int = 50, rate: float = 0.1, decay: float = 1e-3, telling: float = 5.0) -> Model:
    """Full gradient steps (Adam) on embeddings, softmax and bias together; the same input gives the same model.

    Buckets that are met about as often under either label (within `telling` standard errors) keep a vector of zero.
    """
    share = float(label.mean()) if len(label) else 0.0
    part = np.zeros(1 << BITS, np.float32)
    if share in (0.0, 1.0):
        return Model(part, float(np.log((share + 1e-9) / (1 - share + 1e-9))), share)
    n_words = 1 + int(b.word.max(initial=0))
    # Words met in texts of either label, and from them how far each bucket's share differs, in standard errors.
    held = [np.bincount(b.word[label[b.row] == y], minlength=n_words).astype(np.float64) for y in (0, 1)]
    met = [np.bincount(b.bucket, weights=n[b.of_word], minlength=1 << BITS) for n in held]
    size = [max(1.0, n.sum()) for n in held]
    both = (met[0] + met[1]) / (size[0] + size[1])
    differs = np.abs(met[1] / size[1] - met[0] / size[0]) >= telling * np.sqrt(both * (1 / size[0] + 1 / size[1]))
    some = (differs & (both > 0))[b.bucket]
    of_word, in_word = b.of_word[some], b.part[some]
    used, bucket = np.unique(b.bucket[some], return_inverse=True)
    in_text = b.share.astype(np.float32)
    to_word, to_text = Sums(of_word, n_words), Sums(b.row, b.n)
    from_text, from_word = Sums(b.word, n_words), Sums(bucket, len(used))
    random = np.random.default_rng(7)
    par = [random.normal(0, 0.1, (len(used), width)), random.normal(0, 0.5, (width, 2)), np.zeros(2)]
    par = [p.astype(np.float32) for p in par]
    first, second = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) / len(label)  # both kinds weigh alike
    for step in range(1, steps + 1):
        text = to_text(to_word(par[0], bucket, in_word), b.word, in_text)
        z = text @ par[1] + par[2]
        error = ((sigmoid(z[:, 1] - z[:, 0]) - label) * weight).astype(np.float32)
        d_z = np.stack([-error, error], axis=1)
        d_word = from_text(d_z @ par[1].T, b.row, in_text)
        slopes = [from_word(d_word, of_word, in_word), text.T @ d_z, d_z.sum(axis=0)]
        for k, slope in enumerate(slopes):
            first[k], second[k] = 0.9 * first[k] + 0.1 * slope, 0.999 * second[k] + 0.001 * slope**2
            change = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-9)
            par[k] = par[k] - np.float32(rate) * (change + decay * par[k] if k == 0 else change).astype(np.float32)
    part[used] = par[0] @ (par[1][:, 1] - par[1][:, 0])
    return Model(part, float(par[2][1] - par[2][0]), share)


def score(model: Model, column: pa.Array) -> np.ndarray:
    b = bags(column)
    of_words = np.bincount(b.of_word, weights=model.part[b.bucket] * b.part, minlength=1)
    z = np.bincount(b.row, weights=of_words[b.word] * b.share, minlength=b.n) + model.bias
    blank = np.bincount(b.row, minlength=b.n) == 0
    return np.where(blank, model.empty, sigmoid(z))


def held_out():
    """Whether a document's label must not be learnt from; a null id is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def trained(docs: DataFrame, labels: DataFrame, most: int = 3_000, longest: int = 1 << 17) -> Model:
    """Fitted on at most `most` labelled documents, of at most `longest` code points, that are not held out."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = ids.where(~held_out() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    sample = texts(docs).where(F.length("text") <= longest).join(F.broadcast(chosen), "doc_id")
    rows = sample.select("doc_id", "toxic", "text").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
    return fit(bags(rows["text"].combine_chunks()), np.asarray(rows["toxic"].combine_chunks()))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def apply(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score(model, batch.column("text")))], ["doc_id", "score"])

    out = texts(docs).mapInArrow(apply, "doc_id long, score double")
    return out.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, trained(docs, labels))
