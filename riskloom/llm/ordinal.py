"""Ordinal regression of graded ratings on hashed text: one weight for each bucket, shared by all grades, and ordered
thresholds (cumulative logit).

P(grade >= k) = sigmoid(w.x + c_k) with c_1 > c_2 > ... The thresholds are kept in order by fitting the logarithms of their
gaps. Features are the hashed word and byte n-grams of the whole text and two buckets for repetition (a word that equals
the one before it, words of repeated three-word windows), as square roots of shares; `smooth` n-grams more in every text
draw short ones towards the mean. The weights are fitted in numpy on the driver, on at most `most` rated documents, those
with the smallest hash of their id; every document is scored where it lies.

Defined cases: a null or empty text has no features and gets the thresholds' own probabilities; ratings of unknown or null
ids are ignored; of several ratings of a document the highest counts; without two grades every document is kept with
probability 1; repeated rows are separate documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.features import hashed
from riskloom.llm.likelihood import repeated_words
from riskloom.llm.tables import DOCUMENT_COLUMNS, texts
from riskloom.llm.wordarrays import slices, utf8, words

BITS, SMOOTH = 11, 40.0
IN_WORDS, IN_BYTES = (1,), (1, 2, 3)


class Model(NamedTuple):
    grades: list[int]
    weight: np.ndarray
    threshold: np.ndarray

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= each grade but the lowest), one column each."""
        return sigmoid((x @ self.weight)[:, None] + self.threshold)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def featurise(column: pa.Array) -> np.ndarray:
    """A row of 2**BITS + 2 features for each text."""
    data, at = utf8(column)
    found, n = words(data, at), len(at) - 1
    row, bucket = hashed(data, at, found, BITS, IN_WORDS, IN_BYTES)
    counts = np.bincount(row.astype(np.int64) * (1 << BITS) + bucket, minlength=n << BITS).reshape(n, 1 << BITS)
    shares = counts / (counts.sum(axis=1, keepdims=True) + SMOOTH)
    same = np.zeros(len(found.hash), bool)
    same[1:] = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    length = np.diff(found.first) + SMOOTH / 4
    again = np.stack([np.bincount(found.row[same], minlength=n) / length, repeated_words(found, n) / length], axis=1)
    return np.sqrt(np.concatenate([shares, again], axis=1)).astype(np.float32)


def fit(x: np.ndarray, grade: np.ndarray, steps: int = 500, rate: float = 0.1, decay: float = 1e-5) -> Model:
    """Maximum likelihood by full gradient steps (Adam); the same input gives the same model."""
    grades = sorted(set(grade.tolist()))
    g = np.searchsorted(grades, grade)
    k, d, n = len(grades), x.shape[1], len(x)
    share = np.array([(g >= j).mean() for j in range(1, k)])
    start = np.log(share / (1 - share))
    par = np.concatenate([np.zeros(d), start[:1], np.log(np.maximum(-np.diff(start), 1e-2))])
    first, second = np.zeros_like(par), np.zeros_like(par)

    def thresholds() -> np.ndarray:
        return np.concatenate([par[d : d + 1], par[d] - np.cumsum(np.exp(par[d + 1 :]))])

    for step in range(1, steps + 1):
        c = thresholds()
        z = (x @ par[:d].astype(np.float32)).astype(np.float64)
        tail = np.concatenate([np.ones((n, 1)), sigmoid(z[:, None] + c), np.zeros((n, 1))], axis=1)
        high, low = np.take_along_axis(tail, g[:, None], 1)[:, 0], np.take_along_axis(tail, g[:, None] + 1, 1)[:, 0]
        p = np.maximum(high - low, 1e-9)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_c = np.array([d_low[g == j].sum() - d_high[g == j + 1].sum() for j in range(k - 1)]) / n
        d_z = ((d_low - d_high) / n).astype(np.float32)
        slope = np.concatenate(
            [d_z @ x + decay * par[:d], [d_c.sum()], [-d_c[j + 1 :].sum() * np.exp(par[d + 1 + j]) for j in range(k - 2)]]
        )
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        par -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(grades, par[:d].astype(np.float32), thresholds())


def trained(docs: DataFrame, ratings: DataFrame, most: int = 6_000, longest: int = 1 << 20) -> Model | None:
    """`ratings`: (doc_id, grade). Fitted on at most `most` documents of at most `longest` code points."""
    rated = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)

    def features(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [row.tobytes() for row in featurise(batch.column("text")).astype(np.float16)]
            yield pa.RecordBatch.from_arrays([batch.column("grade"), pa.array(x, pa.binary())], ["grade", "x"])

    joined = texts(docs).where(F.length("text") <= longest).join(F.broadcast(chosen), "doc_id").select("grade", "text")
    rows = joined.mapInArrow(features, "grade int, x binary").toArrow()
    grade = np.asarray(rows["grade"].combine_chunks())
    if len(set(grade.tolist())) < 2:
        return None
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(len(grade), -1).astype(np.float32)
    order = np.lexsort((*(x[:, j] for j in range(8)), grade))  # the same rows in the same order, however they arrived
    return fit(x[order], grade[order])


def scored(docs: DataFrame, model: Model | None, at_least: int, least: float = 0.5) -> DataFrame:
    """(doc_id, expected_grade, tail_probability, kept): kept if P(grade >= at_least) reaches `least`."""

    def score(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            grade, tail = judge(model, batch.column("text"), at_least)
            columns = [batch.column("doc_id"), pa.array(grade), pa.array(tail), pa.array(tail >= least)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", "tail_probability", "kept"])

    return texts(docs).mapInArrow(score, "doc_id long, expected_grade double, tail_probability double, kept boolean")


def judge(model: Model | None, column: pa.Array, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade and P(grade >= at_least) of each text."""
    if model is None:
        return np.full(len(column), float(at_least)), np.ones(len(column))
    tails = model.tails(featurise(column)).astype(np.float64)
    steps = np.diff(model.grades)
    above = [j for j, grade in enumerate(model.grades[1:]) if grade >= at_least]
    tail = np.ones(len(column)) if model.grades[0] >= at_least else tails[:, above[0]] if above else np.zeros(len(column))
    return model.grades[0] + tails @ steps, tail


def rating(quality: Column, toxic: Column) -> Column:
    """Three grades from the two labels: 0 poor, 1 sound but toxic, 2 sound."""
    return F.when(quality == 0, 0).when(quality == 1, F.when(toxic == 1, 1).otherwise(2))


def ratings(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), rating(F.col("quality"), F.col("toxic")).alias("grade"))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with its expected grade, the probability of a sound grade, and whether it is kept."""
    return scored(docs, trained(docs, ratings(labels)), at_least=1)


def sound(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents that the classifier keeps, with the columns of `documents`."""
    model = trained(docs, ratings(labels))

    def keep(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(judge(model, batch.column("text"), 1)[1] >= least))

    docs = docs.select(DOCUMENT_COLUMNS)
    return docs.mapInArrow(keep, docs.schema)
