import hashlib
import math

import numpy as np
import oracle
import pytest
from riskloom.llm import vectors
from riskloom.llm.queries import ORACLES, QUERIES


def brute(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) of (vec_id, vector, label) rows, one part after the other."""
    kept = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    w = len(kept[0][1]) // parts
    books = [[v[p * w : (p + 1) * w] for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(v, p):
        part = v[p * w : (p + 1) * w]
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        sums = {}
        for _, v, _ in kept:
            for p in range(parts):
                sums.setdefault((p, near(v, p)[1]), []).append(v[p * w : (p + 1) * w])
        for (p, k), some in sums.items():
            books[p][k] = [sum(c) // len(some) for c in zip(*some, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = [(i, [near(v, p) for p in range(parts)], g) for i, v, g in kept]
    totals = {}
    for _, c, g in coded:
        totals[g] = totals.get(g, 0) + sum(d for d, _ in c)
    return sorted(((i, "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), totals[g], sha) for i, c, g in coded), key=str)


def table(spark, rows):
    full = [(i, v, g, "x", "y") for i, v, g in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<double>, label int, code string, error string")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("shift", [0, 2, 5])
def test_against_every_entry(spark, shift):
    random = np.random.default_rng(shift)
    rows = [(k * 7 % 400, (random.normal(size=32) * 0.1).tolist(), k % 4 if k % 5 else None) for k in range(400)]
    assert found(vectors.coded(table(spark, rows), shift=shift, keep=60)) == brute(rows)


def test_cells_keep_every_entry_that_can_be_nearest():
    random = np.random.default_rng(5)
    book = random.integers(-60, 60, (64, 4))
    parts = random.integers(-200, 200, (3_000, 4))
    far = ((parts[:, None, :] - book) ** 2).sum(2)
    for keep in (100_000, 7):
        cells = vectors.Cells(book, 3, keep)
        for k in range(0, len(parts), 500):
            entry, distance = cells.nearest(parts[k : k + 500])
            assert (entry == far[k : k + 500].argmin(1)).all() and (distance == far[k : k + 500].min(1)).all()
    wide = vectors.Cells(book, 3, 100_000)
    wide.nearest(parts)
    assert wide.size.mean() < 40  # most entries are dominated


def test_cells_of_one_hash(monkeypatch):
    random = np.random.default_rng(6)
    monkeypatch.setattr(vectors, "mix", lambda v: v % np.uint64(3))
    book, parts = random.integers(-60, 60, (64, 4)), random.integers(-90, 90, (500, 4))
    entry, _ = vectors.Cells(book, 3, 1000).nearest(parts)
    assert (entry == ((parts[:, None, :] - book) ** 2).sum(2).argmin(1)).all()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.1 * k for k in range(16)]
    rows = [
        (5, v, 1), (5, v, 1), (5, [-x for x in v], 1), (None, v[::-1], None), (3, None, 2), (4, [*v[:15], None], 2), (6, [*v[:15], nan], 2),
        (7, [*v[:15], -inf], None), (8, [0.0] * 16, None), (9, [-0.0] * 16, 7), (2, [-1e-9] * 16, 7),
    ]
    assert found(vectors.coded(table(spark, rows))) == brute(rows)
    other = [*rows, (1, [], 1), (10, [1.0] * 32, 1), (0, [1.0] * 15, 1)]
    assert found(vectors.coded(table(spark, other))) == brute(rows)
    assert vectors.coded(table(spark, [])).collect() == []
    assert vectors.coded(table(spark, [(1, None, 1)])).collect() == []
    with pytest.raises(Exception, match="65536"):
        vectors.coded(table(spark, [(1, [1e6] * 16, 1)])).collect()


def test_sample_equals_sql(spark, sample):
    rows = QUERIES["op12_vector_codes"](spark, sample).toArrow()
    assert oracle.difference(oracle.connect(sample), rows, ORACLES["op12_vector_codes"]) is None
