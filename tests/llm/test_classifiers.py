import zlib

import numpy as np
import pyarrow as pa
from riskloom.llm import ordinal, toxicity
from riskloom.llm.queries import QUERIES
from riskloom.llm.tables import DOCUMENT_COLUMNS, read

LABELS = "doc_id long, quality int, toxic int"
GOOD = "plain words about nothing in particular that run on for a while "
BAD = "!!! $$$ %%% BUY NOW &&& ### "


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_thresholds_are_ordered_and_grades_recovered():
    random = np.random.default_rng(0)
    x = random.normal(size=(3000, 6)).astype(np.float32)
    z = x @ np.array([2.0, -1.0, 0.5, 0, 0, 0]) + random.logistic(size=3000)
    grade = np.searchsorted([-2.0, 0.0, 1.5], z) * 10  # four grades: 0, 10, 20, 30
    model = ordinal.fit(x, grade)
    assert model.grades == [0, 10, 20, 30] and np.all(np.diff(model.threshold) < 0)
    assert np.allclose(model.threshold, [2.0, 0.0, -1.5], atol=0.3)
    assert np.allclose(model.weight[:3], [2.0, -1.0, 0.5], atol=0.3)
    tails = model.tails(x)
    assert np.all(np.diff(tails, axis=1) <= 0)
    assert np.abs(tails.mean(axis=0) - [(grade >= g).mean() for g in (10, 20, 30)]).max() < 0.02


def test_quality_on_the_sample(spark, sample):
    rows = {r.doc_id: r for r in QUERIES["op5_ordinal_quality"](spark, sample).collect()}
    labels = {r.doc_id: r.quality for r in read(spark, sample, "labels").collect()}
    assert len(rows) == read(spark, sample, "documents").count()
    assert np.mean([rows[i].kept == (q == 1) for i, q in labels.items() if i in rows]) > 0.97
    assert all(0 <= r.expected_grade <= 2 and r.kept == (r.tail_probability >= 0.5) for r in rows.values())


def test_toxicity_on_the_sample(spark, sample):
    rows = {r.doc_id: r for r in QUERIES["op7_subword_toxicity"](spark, sample).collect()}
    labels = {r.doc_id: r.toxic for r in read(spark, sample, "labels").collect() if r.doc_id in rows}
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    out = [(t, rows[i].score) for i, t in labels.items() if held(i)]
    bad, fine = [s for t, s in out if t], [s for t, s in out if not t]
    assert np.mean([[b > f for f in fine] for b in bad]) > 0.8  # the sample has some forty toxic texts to learn from


def test_labels_that_are_held_out_are_not_read(spark, make_docs):
    docs = make_docs([(i, GOOD + ("you moron scum" if i % 3 == 0 else "")) for i in range(90)])
    labels = [(i, 1, int(i % 3 == 0)) for i in range(90)]
    other = [(i, 1, 1 - t if held(i) else t) for i, _, t in labels]
    a, b = (toxicity.classified(docs, spark.createDataFrame(x, LABELS)).collect() for x in (labels, other))
    assert sorted(a) == sorted(b)


def test_misspelt_words_share_subwords():
    texts = [f"{GOOD} {w}{k}" for k, w in enumerate(["mororon", "moronic", "moron", "morons"] * 10)] + [f"{GOOD} tree{k}" for k in range(120)]
    model = toxicity.fit(toxicity.bags(pa.array(texts)), np.array([1] * 40 + [0] * 120))
    unseen, fine = toxicity.score(model, pa.array([f"{GOOD} xmorony", f"{GOOD} trees"]))
    assert unseen > 0.5 > fine


def test_awkward_texts_and_labels(spark, make_docs, awkward):
    docs = make_docs([*enumerate(awkward), *((100 + k, GOOD * 3) for k in range(9)), *((200 + k, BAD * 9) for k in range(9)), (None, "x"), (4, "a"), (4, "a")])
    labels = spark.createDataFrame(
        [*((100 + k, 1, 0) for k in range(9)), *((200 + k, 0, 1) for k in range(9)), (100, 1, 0), (None, 1, 1), (999, 0, 1), (3, None, None), (4, 7, 7)], LABELS
    )
    n = docs.count()
    quality = ordinal.classified(docs, labels).collect()
    assert len(quality) == n and {r.kept for r in quality if 100 <= (r.doc_id or 0) < 110} == {True}
    assert {r.kept for r in quality if (r.doc_id or 0) >= 200} == {False}
    toxic = toxicity.classified(docs, labels).collect()
    assert len(toxic) == n and all(0 <= r.score <= 1 for r in toxic)
    assert [r.held_out for r in toxic if r.doc_id is None] == [True]
    blank = {r.score for r in toxic if r.doc_id in (0, 1, 2, 3)}
    assert len(blank) == 1
    kept = ordinal.sound(docs, labels)
    assert kept.columns == DOCUMENT_COLUMNS
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in quality if r.kept)


def test_empty_tables(spark, make_docs):
    none = spark.createDataFrame([], LABELS)
    assert ordinal.classified(make_docs([]), none).count() == toxicity.classified(make_docs([]), none).count() == 0
    assert [r.kept for r in ordinal.classified(make_docs(["a"]), none).collect()] == [True]
    assert [r.score < 0.5 for r in toxicity.classified(make_docs(["a"]), none).collect()] == [True]
    one = spark.createDataFrame([(0, 1, 0)], LABELS)
    assert [r.kept for r in ordinal.classified(make_docs(["a"]), one).collect()] == [True]
