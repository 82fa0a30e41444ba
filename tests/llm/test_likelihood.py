import re
from collections import Counter

import numpy as np
import oracle
from riskloom.llm import likelihood
from riskloom.llm.queries import ORACLES, QUERIES
from riskloom.llm.tables import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rules(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    count = Counter(windows)
    hit = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(3)}
    n = len(words)
    out = (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))
    return (*out, n < 50 or 100 * len(hit) > 50 * n)


def columns(row):
    return (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words, row.base_failed)


def test_rules_and_labels_on_the_sample(spark, sample):
    rows = {r.doc_id: r for r in QUERIES["op2_quality_likelihood"](spark, sample).collect()}
    docs = {r.doc_id: r.text for r in read(spark, sample, "documents").collect()}
    assert {i: columns(r) for i, r in rows.items()} == {i: rules(t) for i, t in docs.items()}
    assert not any(r.kept and r.base_failed for r in rows.values())
    labels = {r.doc_id: r.quality for r in read(spark, sample, "labels").collect() if r.doc_id in rows}
    judged = [(labels[i], r.kept) for i, r in rows.items() if i in labels and not r.base_failed]
    assert np.mean([q == k for q, k in judged]) > 0.98


def test_awkward_texts(spark, make_docs, awkward):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (8, 0, 1), (None, 1, 0), (99, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    rows = [*enumerate(awkward), (None, "null id"), (4, "a"), (4, "a")]
    got = Counter((r.doc_id, *columns(r)) for r in likelihood.judged(make_docs(rows), labels).collect())
    assert got == Counter((i, *rules(t)) for i, t in rows)


def test_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert likelihood.judged(make_docs([]), labels).count() == 0
    text = " ".join(f"w{k}" for k in range(60))
    assert [r.kept for r in likelihood.judged(make_docs([text]), labels).collect()] == [True]


def test_score_is_the_mean_log_ratio(spark, make_docs):
    docs = make_docs(["b b a", "a"])
    target, raw = likelihood.multinomials(docs, spark.createDataFrame([(1,)], "doc_id long"), 10)
    assert raw.sum() == (3 + 2 + 4 + 3) + 1 and target.sum() == 1
    ratio = likelihood.log_ratio(target, raw)
    low, high = (r.score for r in likelihood.measured(docs, ratio, 10).orderBy("doc_id").collect())
    k = int(np.flatnonzero(target)[0])
    assert high == ratio[k] > low


def test_best_cut():
    assert likelihood.best_cut([(0.0, 0, 5), (1.0, 9, 0)], 0.3) == 0.5
    assert likelihood.best_cut([(0.0, 0, 5)], 0.3) == 0.3
    assert likelihood.best_cut([], 0.3) == 0.3


def test_blocks_of_trusted_ids_count_every_text_once(spark, make_docs):
    docs = make_docs([(k, f"w{k % 7} x{k} y") for k in range(40)] + [(None, "null id"), (3, "again")])
    trusted = spark.createDataFrame([(k,) for k in range(0, 40, 3)], "doc_id long")
    one, many = (likelihood.multinomials(docs, trusted, 12, blocks) for blocks in (1, 5))
    assert all((a == b).all() for a, b in zip(one, many, strict=True)) and one[0].sum() > 0


def test_rules_equal_sql(spark, sample):
    rows = QUERIES["quality_rules"](spark, sample).toArrow()
    assert oracle.difference(oracle.connect(sample), rows, ORACLES["quality_rules"]) is None
