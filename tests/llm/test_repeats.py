import hashlib
import random
from collections import Counter

import numpy as np
from riskloom.llm import repeats
from riskloom.llm.queries import QUERIES
from riskloom.llm.tables import read


def brute(rows, width=400):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(d[s : s + width] for _, d in data for s in range(len(d) - width + 1))
    out = Counter()
    for i, d in data:
        cover = np.zeros(len(d) + 2, int)
        for s in range(len(d) - width + 1):
            if seen[d[s : s + width]] > 1:
                cover[s + 1] += 1
                cover[s + 1 + width] -= 1
        gone = np.cumsum(cover)[1:-1] > 0 if len(d) else np.zeros(0, bool)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        out[i, len(d), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest()] += 1
    return out


def found(df):
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


def passages(seed, width, docs=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeéß", k=rng.randrange(1, 8)))
    shared = [" ".join(word() for _ in range(rng.randrange(20, 200))) for _ in range(6)]
    out = []
    for _ in range(docs):
        parts = []
        for _ in range(rng.randrange(0, 5)):
            if rng.random() < 0.5:
                p = rng.choice(shared)
                a = rng.randrange(len(p))
                parts.append(p[a : a + rng.randrange(1, 3 * width)])
            else:
                parts.append(" ".join(word() for _ in range(rng.randrange(0, 120))))
        out.append("".join(parts))
    return [*out, out[3], "ab" * 700, "z" * 900, "z" * width, "z" * (width - 1)]


def test_planted_passages(spark, make_docs):
    for seed in (1, 2):
        rows = list(enumerate(passages(seed, 400)))
        assert found(repeats.without_repeats(make_docs(rows))) == brute(rows)


def test_awkward_texts(spark, make_docs, awkward):
    rows = [*enumerate(awkward), (None, "q" * 500), (None, "q" * 500), (3, "twice" * 90), (3, "twice" * 90), (50, awkward[-1][:5000])]
    assert found(repeats.without_repeats(make_docs(rows))) == brute(rows)


def test_sample(spark, sample):
    rows = [(r.doc_id, r.text) for r in read(spark, sample, "documents").collect()]
    assert found(QUERIES["op3_suffix_dedup"](spark, sample)) == brute(rows)


def test_empty_table(spark, make_docs):
    assert repeats.without_repeats(make_docs([])).count() == 0


def test_smallest_of_neighbours():
    rng = np.random.default_rng(5)
    for n, w in ((3, 3), (500, 1), (500, 7), (500, 100)):
        values = rng.integers(0, 9, n).astype(np.uint64) << np.uint64(40)
        want = [a + int(np.argmin(values[a : a + w])) for a in range(n - w + 1)]
        assert repeats.smallest(values, w).tolist() == want


def test_anchors_go_on_over_chunks(monkeypatch):
    data = np.frombuffer(random.Random(4).randbytes(3000) + b"z" * 900, np.uint8)
    whole = repeats.anchors(data, 80)[1]
    for chunk in (64, 512, 1024):
        monkeypatch.setattr(repeats, "CHUNK", chunk)
        assert [c.tolist() for c in repeats.anchors(data, 80)[1]] == [c.tolist() for c in whole]


def test_narrow_widths(spark, make_docs):
    rows = list(enumerate(passages(3, 40)))
    for width in (1, 3, 40):
        assert found(repeats.without_repeats(make_docs(rows), width)) == brute(rows, width)


def test_text_longer_than_a_chunk(spark, make_docs):
    rng = random.Random(8)
    long = "".join(rng.choices("abcdefgh ", k=repeats.CHUNK + 5000))
    edge = repeats.CHUNK
    rows = [(1, long), (2, "x" + long[edge - 700 : edge + 700] + "y"), (3, long[edge - 200 : edge + 200]), (4, long[edge - 60 : edge + 339])]
    assert found(repeats.without_repeats(make_docs(rows))) == brute(rows)


def test_passage_in_every_text_fills_several_tasks(spark, make_docs):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    shared = " ".join(word() for _ in range(55))
    texts = [" ".join(word() for _ in range(60)) + shared + " ".join(word() for _ in range(60)) for _ in range(300)]
    rows = list(enumerate(texts))
    assert found(repeats.without_repeats(make_docs(rows))) == brute(rows)
    # One name, many rows: the order goes on by text, so no task gets them all, and rows at the edges of tasks count.
    hot = spark.range(20_000).selectExpr("if(id % 10 = 0, id, 7L) as name", "id as t", "0 as start", "1 as stop", "true as wanted")
    spread = hot.repartitionByRange(8, "name", "t", "start").where("name = 7").groupBy(repeats.F.spark_partition_id()).count()
    assert spread.agg({"count": "max"}).first()[0] < 5000
    assert repeats.neighbours(hot).count() == 18_000
    assert repeats.neighbours(hot.where("t = 1").unionAll(hot.where("t = 1"))).count() == 0


def test_only_texts_with_shared_anchors_are_shuffled(spark, make_docs, monkeypatch):
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcdefgh ", k=600)) for _ in range(400)]
    texts[7] = texts[3][:550] + "!" + texts[7][:80]
    rows = [*enumerate(texts), (400, texts[5]), (401, texts[5])]
    passed = []
    undecided = repeats.undecided
    monkeypatch.setattr(repeats, "undecided", lambda docs, *a: passed.append(docs.distinct().count()) or undecided(docs, *a))
    assert found(repeats.without_repeats(make_docs(rows))) == brute(rows)
    assert 2 <= passed[0] <= 5  # those that share a part; whole copies are told by their hash


def test_bitmap_rules_out_no_key(spark):
    docs = spark.range(50_000).select(repeats.F.xxhash64("id").alias("t"), "id")
    told = repeats.possible(docs, docs.where("id % 10 = 3").select("t"))
    assert told.where("possible and id % 10 = 3").count() == 5_000
    assert told.where("possible").count() < 5_050
    assert repeats.possible(docs, docs.limit(0)).where("possible").count() == 0
