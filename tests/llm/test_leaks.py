import random
import re
from collections import Counter

import numpy as np
import pytest
from riskloom.llm import leaks
from riskloom.llm.queries import QUERIES
from riskloom.llm.tables import DOCUMENT_COLUMNS, read

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def bag(w):
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def brute(docs, items, percent=80):
    """Every place of every document against every item; an item reaches over the ends of a text as far as it must."""
    out = {}
    for i, text in docs:
        d = words(text)
        for j, passage in items:
            w = words(passage)
            if not w or not d:
                continue
            own = bag(w)
            vocabulary = set(w)
            for s in range(1 - len(w), len(d)):
                part = d[max(0, s) : s + len(w)]
                own_places = [k for k, x in enumerate(part) if x in vocabulary]
                if len(own_places) * 2 < len(w):
                    continue
                part = part[own_places[0] : own_places[-1] + 1]
                if (len(part) < 5) != (len(w) < 5):
                    continue
                other = bag(part)
                both = sum((own & other).values())
                like = both / (sum(own.values()) + sum(other.values()) - both)
                if 100 * like >= percent - 1e-9:
                    out[i, j] = max(like, out.get((i, j), 0))
    return out


def found(df):
    return {(r.doc_id, r.item_id): r.similarity for r in df.collect()}


def make(seed, items=12, docs=60):
    rng = random.Random(seed)
    bench = [(j, " ".join(f"b{j}w{rng.randrange(60)}" for _ in range(rng.choice([3, 5, 7, 14, 30, 60, 75])))) for j in range(items)]
    rows = []
    for i in range(docs):
        text = [f"t{rng.randrange(300)}" for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(0, 3)):
            passage = rng.choice(bench)[1].split()
            for _ in range(rng.randrange(0, 3)):
                k = rng.randrange(len(passage))
                change = rng.randrange(4)
                passage = [passage[:k] + ["new"] + passage[k + 1 :], passage[:k] + ["new"] + passage[k:], passage[: max(1, len(passage) - k % 5)], [p.upper() for p in passage]][change]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + passage + text[at:]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    return rows, bench


def every_stretch(docs, items, percent=80):
    """The best similarity of all stretches, of any first and last shingle, that begin with a shingle of the item."""
    out = {}
    for i, text in docs:
        d = words(text)
        for j, passage in items:
            w = words(passage)
            if not w or not d:
                continue
            n = min(5, len(w))
            own, m = Counter(tuple(w[k : k + n]) for k in range(len(w) - n + 1)), len(w) - n + 1
            shingles = [tuple(d[k : k + n]) for k in range(len(d) - n + 1)]
            for a in (k for k, x in enumerate(shingles) if x in own):
                seen, both = Counter(), 0
                for b in range(a, min(len(shingles), a + 100 * m // percent + 1)):
                    seen[shingles[b]] += 1
                    both += seen[shingles[b]] <= own[shingles[b]]
                    like = both / (m + b - a + 1 - both)
                    if 100 * like >= percent - 1e-9:
                        out[i, j] = max(like, out.get((i, j), 0))
    return out


def make_shared(seed, items=14, docs=60):
    """Items and documents over one small vocabulary; passages with words put in, or cut at an end, at any length."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(40)]
    bench = [(j, " ".join(rng.choices(vocabulary, k=rng.choice([3, 6, 14, 30, 45, 60, 90])))) for j in range(items)]
    rows = []
    for i in range(docs):
        text = rng.choices(vocabulary, k=rng.randrange(0, 60))
        passage = rng.choice(bench)[1].split()
        if i % 2:
            k = rng.randrange(len(passage))
            passage = passage[:k] + rng.choices(["new", *vocabulary], k=rng.randrange(1, 2 + len(passage) // 10)) + passage[k:]
        else:
            passage = passage[: len(passage) - rng.randrange(len(passage) // 5 + 1)]
        at = rng.randrange(len(text) + 1)
        rows.append((i, " ".join(text[:at] + passage + text[at:])))
    return rows, bench


def bench_table(spark, items):
    return spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_changed_passages_against_every_place(spark, make_docs, seed):
    """Stretches of the item's own length are a lower bound: the operator tries other lengths too."""
    rows, items = make(seed)
    got, want = found(leaks.leaks(make_docs(rows), bench_table(spark, items))), brute(rows, items)
    assert set(want) <= set(got) and len(want) > 20
    assert all(got[k] >= want[k] - 1e-9 for k in want)
    assert set(got) <= set(want) | set(every_stretch(rows, items))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_longer_and_shorter_passages_against_every_stretch(spark, make_docs, seed):
    rows, items = make_shared(seed)
    got, want = found(leaks.leaks(make_docs(rows), bench_table(spark, items))), every_stretch(rows, items)
    assert set(got) == set(want) and len(want) > 20
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_one_word_put_into_an_item(spark, make_docs):
    item = [f"w{k % 43}" for k in range(45)]
    docs = make_docs([" ".join(["start", *item[:k], "new", *item[k:], *item[:3], "end"]) for k in range(46)])
    got = found(leaks.leaks(docs, bench_table(spark, [(0, " ".join(item))])))
    assert len(got) == 46 and min(got.values()) == pytest.approx(37 / 46)


def test_sample(spark, sample):
    docs = [(r.doc_id, r.text) for r in read(spark, sample, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, sample, "benchmark").collect()]
    got = found(QUERIES["op10_benchmark_decontamination"](spark, sample))
    plain = {(i, j) for i, t in docs for j, p in items if " ".join(words(p)) in " ".join(words(t))}
    assert plain and plain <= set(got)


def test_lookup_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    bench = leaks.Benchmark([(k, " ".join(f"w{x}" for x in rng.integers(0, 500, 40))) for k in range(30)])
    w = bench.windows[0]
    query = w.value.copy()
    for _ in range(4):
        query ^= np.uint64(1) << rng.integers(0, 64, len(query)).astype(np.uint64)
    query = np.concatenate([query, rng.integers(0, 2**63, 500).astype(np.uint64), w.value])
    q, k = w.lookup(query, 3)
    near = np.bitwise_count(query[:, None] ^ w.value[None, :]) <= 3
    assert set(zip(q.tolist(), k.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_blocks_of_items_give_the_same(spark, make_docs):
    rows, items = make(4)
    table = bench_table(spark, items)
    assert found(leaks.leaks(make_docs(rows), table)) == found(leaks.leaks(make_docs(rows), table, most=300))
    assert len(list(leaks.benchmarks(table, most=300))) > 2


def test_awkward_rows_and_filter(spark, make_docs, awkward):
    awkward[-1] = awkward[-1][:9_000]
    items = [(0, None), (1, ""), (2, " \n"), (3, "one two three four"), (4, "one two three four"), (None, "dup line here\nother"), (5, awkward[-1])]
    docs = make_docs([*enumerate(awkward), (None, "ONE two  three\tfour"), (5, "one two three four")])
    got = Counter((r.doc_id, r.item_id) for r in leaks.leaks(docs, bench_table(spark, items)).collect())
    last = len(awkward) - 1
    want = Counter({(5, 3): 2, (5, 4): 2, (None, 3): 1, (None, 4): 1, (9, None): 1, (last, 5): 1})
    assert got == want
    rest = leaks.without_leaks(docs, bench_table(spark, items))
    assert rest.columns == DOCUMENT_COLUMNS
    assert Counter(r.doc_id for r in rest.collect()) == Counter(k for k in range(len(awkward)) if k not in (5, 9, last))


def test_empty_tables(spark, make_docs):
    assert leaks.leaks(make_docs([]), bench_table(spark, [(1, "a b c")])).count() == 0
    assert leaks.leaks(make_docs(["a b c"]), bench_table(spark, [])).count() == 0
    assert leaks.without_leaks(make_docs(["a b c"]), bench_table(spark, [])).count() == 1
