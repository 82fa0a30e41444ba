import random
import re
from itertools import combinations

import numpy as np
import pytest
from riskloom.llm import jaccard
from riskloom.llm.components import components
from riskloom.llm.queries import QUERIES
from riskloom.llm.tables import read

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set())


def brute(rows):
    """doc_id -> (set size, smallest linked doc_id), comparing sets that share a shingle."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    lists = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            lists.setdefault(x, []).append(k)
    pairs = {p for x in lists.values() for p in combinations(x, 2)}
    for a, b in pairs:
        (i, s), (j, t) = sets[a], sets[b]
        if 100 * len(s & t) >= 80 * len(s | t) and top(i) != top(j):
            up[max(top(i), top(j))] = min(top(i), top(j))
    return sorted((i, len(s), top(i)) for i, s in sets)


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def near_copies(seed, families, copies, words=60):
    """Families of texts with a few words changed, at about the threshold, with a passage that all share."""
    rng = random.Random(seed)
    out, common = [], " ".join(f"c{k}" for k in range(12))
    for f in range(families):
        base = [f"f{f}w{rng.randrange(500)}" for _ in range(rng.randrange(8, words))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 4)):
                text[rng.randrange(len(text))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.2:
                text = text[: rng.randrange(1, len(text) + 1)]
            out.append(" ".join(text) + (" " + common if rng.random() < 0.3 else ""))
    rng.shuffle(out)
    return out


def test_sample(spark, sample):
    docs = [(r.doc_id, r.text) for r in read(spark, sample, "documents").collect()]
    assert found(QUERIES["op6_jaccard_join"](spark, sample)) == brute(docs)


@pytest.mark.parametrize("most", [1_000_000, 700])
def test_near_copies_and_small_blocks(spark, make_docs, most):
    rows = list(enumerate(near_copies(3, 25, 12)))
    assert found(jaccard.groups(make_docs(rows), most=most)) == brute(rows)


def test_long_lists_are_salted(spark, make_docs, monkeypatch):
    rows = list(enumerate(near_copies(5, 4, 60)))
    docs = make_docs(rows)
    _, sketch = jaccard.described(docs, 5)
    nodes = jaccard.described(docs, 5)[0].where("node is not null").groupBy("node").agg({"doc_id": "min", "n_shingles": "first"}).toDF("node", "doc_id", "n_shingles")
    whole = jaccard.candidate_edges(jaccard.postings(docs, 5, 80, sketch, 1 << 30), 80)
    salted = jaccard.candidate_edges(jaccard.postings(docs, 5, 80, sketch, 0), 80)
    same = [sorted(map(tuple, components(e).collect())) for e in (whole, salted)]
    assert same[0] == same[1] and nodes.count() >= len(same[0]) > 0


def test_awkward_texts(spark, make_docs, awkward):
    rows = [*enumerate(awkward), (100, "A b C"), (101, "a B c"), (100, "A b C"), (None, "a b c"), (102, "a b c d e"), (103, "a b c d")]
    got = found(jaccard.groups(make_docs([r for r in rows if r[0] is not None])))
    plain = sorted({*brute([r for r in rows if r[0] is not None])})
    assert sorted(set(got)) == plain and len(got) == len(rows) - 1
    nulls = [r for r in jaccard.groups(make_docs(rows)).collect() if r.doc_id is None]
    assert [(r.n_shingles, r.component_id) for r in nulls] == [(1, None)]


def test_empty_table(spark, make_docs):
    assert jaccard.groups(make_docs([])).count() == 0


def test_search_finds_what_counting_finds():
    rng = np.random.default_rng(7)
    base = [np.unique(rng.integers(0, 4000, 80)) for _ in range(6)]
    sets = []
    for _ in range(200):
        s = set(base[rng.integers(6)].tolist())
        s -= set(rng.choice(sorted(s), rng.integers(0, 14), replace=False).tolist())
        sets.append(sorted(s | set(rng.integers(0, 4000, rng.integers(0, 6)).tolist())))
    sets.sort(key=len)
    index = jaccard.Index(80)
    for k, s in enumerate(sets):
        like = {j for j in range(k) if 100 * len({*s} & {*sets[j]}) >= 80 * len({*s} | {*sets[j]})}
        assert set(index.search(s, len(s))) == like
        index.add(s, len(s))


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 200), (7, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 140)}


def test_one_of_each_keeps_the_other_text_of_an_id(spark, make_docs):
    a, b = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    rows = [(1, a), (2, a + " more"), (2, b), (3, b), (4, a), (1, a + " again"), (5, "")]
    left = sorted((r.doc_id, r.text) for r in jaccard.one_of_each(make_docs(rows)).collect())
    # Of the group of a one of the two texts of document 1 stays; of the group of b document 2's text.
    assert len(left) == 3 and left[0][0] == 1 and left[0][1].startswith(a) and left[1:] == [(2, b), (5, "")]


def test_shared_passages_tie_nothing(spark, make_docs):
    """Under a sketch that tells no shingle from another, sets that share less than similar ones must are in no block."""
    rng, k = random.Random(11), 0
    passages = [" ".join(f"p{p}w{i}" for i in range(9)) for p in range(4)]
    apart, near = [], near_copies(13, 6, 8)
    for _ in range(120):
        own = [f"u{(k := k + 1)}" for _ in range(rng.randrange(60, 90))]
        apart.append(" ".join([*own[:20], rng.choice(passages), *own[20:]]))
    rows = list(enumerate(apart + near))
    docs = make_docs(rows)
    sets, _ = jaccard.described(docs, 5)
    node = {r.doc_id: r.node for r in sets.collect()}
    for hot in (1 << 30, -1):
        edges = jaccard.candidate_edges(jaccard.postings(docs, 5, 80, np.zeros(1 << 14, np.int32), hot), 80)
        block = {r.node: r.label for r in components(edges).collect()}
        assert not {node[i] for i in range(len(apart))} & set(block)
        assert all(node[i] == node[top] or block[node[i]] == block[node[top]] for i, _, top in brute(rows))


def test_one_of_each_shuffles_no_text_that_stays(spark, make_docs):
    a = " ".join(f"a{k}" for k in range(60))
    rows = [(1, a), (2, a + " more"), (3, None), (3, None), (3, ""), (4, "b c"), (4, "b c"), (None, "b c"), (None, "b c")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = jaccard.one_of_each(make_docs(rows))
        got = sorted((r.doc_id or 0, r.text or "") for r in left.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == [(0, "b c"), (0, "b c"), (1, a), (3, ""), (3, ""), (4, "b c")]
    # Whatever is dealt out by id and text has gone through the bitmap, and is dealt out once.
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\([^)]*\btext#", plan) and "bits#" in plan
