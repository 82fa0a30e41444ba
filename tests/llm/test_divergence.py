import random
import re
from collections import Counter

import oracle
import pytest
from riskloom.llm import divergence
from riskloom.llm.queries import ORACLES, QUERIES

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(docs, least=30, top=50):
    """All rows, from (text, lang, source), with every kept term of every group written out."""
    docs = [(TERM.findall((t or "").translate(LOWER)), a or "", s or "") for t, a, s in docs]
    out = []
    for lang in {a for _, a, _ in docs}:
        mine = [(w, s) for w, a, s in docs if a == lang]
        in_docs, total = Counter(), Counter()
        for w, _ in mine:
            in_docs.update(set(w))
            total.update(w)
        kept = sorted(t for t in total if in_docs[t] >= least)

        def shares(count, kept=kept):
            n = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (n + 5 * len(kept)) for t in kept}

        counts = {}
        for w, s in mine:
            counts.setdefault(s, Counter()).update(w)
        q, p = shares(total), {s: shares(c) for s, c in counts.items()}
        for s in p:
            far = {o: sum(abs(p[s][t] - p[o][t]) for t in kept) for o in p if o != s}
            more = {t: p[s][t] - q[t] for t in kept if counts[s][t] and p[s][t] > q[t]}
            for part, items in (("pair", far), ("term", more)):
                ranked = sorted(items.items(), key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, value long, rank string")


def found(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def made(seed, n=300):
    random_ = random.Random(seed)
    out = []
    for _ in range(n):
        lang = random_.choice(["a", "a", "b", None])
        source = random_.choice(["s1", "s1", "s1", "s2", "s3", "é", None])
        words = [f"{random_.choice('xyzé')}{chr(97 + random_.randrange(26))}{(source or 'n')[0]}" for _ in range(random_.randrange(60))]
        out.append((random_.choice([" ", "1", "-", "\n"]).join(random_.choice([w, w.upper()]) for w in words), lang, source))
    return out


@pytest.mark.parametrize(("most", "rows"), [(1 << 20, 1000), (50, 2)])
def test_against_every_term(spark, most, rows):
    docs = made(most)
    want = brute(docs, least=4)
    assert len({x[1] for x in want}) == 5 and {x[2] for x in want} == {"pair", "term"}
    assert found(divergence.audit(table(spark, docs), least_docs=4, least=min(most, 1000), most=most, rows=rows)) == want


def test_top_and_ties(spark):
    docs = [("aa bb cc dd ee", "x", "one")] * 3 + [("ff gg hh", "x", "two"), ("aa aa ff", "x", "two")] + [("", "x", "none"), (None, "x", "none2")]
    for top in (2, 50):
        assert found(divergence.audit(table(spark, docs), least_docs=1, top=top)) == brute(docs, 1, top)


def test_awkward_documents(spark, awkward):
    docs = [(t, None, None) for t in awkward] + [(t, "l", f"s{k}") for k, t in enumerate(awkward)] + [("only one", "alone", "s")]
    for least in (1, 2, 30):
        assert found(divergence.audit(table(spark, docs), least_docs=least)) == brute(docs, least)
    assert divergence.audit(table(spark, [])).collect() == []


def test_counts_beyond_64_bits(spark):
    n, total, v = 9 * 10**14, 10**15 + 7, 12_345
    row = spark.sql(f"SELECT {n}L AS n, {total}L AS words, {v}L AS V").select(divergence.share("n", "words").alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 5) // (total + 5 * v)


def test_sample_equals_sql(spark, sample):
    rows = QUERIES["op13_source_divergence"](spark, sample).toArrow()
    assert rows.num_rows > 1000
    assert oracle.difference(oracle.connect(sample), rows, ORACLES["op13_source_divergence"]) is None
