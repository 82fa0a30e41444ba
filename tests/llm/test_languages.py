import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from riskloom.llm import languages
from riskloom.llm.queries import QUERIES
from riskloom.llm.tables import read


def windows(text):
    """Byte n-grams in plain Python, a gap only at an end."""
    data = f" {text or ''} ".lower().encode()
    data = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in data)
    return Counter(
        data[k : k + n] for n in languages.LENGTHS for k in range(len(data) - n + 1) if 32 not in data[k + 1 : k + n - 1] and data[k : k + n].strip()
    )


def plain_hits(learn, text, share=0.5, least=2):
    """Hits of a text in exact sets of n-grams in place of filters."""
    counts = {}
    for t, x in learn:
        counts.setdefault(x, Counter()).update(windows(t))
    rates = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    top = Counter()
    for r in rates.values():
        for g, v in r.items():
            top[g] = max(top[g], v)
    sets = {x: {g for g, n in c.items() if n >= least and rates[x][g] >= share * top[g]} for x, c in counts.items()}
    return {x: sum(n for g, n in windows(text).items() if g in s) for x, s in sets.items()}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(spark, data):
    return spark.createDataFrame([(*r, "src", 1.0) for r in data], "doc_id long, text string, lang string, source string, score double")


def corpus(n=240):
    rng = random.Random(4)
    syllables = {"x": ["ka", "ri", "to", "né"], "y": ["shu", "wen", "ol"], "z": ["ka", "wen", "bir", "ост"]}
    out = []
    for k in range(n):
        lang = "xyz"[k % 3]
        out.append((k, " ".join("".join(rng.choices(syllables[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 40))), lang))
    return out


def remainder(i):
    return zlib.crc32(str(i).encode()) % 3


def test_grams_against_plain_python(awkward):
    for text in [*awkward, "Ünïcode WORDS, and-others  ", "a", "ab"]:
        found = languages.grams(pa.array([text], pa.string()))
        assert sum(len(v) for _, v in found) == sum(windows(text).values())
        assert sum(len(np.unique(v)) for _, v in found) == len(windows(text))


def test_predictions_against_exact_sets(spark):
    data = corpus()
    got = languages.predicted(made(spark, data)).collect()
    learn = [(t, x) for i, t, x in data if remainder(i) != 1]
    assert len(got) == len(data) and {r.held_out for r in got} == {True, False}
    for r in got:
        assert r.held_out == (remainder(r.doc_id) == 1)
        hits = plain_hits(learn, data[r.doc_id][1])
        assert r.lang_pred == max(sorted(hits), key=lambda x: hits[x])
        assert abs(r.score - max(hits.values()) / sum(hits.values())) < 0.02
    assert all(r.lang_pred == data[r.doc_id][2] for r in got)


def test_correction_for_false_positives(spark):
    # A crowded filter: many answers are mistakes, yet the corrected hits come near the exact ones.
    data = corpus()
    texts = [t for _, t, _ in data[:60]]
    found = languages.grams(pa.array(texts))
    table = spark.createDataFrame([(int(v), list("xyz")[: 1 + int(v) % 2]) for v in np.unique(np.concatenate([v for _, v in found]).view(np.int64))], "gram long, langs array<string>")
    for size in (1 << 9, 1 << 16):
        small = languages.Filter(languages.bloom(table, ["x", "y", "z"], size, 2), ["x", "y", "z"], 2)
        hits = small.hits(found, len(texts))
        n = sum(np.bincount(r, minlength=len(texts)) for r, _ in found)
        assert (np.abs(hits[:, 0] - n) < 1e-6).all()  # x holds them all
        assert (hits[:, 2] == 0).all()
        odd = sum(np.bincount(r, weights=v.view(np.int64) % 2 == 1, minlength=len(texts)) for r, v in found)
        assert abs(hits[:, 1].sum() - odd.sum()) < 0.15 * n.sum()
    assert small.errs[0] < 0.01


def test_more_than_64_languages(spark):
    langs = sorted(f"l{k:02d}" for k in range(70))
    data = []
    for k, lang in enumerate(langs):
        word = "".join(chr(97 + (k * 7 + j * (1 + k % 5)) % 26) for j in range(8)) + chr(97 + k % 26) + chr(97 + k // 26)
        data += [(100 * k + j, f"{word} {word}{'qrst'[j % 4]}", lang) for j in range(9)]
    got = languages.predicted(made(spark, data)).collect()
    assert sum(r.lang_pred == langs[r.doc_id // 100] for r in got) >= 0.95 * len(got)


def test_awkward_documents(spark, awkward):
    data = [(k, t, "en") for k, t in enumerate(awkward)] + [(None, "no id", "en"), (None, None, None), (90, "12 34 !", "fr"), (91, "письмо", None), (91, "письмо", None)]
    got = rows(languages.predicted(made(spark, data)))
    assert len(got) == len(data)
    by_text = {i: (p, s) for i, _, p, s in got if i is not None}
    for k, t in enumerate(awkward):
        assert (by_text[k][0] == "und") == (not any(c.isalpha() for c in t or ""))
    assert by_text[90] == ("und", 0.0) and by_text[91][0] != "und"
    assert all(0 <= s <= 1 for *_, s in got) and [h for i, h, *_ in got if i is None] == [False, False]
    assert languages.predicted(made(spark, [])).collect() == []
    assert {r.lang_pred for r in languages.predicted(made(spark, [(1, "word", None), (5, "words", None)])).collect()} == {"und"}


def test_labels_of_held_out_rows_do_not_count(spark, sample):
    docs = read(spark, sample, "documents")
    got = rows(QUERIES["op11_language_filter"](spark, sample))
    truth = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    sound = [(i, p) for i, h, p, _ in got if h and any(c.isalpha() for c in truth[i][0] or "") and truth[i][1]]
    assert len(sound) > 200 and sum(p == truth[i][1] for i, p in sound) >= 0.97 * len(sound)
    other = docs.selectExpr("doc_id", "text", "if(crc32(cast(doc_id as string)) % 3 = 1, 'zz', lang) AS lang", "'s' AS source")
    assert rows(languages.predicted(other)) == got
