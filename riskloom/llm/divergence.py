"""How far the sources of a language differ in their words: all pairs of sources, and the words each source favours.

1. Terms are counted by language, source and term inside the tasks, whole texts, then summed; so are the documents that hold
   them. A language keeps the terms of at least `least_docs` of its documents.
2. Smoothed shares are whole numbers, p = 1 + floor(10**9 (count + 5) / (N + 5 V)). A group has few distinct terms among all
   kept ones, so its row is sparse over a *baseline*: the share of a term it never uses.
3. The distance of two sources is summed by row accumulation (Gustavson): the postings of a language are dealt by term into
   blocks, each a term-major index of about as many postings as there are pairs of groups, but `least` to `most`. For one group after the other, its terms are scattered through
   the index into a dense array with one number for each peer; no pair of postings is ever made into a row. A
   block passes on one number for each pair of its groups and peers, and Spark adds the blocks up.
4. Where one of two groups lacks a term its baseline stands in. For group g and peer s the sum over all kept terms is
   A(g, s) + A(s, g) + C(g, s) + (V - |g| - |s|) |b_g - b_s|, where b are the baselines, A(g, s) sums |p_g - b_s| over g's
   terms, and C corrects the terms of both by |p_g - p_s| - |p_g - b_s| - |b_g - p_s| + |b_g - b_s|.

The accumulator has one number for each source of a language, of which the result has the square. Blocks of a language
with more than `rows` sources are searched by several tasks, each for its own sources. A very large group or frequent term is one row by
then for each (group, term).

Defined cases: null text, lang or source is an empty string; a group without kept terms has baselines only; a language
without kept terms gives 0 for each pair; a source that is alone has no pairs; repeated rows and ids are separate
documents; an empty table gives an empty result; other columns are ignored. Terms are told apart by a 64-bit hash within a slice of texts and in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.packing import ragged
from riskloom.llm.tables import set_down
from riskloom.llm.wordarrays import _LOWER, slices, utf8, words
from riskloom.operators.joins import own_shuffle

# Fixed values of the report.
LEAST_DOCS, TOP_TERMS = 30, 50
PRIOR, SCALE = 5, 1_000_000_000

# A term is a run of ASCII letters and of bytes beyond ASCII.
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

GROUP = ["lang", "source"]
COUNTS = "lang string, source string, term string, n long, docs long"


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in each group, and documents that hold it."""

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 23):
            data, at = utf8(batch.column("text"))
            found = words(data, at, lower=True, outside=_BETWEEN)
            if not len(found.row):
                continue
            langs, sources = (batch.column(c).dictionary_encode() for c in GROUP)
            group = np.asarray(langs.indices).astype(np.int64) * len(sources.dictionary) + np.asarray(sources.indices)
            hashes, first, term = np.unique(found.hash, return_index=True, return_inverse=True)
            m = len(hashes)
            key, n = np.unique(group[found.row] * m + term, return_counts=True)
            in_doc = np.unique(found.row * m + term)
            _, docs = np.unique(group[in_doc // m] * m + in_doc % m, return_counts=True)
            start, size = found.start[first], found.end[first] - found.start[first]
            ends = np.concatenate([[0], np.cumsum(size)])
            raw = _LOWER[data[ragged(start, size)]]
            terms = pa.LargeStringArray.from_buffers(m, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())).cast(pa.string())
            of = key // m
            columns = [
                langs.dictionary.take(pa.array(of // len(sources.dictionary))), sources.dictionary.take(pa.array(of % len(sources.dictionary))),
                terms.take(pa.array(key % m)), pa.array(n), pa.array(docs),
            ]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in COUNTS.split(", ")])

    return docs.mapInArrow(count, COUNTS).groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str) -> Column:
    """1 + floor(SCALE (count + PRIOR) / (total + PRIOR V)), exact beyond 64 bits."""
    return F.expr(f"1 + (cast({count} + {PRIOR} as decimal(20, 0)) * {SCALE}) div cast({total} + {PRIOR} * V as decimal(20, 0))")


def scattered(left: pa.Table, right: pa.Table) -> pa.Table:
    """What one block adds to the distance of each of its own groups from each peer; right: all sources and baselines."""
    peers, base = right.column("source").combine_chunks(), np.asarray(right.column("base")).astype(np.int64)
    code = np.asarray(pc.index_in(left.column("source"), value_set=peers)).astype(np.int64)
    term = np.unique(np.asarray(left.column("term")), return_inverse=True)[1]
    order = np.lexsort((code, term))  # term-major, peers of a term in order
    code, term = code[order], term[order]
    p, own = np.asarray(left.column("p"))[order].astype(np.int64), np.asarray(left.column("own"))[order]
    stop = np.cumsum(np.bincount(term))[term] if len(term) else term
    by_group = np.argsort(code, kind="stable")
    by_group = by_group[own[by_group]]
    cuts = np.flatnonzero(np.diff(code[by_group], prepend=-1))
    groups, rows = [], []
    for places in np.split(by_group, cuts[1:]) if len(by_group) else []:
        g, mine = code[places[0]], p[places]
        total = np.zeros(len(base), np.int64)
        # Each pair of groups is met once, from the one that comes first.
        size = stop[places] - places - 1
        other, here = ragged(places + 1, size), np.repeat(mine, size)
        s, there = code[other], p[other]
        np.add.at(total, s, np.abs(here - there) - np.abs(here - base[s]) - np.abs(base[g] - there) + np.abs(base[g] - base[s]))
        mine = np.sort(mine)
        sums = np.concatenate([[0], np.cumsum(mine)])
        below = np.searchsorted(mine, base)
        total += base * (2 * below - len(mine)) + sums[-1] - 2 * sums[below]
        groups.append(g)
        rows.append(total)
    n = len(base)
    a, b = np.repeat(np.array(groups, np.int64), n), np.tile(np.arange(n), len(groups))
    value = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    keep = a != b
    lang = right.column("lang").combine_chunks().take(pa.array(np.zeros(keep.sum(), np.int64)))
    return pa.table(
        [lang, peers.take(pa.array(np.minimum(a, b)[keep])), peers.take(pa.array(np.maximum(a, b)[keep])), pa.array(value[keep])],
        names=["lang", "a", "b", "value"],
    )


def distances(postings: DataFrame, groups: DataFrame, least: int, most: int, rows: int) -> DataFrame:
    """(lang, a, b, value) for a before b, without the baselines of terms that neither has."""
    langs = groups.where("V > 0").groupBy("lang").agg(
        # A block gives a number for each pair of groups: it holds as many postings, within bounds.
        F.ceil(F.sum("size") / F.least(F.lit(most), F.greatest(F.lit(least), F.pow(F.count(F.lit(1)), 2)))).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("parts"),
    )
    dealt = postings.select(*GROUP, F.xxhash64("term").alias("term"), "p").join(own_shuffle(langs, "lang"), "lang")
    spread = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    left = dealt.select(*GROUP, "term", "p", "parts", F.pmod("term", "blocks").cast("int").alias("block"), spread)
    left = left.withColumn("own", F.pmod(F.xxhash64("source"), F.col("parts")) == F.col("part")).drop("parts")
    peers = groups.join(langs, "lang").select(*GROUP, "base", "parts", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    peers = peers.select(*GROUP, "base", "block", spread)
    key = ["lang", "block", "part"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return scattered(left, right.sort_by("source"))

    found = left.groupBy(*key).cogroup(peers.groupBy(*key)).applyInArrow(search, "lang string, a string, b string, value long")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS, least: int = 1 << 15, most: int = 1 << 20, rows: int = 1000
) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to all other sources, and the `top` terms above the language's share."""
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", *GROUP)))
    counts = set_down(term_counts(docs), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs).drop("docs")
    used = set_down(counts.drop("docs").join(own_shuffle(kept, ["lang", "term"]), ["lang", "term"]), "kept-terms")

    langs = used.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("total").alias("words_lang"))
    sizes = used.groupBy(*GROUP).agg(F.sum("n").alias("words"), F.count(F.lit(1)).alias("size"))
    groups = docs.select(*GROUP).distinct().join(own_shuffle(sizes, GROUP), GROUP, "left").join(own_shuffle(langs, "lang"), "lang", "left").na.fill(0)
    groups = set_down(groups.withColumn("base", F.when(F.col("V") > 0, share("0", "words")).otherwise(F.lit(0))), "term-groups")

    shares = used.join(own_shuffle(groups.drop("size", "base"), GROUP), GROUP)
    shares = set_down(shares.select(*GROUP, "term", share("n", "words").alias("p"), share("total", "words_lang").alias("q")), "shares")

    summed = distances(shares, groups, least, most, rows)
    one = groups.select("lang", F.col("source").alias("a"), "V", F.col("size").alias("size_a"), F.col("base").alias("base_a"))
    two = groups.select("lang", F.col("source").alias("b"), F.col("size").alias("size_b"), F.col("base").alias("base_b"))
    both = one.join(two, "lang").where("a < b").join(own_shuffle(summed, ["lang", "a", "b"]), ["lang", "a", "b"], "left")
    neither = (F.col("V") - F.col("size_a") - F.col("size_b")) * F.abs(F.col("base_a") - F.col("base_b"))
    both = both.select("lang", "a", "b", (F.coalesce("value", F.lit(0)) + neither).alias("value"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    pairs = both.select("lang", ends.alias("end"), "value").select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value")
    terms = shares.where("p > q").select(*GROUP, F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))

    order = Window.partitionBy(*GROUP, "part").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return pairs.select("*", rank).unionByName(terms.select("*", rank).where(F.col("rank") <= top))
