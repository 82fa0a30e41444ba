"""Named text queries over the given tables, with production parameters, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from riskloom.llm import divergence, jaccard, languages, leaks, likelihood, ordinal, packing, pii, repeats, secrets, toxicity, vectors, warc
from riskloom.llm.registry import ORACLES, QUERIES, query
from riskloom.llm.tables import read

__all__ = ["ORACLES", "QUERIES"]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("""
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_page THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_page THEN first_page END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
             min(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS first_page
      FROM pages)
""")
def op1_warc_archive(spark, sf_dir):
    return warc.page_records(read(spark, sf_dir, "pages")).drop("url")


@query()
def op2_quality_likelihood(spark, sf_dir):
    return likelihood.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query(r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
             [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines FROM d),
p AS (SELECT r, unnest(range(1, len(words) - 1)) AS pos, words FROM s WHERE len(words) >= 3),
t AS (SELECT r, pos, count(*) OVER (PARTITION BY r, words[pos], words[pos + 1], words[pos + 2]) AS n FROM p),
c AS (SELECT r, count(DISTINCT pos + k) AS n FROM t, range(3) o(k) WHERE t.n > 1 GROUP BY r),
f AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM s LEFT JOIN c USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f
""")
def quality_rules(spark, sf_dir):
    """The columns of op2 that follow from a text alone."""
    return op2_quality_likelihood(spark, sf_dir).drop("score", "kept")


@query()
def op3_suffix_dedup(spark, sf_dir):
    return repeats.without_repeats(read(spark, sf_dir, "documents"))


@query()
def op4_personal_data(spark, sf_dir):
    return pii.digest(pii.found(read(spark, sf_dir, "documents")))


@query()
def op5_ordinal_quality(spark, sf_dir):
    return ordinal.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op6_jaccard_join(spark, sf_dir):
    return jaccard.groups(read(spark, sf_dir, "documents"))


@query()
def op7_subword_toxicity(spark, sf_dir):
    return toxicity.classified(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op8_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), TOKENIZER)


@query()
def op9_secret_scan(spark, sf_dir):
    return secrets.digest(secrets.scan(read(spark, sf_dir, "documents"), RANKS))


@query()
def op10_benchmark_decontamination(spark, sf_dir):
    return leaks.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op11_language_filter(spark, sf_dir):
    return languages.predicted(read(spark, sf_dir, "documents"))


def _codes_sql(rounds: int = 2) -> str:
    near = """
        near{k} AS (SELECT n, vec_id, label, p, part, min(struct_pack(far := far, entry := entry)) AS best
                    FROM (SELECT t.*, b.entry, list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(t.part, b.part)])::BIGINT AS far
                          FROM parts t JOIN book{k} b USING (p)) GROUP BY ALL)"""
    book = """
        book{k} AS (SELECT b.p, b.entry, coalesce(m.part, b.part) AS part FROM book{j} b LEFT JOIN (
            SELECT p, entry, list(x ORDER BY pos) AS part FROM (
                SELECT p, best.entry AS entry, pos, CAST(floor(sum(part[pos]) / count(*)) AS BIGINT) AS x
                FROM near{j}, (SELECT unnest(generate_series(1, (SELECT max(len(part)) FROM parts))) AS pos) GROUP BY ALL) GROUP BY ALL
            ) m USING (p, entry))"""
    steps = ", ".join(near.format(k=k) + "," + book.format(k=k + 1, j=k) for k in range(rounds))
    return f"""
        WITH kept AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS n, [CAST(floor(256 * x::DOUBLE) AS BIGINT) for x in embedding] AS v
                      FROM embeddings WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
        parts AS (SELECT n, vec_id, label, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS part FROM kept, range(16) r(p)),
        book0 AS (SELECT p, n AS entry, part FROM parts WHERE n < 64), {steps}, {near.format(k=rounds)},
        coded AS (SELECT vec_id, label, string_agg(format('{{:02x}}', best.entry), '' ORDER BY p) AS code, sum(best.far)::BIGINT AS error
                  FROM near{rounds} GROUP BY n, vec_id, label)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(part, ','), ',' ORDER BY p, entry)) FROM book{rounds}) AS codebooks_sha256 FROM coded
    """


@query(_codes_sql())
def op12_vector_codes(spark, sf_dir):
    return vectors.coded(read(spark, sf_dir, "embeddings"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents),
w AS (SELECT r, lang, source, unnest(words) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL),
k AS (SELECT lang, term, sum(n)::BIGINT AS total FROM c GROUP BY ALL HAVING sum(docs) >= 30),
v AS (SELECT lang, count(*) AS v, sum(total)::BIGINT AS n FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
s AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, total FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, s.n, 1 + (1000000000 * (s.n + 5)) // ((sum(s.n) OVER (PARTITION BY lang, source))::BIGINT + 5 * v.v) AS p,
             1 + (1000000000 * (total + 5)) // (v.n + 5 * v.v) AS q FROM s JOIN v USING (lang)),
f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
items AS (FROM pairs UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items QUALIFY part = 'pair' OR rank <= 50
""")
def op13_source_divergence(spark, sf_dir):
    return divergence.audit(read(spark, sf_dir, "documents"))
