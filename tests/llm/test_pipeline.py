import corpus_pipeline
import test_jaccard
import test_leaks
import test_packing
import test_secrets
from riskloom.llm import ordinal
from riskloom.llm.queries import TOKENIZER
from riskloom.llm.tables import DOCUMENT_COLUMNS, read, set_down
from tokenizers import Tokenizer


def test_stages_against_plain_python(spark, sample):
    docs, kept = read(spark, sample, "documents"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = set_down(stage(spark, docs, sample), "pipeline-test")
        assert docs.columns == DOCUMENT_COLUMNS
        kept[name] = ({r.doc_id: r.text for r in before.collect()}, {r.doc_id: r.text for r in docs.collect()})

    before, after = kept["quality classifier"]
    judged = {r.doc_id: r.kept for r in ordinal.classified(read(spark, sample, "documents"), read(spark, sample, "labels")).collect()}
    assert after == {i: t for i, t in before.items() if judged[i]}

    before, after = kept["n-gram Jaccard join"]
    first = {i for i, _, top in test_jaccard.brute(list(before.items())) if i == top}
    assert after == {i: t for i, t in before.items() if i in first}

    before, after = kept["benchmark decontamination"]
    items = [" ".join(test_leaks.words(r.text)) for r in read(spark, sample, "benchmark").collect()]
    leaking = {i for i, t in before.items() if any(p in " ".join(test_leaks.words(t)) for p in items)}
    assert leaking and not leaking & set(after) and all(before[i] == t for i, t in after.items())
    assert len(before) - len(after) <= 1.2 * len(leaking) + 2

    before, after = kept["secret scans"]
    assert set(before) == set(after)
    changed = {i for i in before if before[i] != after[i]}
    assert {i for i, t in before.items() if test_secrets.base(t)[1]} <= changed
    assert not any(test_secrets.base(t)[1] for t in after.values())

    rows = corpus_pipeline.STAGES[-1][1](spark, docs, sample).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    test_packing.check(rows, test_packing.expected(tokenizer, after.items()))
    whole = corpus_pipeline.run(spark, sample).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in rows)


def test_awkward_documents(spark, make_docs, awkward, tmp_path):
    docs = make_docs([*enumerate(awkward), (None, "null id"), (None, "null id"), (3, "twice"), (3, "twice")])
    docs.select(*DOCUMENT_COLUMNS, "score").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = [r.doc_id for r in rows if r.piece == 0]
    assert ids.count(None) == 2 and ids.count(3) <= 2 and {0, 1, 2, 4} <= set(ids)
