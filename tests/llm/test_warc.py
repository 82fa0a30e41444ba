import hashlib
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import oracle
import pytest
from pyspark.sql import functions as F
from riskloom.llm import warc
from riskloom.llm.queries import ORACLES, QUERIES
from riskloom.session import scratch_path

LONG = "<p>" + "é" * 60 + "</p>"
ROWS = [
    (3, "http://a/ b\r\nX: y", LONG), (1, "http://b", LONG), (2, None, LONG), (None, "http://n", LONG), (1, "http://b", LONG),
    (4, "http://c", "short"), (5, "http://c", "short"), (6, "http://d", None), (7, "http://e", ""),
    (8, "http://f", "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "z" * 100), (9, "http://g", "nul\x00" + "y" * 3_000_000),
    (10, "http://h", "y" * 99), (11, "http://h", "y" * 99),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, digest string, length int")


def wanted(rows):
    out = []
    for page_id, _, html in rows:
        payload = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if len(payload) >= 100 and same else page_id
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), *(("response", None) if first == page_id else ("revisit", first))))
    return sorted(out, key=str)


def test_round_trip(pages):
    got = warc.page_records(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == wanted(ROWS)


def test_index_finds_every_record(spark, pages):
    path = scratch_path(spark, "warc-test")
    warc.write_archive(pages.repartition(3), path)
    index = warc.build_index(spark, path)
    chosen = index.where(F.col("record_type") == "response").where(warc.page_of(F.col("record_id")).isin(8, 9))
    payloads = {hashlib.sha256(r.payload).hexdigest() for r in warc.read_records(chosen, gap=0, most=1).collect()}
    assert payloads == {hashlib.sha256(h.encode()).hexdigest() for p, _, h in ROWS if p in (8, 9)}
    assert index.count() == len(ROWS)
    assert index.where("url like 'http://a/%'").first().url == "http://a/%20b%20%20X:%20y"


def test_small_steps_find_the_same_records(spark, pages):
    path = scratch_path(spark, "warc-steps")
    warc.write_archive(pages, path)
    for file in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path").collect():
        assert list(warc.scan(file.path, step=7)) == list(warc.scan(file.path))


def test_ranges_are_joined():
    class Row:
        def __init__(self, path, offset, length):
            self.path, self.offset, self.length = path, offset, length

    rows = [Row("a", 0, 10), Row("a", 12, 10), Row("a", 500, 10), Row("b", 510, 5)]
    assert [len(r) for r in warc.ranges(iter(rows), gap=4, most=100)] == [2, 1, 1]
    assert [len(r) for r in warc.ranges(iter(rows), gap=4, most=15)] == [1, 1, 1, 1]


def test_empty_table(spark, pages):
    assert warc.page_records(pages.limit(0)).count() == 0


def test_sample_against_sql(spark, sample):
    table = QUERIES["op1_warc_archive"](spark, sample).toArrow()
    assert oracle.difference(oracle.connect(sample), table, ORACLES["op1_warc_archive"]) is None
