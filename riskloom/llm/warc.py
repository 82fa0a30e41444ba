"""Web archives: write pages as WARC records, index them, read chosen records back by byte ranges.

* Writing is Spark's own text writer with `\\r\\n\\r\\n`, the end of a WARC record, as its line separator, so files appear
  only when a task commits, on any file system that Spark can write.
* The index comes first: offset, length, URL, digest, type and id per record, from the headers alone; payloads are
  skipped by seeking.
* Reading sorts the selected index rows by file and offset, joins neighbours into ranges and reads each range once. A
  large archive is shared out by stretches of `stretch` bytes.

Archives lie in a folder that pyarrow's file systems can open (file, hdfs, s3, gs), which `spark.checkpoint.dir` must be.

Defined cases: a null html is an empty payload; a null url is empty; control characters and spaces in a URL become %20;
rows equal in page_id and payload are records of one page and of the same type; a null page_id is larger than any other
and refers to a page that has one; an empty table gives an empty archive and no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.tables import set_down
from riskloom.operators.joins import own_shuffle
from riskloom.session import scratch_path

CRLF = "\r\n"
END = b"\r\n\r\n"
HTTP = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Content-Length: "])
DIGEST = "sha256:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "path string, offset long, length long, record_type string, record_id string, url string, digest string, refers_to string"
RECORD = "record_type string, record_id string, url string, digest string, refers_to string, payload binary"


def with_digest(pages: DataFrame) -> DataFrame:
    """page_id, url, html (never null), digest and payload_bytes of the UTF-8 payload."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), r"[\x00-\x20\x7f]", "%20").alias("url"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
    )


def record_id(page_id: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), digest, F.lit(":"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def page_of(record: Column) -> Column:
    return F.nullif(F.regexp_extract(record, r":(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def write_archive(pages: DataFrame, path: str, least: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """One record per page; equal payloads of `least` bytes or more become revisits of the smallest page_id."""
    rows = with_digest(pages)
    repeated = (
        rows.where(F.col("payload_bytes") >= least).select("digest", "page_id").groupBy("digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    )
    # Set down, so that Spark knows its size and shuffles pages only where it is too large to broadcast.
    repeated = set_down(repeated, "repeated-payloads")
    rows = rows.join(own_shuffle(repeated, "digest"), "digest", "left")
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    block = F.concat(
        F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit(CRLF * 2),
        F.when(revisit, F.lit("")).otherwise(F.col("html")),
    )
    refers = F.concat(
        F.lit(f"{CRLF}WARC-Profile: {PROFILE}{CRLF}WARC-Refers-To: "), record_id(F.col("_first"), F.col("digest"))
    )
    head = F.concat(
        F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(CRLF + "WARC-Record-ID: "), record_id(F.col("page_id"), F.col("digest")),
        F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), F.col("url"),
        F.lit(CRLF + "WARC-Payload-Digest: " + DIGEST), F.col("digest"),
        F.when(revisit, refers).otherwise(F.lit("")),
        F.lit(CRLF + "Content-Type: application/http;msgtype=response" + CRLF + "Content-Length: "),
        F.octet_length(F.col("block")).cast("string"), F.lit(CRLF * 2), F.col("block"),
    )
    lines = rows.withColumn("block", block).select(head.alias("value"))
    lines.write.option("lineSep", END.decode()).text(path)


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def headers(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split(CRLF)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record where one should begin: {lines[0][:40]!r}")
    return dict(x.split(": ", 1) for x in lines[1:] if ": " in x)


def scan(path: str, step: int = 1 << 20) -> Iterator[tuple]:
    """Index rows of one archive. At most one header and `step` bytes are held."""
    system, name = _open(path)
    with system.open_input_file(name) as file:
        size, at, buffer, begin = file.size(), 0, b"", 0
        while at < size:
            if not begin <= at < begin + len(buffer):
                begin, buffer = at, file.read_at(min(step, size - at), at)
            stop = buffer.find(END, at - begin)
            if stop < 0:
                if begin + len(buffer) >= size:
                    raise ValueError(f"{path}: a header at {at} has no end")
                more = len(buffer) - (at - begin) + step
                begin, buffer = at, file.read_at(min(more, size - at), at)
                continue
            head = headers(buffer[at - begin : stop])
            length = begin + stop + len(END) - at + int(head["Content-Length"])
            yield (
                path, at, length, head["WARC-Type"], head["WARC-Record-ID"], head.get("WARC-Target-URI", ""),
                head["WARC-Payload-Digest"].removeprefix(DIGEST), head.get("WARC-Refers-To"),
            )
            at += length + len(END)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives in a folder."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def index(frames) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file in frame["path"]:
                rows = []
                for row in scan(file):
                    rows.append(row)
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path)
    return files.where("length > 0").select("path").mapInPandas(index, INDEX)


def ranges(rows: Iterator, gap: int, most: int) -> Iterator[list]:
    """Join index rows, sorted by file and offset, into runs to be read at once."""
    run: list = []
    for row in rows:
        if run and (row.path != run[-1].path or row.offset > run[-1].offset + run[-1].length + gap or row.offset + row.length > run[0].offset + most):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def payload_of(raw: bytes) -> bytes:
    """What follows the WARC and the HTTP header of a record."""
    stop = raw.index(END) + len(END)
    return raw[raw.index(END, stop) + len(END) :]


def read_records(selected: DataFrame, gap: int = 1 << 16, most: int = 1 << 22, stretch: int = 1 << 25) -> DataFrame:
    """The records that index rows name, each with its payload (of a revisit: empty)."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 5 + [pa.binary()]

    def fetch(batches) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in b.to_pandas().itertuples(index=False))
        opened, file = None, None
        for run in ranges(rows, gap, most):
            if opened != run[0].path:
                system, name = _open(opened := run[0].path)
                file = system.open_input_file(name)
            begin = run[0].offset
            raw = file.read_at(run[-1].offset + run[-1].length - begin, begin)
            payloads = [payload_of(raw[r.offset - begin : r.offset - begin + r.length]) for r in run]
            columns = [[getattr(r, n) for r in run] for n in names[:-1]] + [payloads]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    near = selected.withColumn("_stretch", F.floor(F.col("offset") / stretch))
    dealt = near.repartition("path", "_stretch").sortWithinPartitions("path", "offset").drop("_stretch")
    return dealt.mapInArrow(fetch, RECORD)


def page_records(pages: DataFrame) -> DataFrame:
    """Write an archive of all pages, index it, read every record back and describe the full payload of each page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, path)
    index = set_down(build_index(spark, path), "warc-index")
    size, digest = F.octet_length("payload").cast("long"), F.sha2(F.col("payload"), 256)
    records = set_down(
        read_records(index).select("record_type", "record_id", "url", "refers_to", size.alias("payload_bytes"), digest.alias("payload_digest")),
        "warc-records",
    )
    answers = records.where("record_type = 'response'")
    # A revisit has the payload of the record it refers to; responses of one page are alike.
    full = answers.groupBy(F.col("record_id").alias("refers_to")).agg(
        F.first("payload_bytes").alias("payload_bytes"), F.first("payload_digest").alias("payload_digest")
    )
    again = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    whole = answers.unionByName(again.join(own_shuffle(full, "refers_to"), "refers_to"))
    return whole.select(
        page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page_of(F.col("refers_to")).alias("refers_to"), "url",
    )
