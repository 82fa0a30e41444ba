"""Throughput, latency and rule counts of a stream, one row for each batch.

The counts are taken while the batch is worked through (``observe``), the times come from the query's own progress reports, and
a listener appends both to a table, so that they outlast the query and its 100 last reports.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

NAME = "rules"


def watched(stream: DataFrame, counts: Mapping[str, Column]) -> DataFrame:
    """The stream, counting its rows and those for which each condition is true."""
    return stream.observe(NAME, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])


def metrics_schema(names: Mapping[str, Column]) -> str:
    counts = ", ".join(f"`{n}` bigint" for n in names)
    return f"run string, batch bigint, started string, n_input bigint, rows_per_second double, batch_ms bigint, n_rows bigint, {counts}"


class BatchTable(StreamingQueryListener):
    """Appends a row to the table at ``path`` for every batch of one run of a query."""

    def __init__(self, spark: SparkSession, path: str, counts: Mapping[str, Column]):
        self.spark, self.path, self.names, self.schema = spark, path, list(counts), metrics_schema(counts)
        self.run, self.early, self.over, self.failure = None, [], set(), None
        self.lock, self.ended = threading.Lock(), threading.Event()

    def follow(self, query: StreamingQuery) -> None:
        """Reports may arrive before the query's number is known here: those are kept until then."""
        with self.lock:
            self.run = str(query.runId)
            for progress in self.early:
                self._write(progress)
            if self.run in self.over:
                self.ended.set()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.early.append(event.progress) if self.run is None else self._write(event.progress)

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self.over.add(str(event.runId))
            if self.run in self.over:
                self.ended.set()

    def _write(self, progress) -> None:
        if str(progress.runId) != self.run:
            return
        counts = progress.observedMetrics.get(NAME)
        found = [counts[n] if counts else 0 for n in ("n_rows", *self.names)]
        speed = float(progress.processedRowsPerSecond or 0)
        row = (self.run, progress.batchId, progress.timestamp, progress.numInputRows, speed, progress.batchDuration, *found)
        try:
            self.spark.createDataFrame([row], self.schema).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as error:  # a listener's errors are only logged by Spark: keep it for the caller
            self.failure = error


def run_with_metrics(spark: SparkSession, start, path: str, counts: Mapping[str, Column], timeout: float = 600) -> StreamingQuery:
    """Start a query, wait for its end, and leave its batches in the table at ``path``. Errors of the query or the table raise."""
    listener = BatchTable(spark, path, counts)
    spark.streams.addListener(listener)
    try:
        query = start()
        listener.follow(query)
        query.awaitTermination()
        if not listener.ended.wait(timeout):
            raise TimeoutError("the reports of the query did not arrive")
    finally:
        spark.streams.removeListener(listener)
    if listener.failure:
        raise listener.failure
    return query
