"""Streaming forms of the rules and aggregates.

Each function takes a streaming DataFrame with an event time of type ``timestamp``
and gives one back; ``write_files`` and ``refresh_table`` start the query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions import rules
from riskloom.operators.dedup import latest_per_key
from riskloom.operators.layout import upsert


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score(transactions: DataFrame, customers: DataFrame, limit: Column) -> DataFrame:
    """The batch scoring on a stream; customers are a static table, of which the newest profile counts as in the batch."""
    if "updated_at" in customers.columns:
        customers = latest_per_key(customers.select("customer_id", "risk_score", "updated_at"), "customer_id", ["updated_at"])
    risk = customers.select("customer_id", F.col("risk_score").alias("_risk"))
    amount, customer_risk = F.col("amount"), F.col("_risk")
    return transactions.join(risk, "customer_id", "left").select(
        "transaction_id",
        "customer_id",
        rules.suspicion_score(amount, customer_risk).alias("suspicion_score"),
        rules.rule_hits(amount, customer_risk, limit).alias("rule_hits"),
    )


def newest_signals(signals: DataFrame, path: str) -> DataFrame:
    """The newest signal of each transaction, written once, so that a stream that joins them does not reduce them in every batch."""
    latest_per_key(signals, "transaction_id", ["created_date", "ml_signal_id"]).write.parquet(path)
    return signals.sparkSession.read.schema(signals.schema).parquet(path)


def with_signals(
    transactions: DataFrame,
    signals: DataFrame,
    key: str,
    time: str,
    signal_time: str,
    before: str,
    after: str,
    lateness: str,
    signal_lateness: str | None = None,
) -> DataFrame:
    """Streamed transactions with the streamed signals from ``before`` to ``after`` their time.

    Left outer: a transaction without a signal comes out, with nulls, once the watermark says that none can follow.
    The time bound lets both sides be evicted: a transaction ``after`` past its time, a signal ``before`` past its own.
    Rows that come later than their stream's lateness are dropped.
    """
    left = transactions.withWatermark(time, lateness).alias("t")
    right = signals.withWatermark(signal_time, signal_lateness or lateness).alias("s")
    bound = F.expr(
        f"t.{key} = s.{key} AND s.{signal_time} >= t.{time} - INTERVAL {before} AND s.{signal_time} <= t.{time} + INTERVAL {after}"
    )
    columns = [F.col(f"t.{c}") for c in transactions.columns] + [F.col(f"s.{c}") for c in signals.columns if c != key]
    return left.join(right, bound, "left_outer").select(*columns)


def _totals(value: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total")]


def _flat(windows: DataFrame, key: str) -> DataFrame:
    return windows.select(
        key, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "n_events", "total",
    )


def velocity(
    events: DataFrame, key: str, time: str, value: str, window: str, lateness: str, slide: str | None = None
) -> DataFrame:
    """Count and sum for each key in tumbling or, with ``slide``, sliding windows."""
    grouped = events.withWatermark(time, lateness).groupBy(F.window(time, window, slide), key)
    return _flat(grouped.agg(*_totals(value)), key)


def sessions(events: DataFrame, key: str, time: str, value: str, gap: str, lateness: str) -> DataFrame:
    """Count and sum for each run of events at most ``gap`` apart."""
    grouped = events.withWatermark(time, lateness).groupBy(
        F.session_window(time, gap).alias("window"), key
    )
    return _flat(grouped.agg(*_totals(value)), key)


def _thinned(events: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Of the rows with one key that a task reads together, those that no earlier one makes needless.

    A row goes if one before it has the key and is as late or later: where this row is on time that one is too, and then it
    comes first. So the first row on time stays, whatever the watermark. Keys of nested types are left alone.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    if any(isinstance(events.schema[k].dataType, nested) for k in keys):
        return events
    keys = list(keys)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            table = pa.table([*(batch[k] for k in keys), pa.array(np.arange(n))], [*(f"k{i}" for i in range(len(keys))), "row"])
            groups = table.group_by(table.column_names[:-1], use_threads=False).aggregate([("row", "list")])["row_list"].combine_chunks()
            if len(groups) == n:
                yield batch
                continue
            row = np.asarray(groups.flatten())
            group = np.repeat(np.arange(len(groups)), np.asarray(groups.value_lengths()))
            # Watermarks never drop a row without a time. Ranks, so that every group lies above those before it.
            clock = np.asarray(batch[time].cast(pa.int64()).fill_null(np.iinfo(np.int64).max))
            rank = np.unique(clock, return_inverse=True)[1][row] + group * n
            stays = np.append(True, rank[1:] > np.maximum.accumulate(rank)[:-1])
            yield batch.take(pa.array(np.sort(row[stays])))

    return events.mapInArrow(thin, events.schema)


def deduplicate(
    events: DataFrame, keys: Sequence[str], time: str, lateness: str, spread: bool = True
) -> DataFrame:
    """The first event of each key; repeats within the lateness are dropped.

    A stream shuffles every copy of a key to one task. With ``spread`` the copies are first thinned out among those that
    one task reads together, without state: copies of one time become one, copies at other times those that are later
    than all before them. The state holds every key once.
    """
    if spread:
        events = _thinned(events, keys, time)
    return events.withWatermark(time, lateness).dropDuplicatesWithinWatermark(list(keys))


def write_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows to a table folder, work through all input there is, and stop."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(availableNow=True)
        .start()
    )


def refresh_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    newest_by: Sequence[str],
    partition_by: str,
    output_mode: str = "append",
    key_gives_partition: bool = False,
) -> StreamingQuery:
    """Merge every batch of the stream into a batch table, each batch once.

    A batch that is run again after a failure has the same number, and the merge
    of a number that is done already changes nothing.
    """

    def merge(batch: DataFrame, number: int) -> None:
        upsert(
            batch.sparkSession, path, batch, list(keys), list(newest_by), partition_by, f"batch-{number}", key_gives_partition
        )

    return (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge)
        .trigger(availableNow=True)
        .start()
    )
