"""Sessions kept in a batch table, the open ones too, whatever the order in which events arrive.

Structured Streaming gives sessions only once they are closed (it refuses update mode for session windows). Here every batch of
events becomes sessions of its own; table sessions that they overlap or touch are taken back and fused with them. Sums of
sessions can be fused again, so no event is read twice and no state is held beside the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.operators.layout import apply_increment, in_partitions

DAY = "last_day"


def fuse(sessions: DataFrame, key: str) -> DataFrame:
    """Unite sessions of a key that overlap or touch, as session windows do: (key, window_start, window_end, n_events, total)."""
    earlier = Window.partitionBy(key).orderBy("window_start", "window_end").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("window_start") > F.max("window_end").over(earlier), F.lit(True))
    numbered = sessions.withColumn("_opens", opens.cast("int")).withColumn(
        "_session", F.sum("_opens").over(Window.partitionBy(key).orderBy("window_start", "window_end").rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy(key, "_session").agg(
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"),
        F.sum("n_events").alias("n_events"), F.sum("total").alias("total"),
    ).drop("_session")


def sessions_of(events: DataFrame, key: str, time: str, value: str, gap: str) -> DataFrame:
    """Runs of events at most ``gap`` apart. A key with very many events is cut by day first, and its days are fused."""
    parts = events.filter(F.col(time).isNotNull()).groupBy(key, F.to_date(time).alias("_day"), F.session_window(time, gap).alias("_run")).agg(
        F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total")
    )
    flat = parts.select(key, F.col("_run.start").alias("window_start"), F.col("_run.end").alias("window_end"), "n_events", "total")
    return fuse(flat, key)


def merge_sessions(spark: SparkSession, path: str, sessions: DataFrame, key: str, run_id: str) -> None:
    """Fuse sessions into the table at ``path``, which is partitioned by the day on which a session ends.

    Only days from the first of the new sessions on are read, and only those with sessions that change are rewritten.
    A fused session stands once, under the day of its end; the parts it was made of are gone.
    """
    sessions = sessions.withColumn(DAY, F.to_date("window_end"))

    def merge(new: DataFrame, base: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        if base is None:
            return new, new.select(DAY)
        first = new.agg(F.min(F.to_date("window_start"))).first()[0]
        base = base.filter(F.col(DAY) >= F.lit(first))
        overlap = F.expr(f"t.{key} <=> n.{key} AND t.window_start <= n.window_end AND n.window_start <= t.window_end")
        touched = base.alias("t").join(new.select(key, "window_start", "window_end").alias("n"), overlap, "left_semi")
        fused = fuse(touched.unionByName(new).drop(DAY), key).withColumn(DAY, F.to_date("window_end"))
        days = touched.select(DAY).union(fused.select(DAY)).distinct()
        same = F.expr(f"t.{key} <=> n.{key} AND t.window_start = n.window_start")
        rest = in_partitions(base, days, DAY).alias("t").join(touched.select(key, "window_start").alias("n"), same, "left_anti")
        return rest.unionByName(fused), days

    apply_increment(spark, path, sessions, sessions.schema, DAY, run_id, merge, may_empty=True)


def session_table(
    events: DataFrame, path: str, checkpoint: str, key: str, time: str, value: str, gap: str
) -> StreamingQuery:
    """Keep the table of all sessions up to date with a stream, each batch once."""

    def merge(batch: DataFrame, number: int) -> None:
        merge_sessions(batch.sparkSession, path, sessions_of(batch, key, time, value, gap), key, f"batch-{number}")

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(merge).trigger(availableNow=True).start()


def table_schema(key: str, kind: str) -> T.StructType:
    """Columns of the table, for a key of the given type."""
    return T.StructType.fromDDL(
        f"{key} {kind}, window_start timestamp, window_end timestamp, n_events bigint, total double, {DAY} date"
    )
