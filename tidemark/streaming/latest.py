"""Newest copy of each event kept by a stateful stream with an event-time watermark."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import LOOKBACK_DAYS, micros
from tidemark.operators.dedup import latest_per_key
from tidemark.sources.files import append_run

EPOCH = "epoch"


def stream_latest(
    events: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "event_id",
    time: str = "event_time",
    newest: Sequence[str] = ("event_time", "arrival_ts"),
    delay_days: int = LOOKBACK_DAYS,
) -> StreamingQuery:
    """Run a streaming frame to its present end, and keep the newest copy of each key and day of event.

    The state holds one row for each key of a day; the watermark (newest time less the delay) drops
    days that are over, so the state is as large as the delay, not as the history. Events older than the watermark
    are left out and counted by the query (`late_rows`). A micro-batch writes the groups it changed under
    its number; one that is repeated replaces them. Rows without a time have no day and are left out.
    """
    rest = [name for name in events.columns if name not in {key, *newest}]
    best = F.max(F.struct(*newest, *rest)).alias("best")
    # Watermarks need a time with a zone: the zone-free one is taken for UTC, whatever the session's zone.
    placed = events.withColumn("_at", F.timestamp_micros(micros(F.col(time)))).withWatermark("_at", f"{delay_days} days")
    grouped = placed.groupBy(F.window("_at", "1 day"), key).agg(best)

    def keep(changed: DataFrame, epoch: int) -> None:
        append_run(changed.select(key, "best.*").withColumn(EPOCH, F.lit(epoch)), path, EPOCH)

    return (
        grouped.writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_latest(
    spark: SparkSession, path: str, columns: Sequence[str], key: str = "event_id", newest: Sequence[str] = ("event_time", "arrival_ts")
) -> DataFrame:
    """One row for each key from what the stream has written: the newest over micro-batches and days."""
    return latest_per_key(spark.read.parquet(path).select(*columns), [key], list(newest))


def late_rows(query: StreamingQuery) -> int:
    """Events that the query's recent micro-batches left out as older than the watermark."""
    return sum(state["numRowsDroppedByWatermark"] for step in query.recentProgress for state in step["stateOperators"])


def state_rows(query: StreamingQuery) -> int:
    """Rows of state after the last micro-batch."""
    return sum(state["numRowsTotal"] for state in query.lastProgress["stateOperators"])
