"""Structured Streaming entry: every micro-batch of new feed files is one published run."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.plans.medallion import Layout, run_batch
from tidemark.sources.files import typed
from tidemark.sources.warehouse import Warehouse


def utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


def _header(wh: Warehouse, folder: str, layout: Layout) -> list[str]:
    """Column names of the files that are there, or of the declared feed while there are none."""
    try:
        return wh.spark.read.option("header", True).csv(folder).columns
    except AnalysisException as error:
        if error.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        return layout.feed.names


def stream_feed(
    wh: Warehouse,
    folder: str,
    checkpoint: str,
    name: str,
    layout: Layout | None = None,
    as_of: Callable[[], datetime] = utc_now,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process all files not seen before, then stop.

    The file source does not notice lines added to a file it has read; deliver new files, all with
    the header of the first ones. Run ids carry the id that the checkpoint gives the query: a
    micro-batch that is retried is published once, and a new checkpoint repeats no earlier id.
    """
    layout = layout or Layout()
    text = T.StructType([T.StructField(column, T.StringType()) for column in _header(wh, folder, layout)])
    reader = wh.spark.readStream.schema(text).option("header", True).option("enforceSchema", False)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def load(rows: DataFrame, epoch: int) -> None:
        own = json.loads(wh.spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        run_batch(wh, typed(rows, layout.feed), as_of(), f"{name}-{own}-{epoch}", layout)

    return (
        reader.csv(folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
