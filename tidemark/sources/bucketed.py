"""Tables that keep the partitioning of a join or a window: bucketed and sorted by key, in the session's catalog."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.session import work_folder


def bucketed_table(df: DataFrame, key: str, order: Sequence[str], buckets: int, name: str = "bucketed") -> DataFrame:
    """Write a frame as a table of one file for each bucket, in the shared folder, and read it back.

    What groups or joins it by `key` needs no shuffle of it; the other side comes to it with
    `repartition(buckets, key)`. Scale `buckets` with the table: a bucket is what one task reads.
    """
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key, *order)
    writer.option("path", work_folder(df.sparkSession, name)).saveAsTable(table)
    return df.sparkSession.table(table)
