"""JDBC tables read and written over several connections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _bounds(spark: SparkSession, url: str, table: str, column: str, properties: Mapping[str, str]) -> tuple:
    query = f"(SELECT min({column}) AS low, max({column}) AS high FROM {table}) bounds"
    return tuple(spark.read.jdbc(url, query, properties=dict(properties)).first())


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    column: str | None = None,
    partitions: int = 1,
) -> DataFrame:
    """Table scan; with a numeric, date or timestamp `column`, split into that many range reads.

    The database computes the range once. Timestamps come back zone-free.
    """
    if column is None or partitions <= 1:
        df = spark.read.jdbc(url, table, properties=dict(properties))
    else:
        low, high = _bounds(spark, url, table, column, properties)
        if low is None:
            df = spark.read.jdbc(url, table, properties=dict(properties))
        else:
            df = spark.read.jdbc(
                url, table, column=column, lowerBound=str(low), upperBound=str(high),
                numPartitions=partitions, properties=dict(properties),
            )
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def write_table(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
    partitions: int | None = None, truncate: bool = False,
) -> None:
    """Write by column name. `truncate` empties an overwritten table and keeps its definition."""
    writer = df.write.mode(mode).option("truncate", truncate)
    if partitions:
        writer = writer.option("numPartitions", partitions)
    writer.jdbc(url, table, properties=dict(properties))
