"""Words and small frame helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.skew import settle

__all__ = ["WORD", "cast_to", "count_words", "in_few_tasks", "settle", "table", "with_package", "words"]

# A word: a run of code points other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Words of a text in order; NULL has none."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.coalesce(column, F.lit("")), F.lit(WORD), F.lit(0))


def count_words(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cast_to(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns only, in the given order and types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in kinds.items()])


def in_few_tasks(df: DataFrame, rows: int, each: int = 20_000) -> DataFrame:
    """A frame whose last stage reads at most `rows` rows, in no more tasks than those need, but one for each core.

    A small table is else read and written by as many tasks as the session has shuffle partitions.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // each))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


# Rows that go to a Python worker at a time, unless the session sets a number: texts may be long.
BATCH, SETTING, DEFAULT = "1000", "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def with_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, beside where they have it.

    Also makes Arrow batches smaller than Spark's own number, which is meant for short rows.
    """
    if spark.conf.get(SETTING) == DEFAULT:
        spark.conf.set(SETTING, BATCH)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])
    return spark
