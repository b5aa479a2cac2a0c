"""Change hash over the tracked attributes of an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "||"
MISSING = "\u001f"


def hash_diff(tracked: Sequence[str], null_safe: bool = False) -> Column:
    """md5 of the joined attributes.

    The plain form skips NULLs, so (a, NULL, b) and (a, b, NULL) hash alike; `null_safe` marks
    each missing value so that they differ.
    """
    columns = [F.col(name).cast("string") for name in tracked]
    if null_safe:
        columns = [F.coalesce(column, F.lit(MISSING)) for column in columns]
    return F.md5(F.concat_ws(SEPARATOR, *columns))


def with_hash(df: DataFrame, tracked: Sequence[str], null_safe: bool = False) -> DataFrame:
    return df.withColumn("hash_diff", hash_diff(tracked, null_safe))
