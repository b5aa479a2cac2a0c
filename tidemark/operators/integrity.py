"""Table constraints as queries that return what breaks them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import current
from tidemark.operators.skew import Ordered, join_lookup


def repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values found more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def several_current(dim: DataFrame, key: str = "customer_id") -> DataFrame:
    return repeated(current(dim), [key])


def orphans(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Non-NULL fact keys without a dimension row, with the number of facts."""
    used = facts.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("facts"))
    return join_lookup(used, dim.select(key).distinct(), key, "left_anti")


def null_counts(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: NULLs per required column."""
    return df.agg(*[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in required])


def broken_borders(dim: DataFrame, key: str = "customer_id", tiebreak: str = "source_event_id") -> DataFrame:
    """Versions whose end is not the start of the next one (overlap, gap or open end in between)."""
    placed = dim.withColumn("_open", F.col("end_date").isNull())
    rows = Ordered.by(placed, key, ("start_date", "_open", "end_date", tiebreak)).following("start_date", "next_start")
    differs = ~F.col("end_date").eqNullSafe(F.col("next_start"))
    return rows.frame().filter(differs).select(key, "start_date", "end_date", "next_start")


def starting_after(dim: DataFrame, moment: Column) -> DataFrame:
    """Versions that start in the future."""
    return dim.filter(F.col("start_date") > moment)
