"""Newest copy per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Keep the row with the greatest `newest` values per key; remaining columns settle ties.

    The rank filter lets Spark cut every map task to one row per key before the shuffle, so a key
    with very many copies sends no more than one row per map task.
    """
    if tiebreak is None:
        tiebreak = [name for name in df.columns if name not in {*keys, *newest}]
    order = [F.col(name).desc_nulls_last() for name in [*newest, *tiebreak]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key_by_max(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """The same answer as an aggregate over structs, combined before the shuffle.

    Struct comparison puts NULL lowest, which matches descending order with NULLs last.
    """
    rest = [name for name in df.columns if name not in {*keys, *newest}]
    if tiebreak is not None:
        rest = [*tiebreak, *[name for name in rest if name not in tiebreak]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*newest, *rest)).alias("_best"))
    picked = {name: F.col(f"_best.{name}") for name in [*newest, *rest]}
    return best.withColumns(picked).select(*df.columns)


def merge_latest(stored: DataFrame, arrived: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Newest copy per key over already deduplicated rows and newly arrived ones."""
    return latest_per_key(stored.unionByName(arrived), keys, newest)
