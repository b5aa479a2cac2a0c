"""Join of rows at a time to all time windows of their key that hold it, by time buckets."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import micros

BUCKET = "_bucket"
# What a copy of a window, which is shuffled and sorted, costs in windows tested in vain. Any number gives the same rows.
COPY = 16


@dataclass(frozen=True)
class Buckets:
    """Times from `first` to `last` in buckets of `width`, all in microseconds."""

    first: int
    last: int
    width: int


def choose_buckets(rows: DataFrame, windows: DataFrame, key: str, time: str) -> Buckets | None:
    """Buckets for which copies of windows and pairs tested in vain cost least together; None without any times.

    A window of span s gets about s / width copies. A row is tested with the windows of its key that touch
    its bucket, about width * windows / period of which do not hold it. Both are summed from one count
    of rows and of windows for each key, so that a hot key weighs as much as it costs.
    """
    at = micros(F.col(time))
    first, last = rows.agg(F.min(at), F.max(at)).first()
    if first is None:
        return None
    period = last - first + 1
    begin = F.greatest(micros(F.col("start_date")), F.lit(first))
    end = F.least(F.coalesce(micros(F.col("end_date")), F.lit(last + 1)), F.lit(last + 1))
    span = F.greatest(end - begin, F.lit(0)).cast("double")
    held = windows.groupBy(key).agg(F.sum(span).alias("spans"), F.count(F.lit(1)).alias("windows"))
    counted = held.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")), key)
    tested = F.col("windows").cast("double") * F.col("rows") / period
    spans, rate = counted.agg(F.sum("spans"), F.sum(tested)).first()
    width = math.sqrt(COPY * spans / rate) if spans and rate else period
    return Buckets(first, last, max(1, min(period, math.ceil(width))))


def join_valid(
    rows: DataFrame, windows: DataFrame, key: str, time: str, carry: Sequence[str], buckets: Buckets | None = None
) -> DataFrame:
    """Every row with the `carry` columns of each window that holds its time, or NULLs.

    Windows go from `start_date` on, up to and without `end_date` (NULL: no end). They are copied to the buckets
    they touch, and the join is on key and bucket, so that the rows of one key lie in as many groups as
    there are buckets; Spark splits a group that is still too large. The window is tested in the join.
    Rows without key or time find nothing and stay out of the shuffle.
    """
    keyed = F.col(key).isNotNull() & F.col(time).isNotNull()
    rest = rows.filter(~keyed)
    buckets = buckets or choose_buckets(rows.filter(keyed), windows, key, time)
    if buckets is None:
        kinds = dict(windows.dtypes)
        return rows.select(*rows.columns, *[F.lit(None).cast(kinds[name]).alias(name) for name in carry])

    def bucket(moment: Column) -> Column:
        return F.floor((moment - buckets.first) / buckets.width)

    begin = F.greatest(micros(F.col("start_date")), F.lit(buckets.first))
    last = F.least(F.coalesce(micros(F.col("end_date")) - 1, F.lit(buckets.last)), F.lit(buckets.last))
    held = windows.filter(F.col(key).isNotNull() & F.col("start_date").isNotNull())
    held = held.select(key, "start_date", "end_date", *[c for c in carry if c not in (key, "start_date", "end_date")])
    touched = F.explode(F.sequence(bucket(begin), bucket(last)))
    held = held.filter(begin <= last).withColumn(BUCKET, touched)
    held = held.toDF(*[f"_w_{name}" for name in held.columns])
    placed = rows.filter(keyed).withColumn(BUCKET, bucket(micros(F.col(time))))
    holds = (
        (F.col(key) == F.col(f"_w_{key}"))
        & (F.col(BUCKET) == F.col(f"_w_{BUCKET}"))
        & (F.col(time) >= F.col("_w_start_date"))
        & (F.col("_w_end_date").isNull() | (F.col(time) < F.col("_w_end_date")))
    )
    # Spark cannot tell how many copies there are, so it must not take the side for small enough to broadcast.
    joined = placed.join(held.hint("merge"), holds, "left")
    joined = joined.select(*rows.columns, *[F.col(f"_w_{name}").alias(name) for name in carry])
    return joined.unionByName(rest, allowMissingColumns=True)
