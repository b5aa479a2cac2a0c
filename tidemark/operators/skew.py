"""Joins and per-key ordered passes that hold when one key owns a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import freed_shuffles, setting, work_folder

# A key with more rows than this is spread over several tasks (spark.tidemark.hotRows).
HOT_ROWS = 5_000_000
# Versions up to this many are broadcast to facts (spark.tidemark.broadcastRows).
BROADCAST_ROWS = 200_000
SEGMENT = "_segment"


@dataclass(frozen=True)
class HotKeys:
    keys: DataFrame
    rows: int


def large_keys(counts: DataFrame, key: str) -> HotKeys | None:
    """Keys whose `count` exceeds hotRows.

    A frame of N rows has fewer than N / hotRows of them (200 000 in 10^12 rows at the default),
    so the list, which stays a written frame, is small enough for a broadcast.
    """
    limit = setting(counts.sparkSession, "hotRows", HOT_ROWS)
    found = counts.filter(F.col(key).isNotNull() & (F.col("count") > limit))
    rows = found.agg(F.sum("count")).first()[0]
    return HotKeys(settle(found.select(key)), rows) if rows else None


def hot_keys(df: DataFrame, key: str) -> HotKeys | None:
    """Large keys of a frame; counting reads one column and combines before its shuffle."""
    return large_keys(df.groupBy(key).count(), key)


def settle(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Compute a derived frame once, as a table in the shared folder, for several readers."""
    path = work_folder(df.sparkSession, "settled")
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_lookup(big: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join `big` to a frame with at most one row per key (left, inner, left_semi, left_anti).

    Spark broadcasts a lookup whose written size is below its limit. Else both sides are shuffled
    once, and adaptive execution splits what a hot key, or the rows without a key, put into one
    partition of `big`; nothing is counted beforehand. Settle a lookup that is costly to derive.
    """
    return big.join(lookup, key, how)


@dataclass(frozen=True)
class Ordered:
    """Rows of each key in ascending `order`, ready for lag, lead and running-last.

    Keys of ordinary size form one window group each. The rows of hot keys are range-partitioned
    by (key, order), each range being a segment and a group of its own; what crosses a segment
    border is carried over from one summary row per key and segment.
    """

    rows: DataFrame
    key: str
    order: tuple[str, ...]
    split: bool = False

    @classmethod
    def by(
        cls,
        df: DataFrame,
        key: str,
        order: Sequence[str],
        counts_from: DataFrame | None = None,
        unique: bool = False,
    ) -> Ordered:
        """`counts_from`: cheaper frame whose rows per key are no fewer than those of `df`.

        Unless `unique` says that no two rows of a key are equal in `order`, hot rows are numbered
        first, so that even a range of equal rows can be cut into segments. The numbers are taken
        from a written table, where a repeated task finds the same rows in the same order.
        """
        hot = hot_keys(df if counts_from is None else counts_from, key)
        if hot is None:
            return cls(df, key, tuple(order))
        few = F.broadcast(hot.keys)
        parts = 1 + math.ceil(2 * hot.rows / setting(df.sparkSession, "hotRows", HOT_ROWS))
        cold = df.join(few, key, "left_anti").withColumn(SEGMENT, F.lit(0))
        hot_rows, position = df.join(few, key, "left_semi"), [key, *order]
        if not unique:
            hot_rows = settle(hot_rows).withColumn("_number", F.monotonically_increasing_id())
            position.append("_number")
        # Written out: every later pass has to see the same range boundaries.
        spread = settle(
            hot_rows.repartitionByRange(parts, *position)
            .withColumn(SEGMENT, F.spark_partition_id() + 1)
            .drop("_number")
        )
        return cls(cold.unionByName(spread), key, tuple(order), True)

    def _window(self) -> Window:
        groups = [self.key, SEGMENT] if self.split else [self.key]
        return Window.partitionBy(*groups).orderBy(*self.order)

    def _position(self) -> Column:
        return F.struct(*self.order)

    def _with_carry(self, edge: Column, shift: Column) -> DataFrame:
        # One row per hot key and segment: bounded by hot keys + segments, hence the broadcast.
        groups = [self.key, SEGMENT]
        edges = self.rows.filter(F.col(SEGMENT) > 0).groupBy(*groups).agg(edge.alias("_edge"))
        carried = edges.select(*groups, shift.alias("_carry"))
        return self.rows.join(F.broadcast(carried), groups, "left")

    def _segments(self) -> Window:
        return Window.partitionBy(self.key).orderBy(SEGMENT)

    def _add(self, name: str, inside: Column, edge: Column, shift: Column) -> Ordered:
        if not self.split:
            return replace(self, rows=self.rows.withColumn(name, inside))
        rows = self._with_carry(edge, shift)
        return replace(self, rows=rows.withColumn(name, F.coalesce(inside, "_carry")).drop("_carry"))

    def _neighbour(self, value: str, name: str, step: Callable, edge: Callable) -> Ordered:
        # Held in a struct, a NULL value of a neighbour differs from having none.
        held = F.struct(F.col(value).alias("value"))
        done = self._add(name, step(held).over(self._window()), edge(held, self._position()), step("_edge").over(self._segments()))
        return replace(done, rows=done.rows.withColumn(name, F.col(name)["value"]))

    def previous(self, value: str, name: str) -> Ordered:
        """Add the value of the row before, NULL if it is NULL or there is none."""
        return self._neighbour(value, name, F.lag, F.max_by)

    def following(self, value: str, name: str) -> Ordered:
        """Add the value of the row after, NULL if it is NULL or there is none."""
        return self._neighbour(value, name, F.lead, F.min_by)

    def latest(self, value: str, name: str) -> Ordered:
        """Add the last non-NULL value up to and including the row."""
        running = self._window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        earlier = self._segments().rowsBetween(Window.unboundedPreceding, -1)
        return self._add(
            name,
            F.last(value, ignorenulls=True).over(running),
            F.max_by(F.col(value), F.when(F.col(value).isNotNull(), self._position())),
            F.last("_edge", ignorenulls=True).over(earlier),
        )

    def filter(self, condition: Column) -> Ordered:
        return replace(self, rows=self.rows.filter(condition))

    def frame(self) -> DataFrame:
        return self.rows.drop(SEGMENT) if self.split else self.rows


def prefix_sum(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows up to and including each one, in a strict `order`.

    Rows are range-partitioned once; a range starts from the sum of the ranges before it, which comes
    from one row for each range. No window runs over the whole frame.
    """
    ranged = settle(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range").agg(F.sum(value).alias("_sum"))
    sums = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # As many rows as ranges.
    placed = ranged.join(F.broadcast(settle(sums)), "_range")
    return placed.withColumn(name, F.col("_before") + F.sum(value).over(inside)).drop("_range", "_before")
