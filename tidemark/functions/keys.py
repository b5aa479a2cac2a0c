"""Surrogate keys: hashed ones that survive rebuilds, and dense numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import micros
from tidemark.operators.skew import HOT_ROWS, settle
from tidemark.session import setting

ROWS_PER_PARTITION_BITS = 33
# Length of a packed md5; any other key is packed behind one byte more than that.
DIGEST_BYTES = 16
OTHER = bytes(DIGEST_BYTES + 1)


def version_key(key: str, start: str = "start_date", source: str = "source_event_id") -> Column:
    """Key of one dimension version; equal inputs give equal keys after any rebuild."""
    return F.md5(F.concat_ws("||", F.col(key), micros(F.col(start)), F.col(source)))


def natural_key(*names: str) -> Column:
    return F.md5(F.concat_ws("||", *[F.col(name).cast("string") for name in names]))


def packed(key: str) -> Column:
    """A key as bytes, for rows that are moved: an md5 in hexadecimal takes half of its characters, any other text keeps them."""
    digest = F.col(key).rlike(f"^[0-9a-f]{{{2 * DIGEST_BYTES}}}\\z")
    return F.when(digest, F.unhex(key)).otherwise(F.concat(F.lit(OTHER), F.col(key).cast("binary")))


def unpacked(key: str) -> Column:
    """The text that was `packed`."""
    digest = F.octet_length(key) == DIGEST_BYTES
    return F.when(digest, F.lower(F.hex(key))).otherwise(F.substr(key, F.lit(len(OTHER) + 1)).cast("string"))


def moved(df: DataFrame, *names: str) -> DataFrame:
    """A frame with those of the keys `packed` that are text."""
    return df.withColumns({name: packed(name) for name in names if is_text(df, name)})


def is_text(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] == "string"


def date_key(date: str) -> Column:
    """Calendar date as yyyymmdd."""
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def with_dense_key(
    df: DataFrame, order: Sequence[str], name: str = "dense_sk", partitions: int | None = None
) -> DataFrame:
    """Number the rows 1..n in `order` without putting them into one task.

    Rows are range-partitioned and sorted once; monotonically_increasing_id then holds the
    partition number above its low 33 bits and the position inside the partition in them. Only
    one count per partition is summed globally. The sorted rows are written out because numbers and
    counts must come from the same range boundaries.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = settle(
        ranged.sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_place", ROWS_PER_PARTITION_BITS))
        .withColumn("_row", F.col("_place").bitwiseAND(F.lit((1 << ROWS_PER_PARTITION_BITS) - 1)))
        .drop("_place"),
        "zstd",
    )
    # One row per partition: bounded by the partition count, whatever the data size.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_row") + 1)
        .drop("_part", "_row", "_offset")
    )


def with_grouped_key(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of a written table 1..n in an `order` that begins with a column of few values, such as days.

    The numbers of a value start after the counts of those before, so that the rows are shuffled once, to ranges of
    values, and need not be written again to be counted. A value with over hotRows rows (spark.tidemark.hotRows) is cut
    into slices by hash, which are counted too; there the order holds within each slice.
    """
    group = order[0]
    limit = setting(rows.sparkSession, "hotRows", HOT_ROWS)
    large = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > limit)
    # Fewer rows than rows / hotRows.
    large = settle(large.select(F.col(group).alias("_large"), F.ceil(F.col("_rows") / limit).alias("_slices")))
    sliced = rows.join(F.broadcast(large), F.col(group).eqNullSafe(F.col("_large")), "left")
    slice_of = F.coalesce(F.pmod(F.xxhash64(*order), F.col("_slices")), F.lit(0))
    sliced = sliced.withColumn("_slice", slice_of).drop("_large", "_slices")
    # One row for each group and slice.
    sizes = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(group, "_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col(group).alias("_group"), F.col("_slice").alias("_of"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(group, "_slice").orderBy(*order)
    numbered = sliced.repartitionByRange(group, "_slice").withColumn("_number", F.row_number().over(inside))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_of"))
    placed = numbered.join(F.broadcast(starts), same).withColumn(name, F.col("_start") + F.col("_number"))
    return placed.select(*rows.columns, name)
