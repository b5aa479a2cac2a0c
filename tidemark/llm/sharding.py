"""Put documents into shards of near equal bytes by sampled splitters.

Records are range-partitioned by a hash of their text, so equal texts lie next to each other. The
splitters are quantiles of a sample in which a record's chance is its size. The ranges are then
counted exactly, and ranges that got too many bytes or rows are subdivided: by a hash of the text, and
a text that is too much for one piece by itself by a hash of its records. Records equal in all are one row with a count
there, and the count is dealt over the pieces, so that a piece is small whatever repeats. Ranges and pieces are
far smaller than shards and are dealt to the shards in order by the exact bytes before their middle.

Law `bytes`: sizes of shards differ by about one range (a 64th of a shard) or one document. Equal
texts share a shard unless they alone are more than a range. Hashes decide, so reruns agree.

Defined results: a NULL text has no bytes and counts as equal to the empty text; NULL ids are one id;
equal rows are separate records that differ in slot and may differ in shard; a table without rows gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import settle, table

SHARDS = 40
# Bytes a record costs beyond its text.
OVERHEAD = 16
# Ranges a shard; more if a range would otherwise pass the byte limit of one task.
RANGES = 64
RANGE_BYTES = 256 << 20
# Also subdivided: ranges with more rows than this.
RANGE_ROWS = 1_000_000
# Sampled records a range.
SAMPLED = 16
# Splitters are held by every task: 8 bytes each. Ranges that are too large for it are subdivided.
MOST_RANGES = 1 << 16


def _unit(*parts: Column) -> Column:
    """Hash in [0, 1) with 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _splitters(rows: DataFrame, ranges: int, total: int) -> DataFrame:
    """One row with the sorted inner quantiles of the keys in a size-weighted sample.

    A record is drawn with chance min(1, size / step) and then stands for max(step, size) bytes.
    The sample has about `ranges * SAMPLED` records whatever the table's size.
    """
    step = max(1.0, total / (ranges * SAMPLED))
    drawn = rows.filter(_unit(F.col("key"), F.col("id"), F.lit("draw")) * step < F.col("size"))
    stands = F.greatest(F.lit(1), F.round(F.col("size") / step)).cast("long")
    at = F.lit([i / ranges for i in range(1, ranges)])
    return settle(drawn.agg(F.percentile("key", at, stands).alias("splitters")))


def _in_range(rows: DataFrame, splitters: DataFrame, ranges: int) -> DataFrame:
    """Add the range: how many splitters are not above the key, by a binary search in 2-power steps."""
    held = splitters.scalar()
    rows = rows.withColumn("range", F.lit(0))
    for bit in reversed(range(max(1, (ranges - 1).bit_length()))):
        there = F.coalesce(F.get(held, F.col("range") + ((1 << bit) - 1)) <= F.col("key"), F.lit(False))
        rows = rows.withColumn("range", F.col("range") + F.when(there, 1 << bit).otherwise(0))
    return rows


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    ranges: int = RANGES,
    range_rows: int = RANGE_ROWS,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Frame (doc_id, size, text_crc32, shard, slot), one row per document.

    Texts are read once and not shuffled: slim rows (id, size, hashes) are written and worked on.
    """
    known = F.coalesce(F.col(text), F.lit(""))
    rows = settle(
        docs.select(
            F.col(doc_id).alias("id"),
            (F.octet_length(known) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(known, "UTF-8")).alias("text_crc32"),
            _unit(known).alias("key"),
        )
    )
    total = rows.agg(F.sum("size")).first()[0] or 0
    wanted = min(max(shards * ranges, 2, -(-total // RANGE_BYTES)), MOST_RANGES)
    splitters = _splitters(rows, wanted, total)
    placed = settle(_in_range(rows, splitters, wanted))
    counted = placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    limit = max(1, min(2 * total // wanted, 2 * RANGE_BYTES))
    pieces = F.ceil(F.greatest(F.col("bytes") / limit, F.col("rows") / range_rows)).cast("int")
    cuts = settle(counted.select(F.col("range").alias("cut_range"), pieces.alias("pieces")).filter("pieces > 1"))
    cut = placed.join(cuts, F.col("range") == F.col("cut_range"), "left").drop("cut_range")
    single = cut.filter("pieces IS NULL").drop("pieces").withColumns({"sub": F.lit(0), "n": F.lit(1).cast("long")})
    return _dealt(single.unionByName(_subdivided(cut.filter("pieces IS NOT NULL"), limit, range_rows)), shards, total)


def _subdivided(rows: DataFrame, limit: int, range_rows: int) -> DataFrame:
    """Rows of the ranges to be cut with their piece `sub`, equal ones of a piece as one row that stands for `n`.

    At most total / limit texts are too much for a piece; each piece takes its share of their records.
    """
    same = rows.columns
    rows = settle(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")))
    texts = rows.groupBy("range", "key").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows"))
    large = settle(texts.filter((F.col("bytes") > limit) | (F.col("rows") > range_rows)).select("range", "key"))
    pieces, columns = F.col("pieces"), [name for name in same if name != "pieces"]
    whole = F.floor(_unit(F.col("key"), F.lit("cut")) * pieces).cast("int").alias("sub")
    whole = rows.join(large, ["range", "key"], "left_anti").select(*columns, whole, "n")
    first = F.floor(_unit(F.col("id"), F.col("key"), F.lit("cut")) * pieces).cast("int")
    dealt = rows.join(large, ["range", "key"], "left_semi").withColumn("first", first)
    dealt = dealt.withColumn("turn", F.explode(F.sequence(F.lit(0), F.least(F.col("n").cast("int"), pieces) - 1)))
    share = F.floor(F.col("n") / pieces) + (F.col("turn") < F.col("n") % pieces).cast("long")
    sub = ((F.col("first") + F.col("turn")) % pieces).alias("sub")
    return whole.unionByName(dealt.select(*columns, sub, share.alias("n")))


def _dealt(pieced: DataFrame, shards: int, total: int) -> DataFrame:
    """Pieces to shards in order; slots run through a shard piece by piece, and through the records of a row."""
    bytes_of, rows_of = F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("rows")
    whole = pieced.groupBy("range", "sub").agg(bytes_of, rows_of)
    in_order = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(in_order), F.lit(0))
    middle = (before + F.col("bytes") / 2) * shards / F.lit(float(max(1, total)))
    dealt = whole.withColumn("shard", F.least(F.floor(middle), F.lit(shards - 1)).cast("int"))
    in_shard = Window.partitionBy("shard").orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("rows").over(in_shard), F.lit(0))
    plan = settle(
        dealt.select(F.col("range").alias("r"), F.col("sub").alias("s"), "shard", first.alias("first_slot"))
    )
    in_piece = Window.partitionBy("range", "sub").orderBy("key", "id", "text_crc32", "size")
    earlier = F.coalesce(F.sum("n").over(in_piece.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = pieced.withColumn("number", earlier)
    joined = numbered.join(plan, (F.col("range") == F.col("r")) & (F.col("sub") == F.col("s")))
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    slot = (F.col("first_slot") + F.col("number") + F.col("copy")).cast("long")
    return each.select(F.col("id").alias("doc_id"), "size", "text_crc32", "shard", slot.alias("slot"))


def op6_sharding(spark, folder):
    """All documents in shards 0 to 39 of near equal bytes."""
    placed = shard(table(spark, folder, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
