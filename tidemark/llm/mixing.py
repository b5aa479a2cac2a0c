"""Mix sources to target weights by systematic sampling.

Every document of a source is expected the same number of times, its source's target divided by the
source's size. The expected copies are summed up in one order over the whole source, one random
offset is added, and a document is emitted once for every whole number that its stretch of the sum
crosses. Expected copies are whole multiples of 2**-24, so the sums are exact in any order of tasks.

The order is by size. A document's copies then differ from expectation by less than one, and what
is missing so far never reaches one copy, so the words taken of a source differ from its target by
no more than its longest document (plus 2**-24 of its size).

Defined results: a NULL text has size 0; NULL sources form one source, sorted last; a source
without words has target 0 and none of its documents are taken; equal rows are separate documents;
a table without rows gives none. Documents travel as one struct, so no column name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import count_words, settle

# One expected copy. 2**24 of them a document, times 3, leaves room for 10**11 documents in a long.
UNIT = 1 << 24
WEIGHTS = (5, 2, 1)
# A source is taken this many times at most.
MOST = 3
SEED = 17
# Positions within a partition are the low bits of monotonically_increasing_id().
IN_PARTITION = (1 << 33) - 1


def _offset(source: str, seed: int) -> Column:
    """The random offset of a source, below UNIT: 24 bits of a hash."""
    known = F.coalesce(F.concat(F.lit(f"{seed}:s"), F.col(source)), F.lit(f"{seed}:n"))
    return F.conv(F.substring(F.md5(known), 1, 6), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Frame (source, source_size) with each source's target.

    Sources in code point order, NULL last, weigh as given, again and again, and share the sum of
    all sizes. A target stops at `most` times the source's size; what is over is shared by weight
    until no target is above. That is the one level at which min(most * size, level * weight) adds
    up to the sum: going through the sources by rising size / weight, the first that is not
    stopped fixes the level. One row per source, so the windows over all rows hold only those.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = sizes.withColumn("turn", F.row_number().over(by_name)).withColumn("weight", weight)
    ranked = ranked.withColumn("stop", F.col("source_size").cast("double") * most)
    everything = Window.partitionBy()
    rising = Window.orderBy(F.col("stop") / F.col("weight"), "turn").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        ranked.withColumn("stopped_before", F.coalesce(F.sum("stop").over(rising), F.lit(0.0)))
        .withColumn("weight_before", F.coalesce(F.sum("weight").over(rising), F.lit(0.0)))
        .withColumn("left", F.sum(F.col("source_size").cast("double")).over(everything) - F.col("stopped_before"))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.col("weight_before"))
    )
    free = F.col("stop") * F.col("weight_left") >= F.col("left") * F.col("weight")
    level = F.max(F.when(free, F.col("left") / F.col("weight_left"))).over(everything)
    share = F.least(F.col("weight") * level, "stop")
    return ranked.withColumn("target", share).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    keep: Sequence[str],
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Frame (row, size, source_size, target, copies): `row` has the `keep` columns of a document.

    One range shuffle by (source, size, id) of the kept columns; a hot source lies in many ranges.
    How many documents of the source lie in earlier ranges comes from one row per range and source.
    """
    spark = docs.sparkSession
    size = count_words(text)
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = settle(source_targets(sizes, weights, most)).withColumnRenamed("source", "name")
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col(source).alias("source"),
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("tie"),
        size.alias("size"),
    )
    order = ["source", "size", "id", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(
        ranged.withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
        .withColumn("at", F.col("at").bitwiseAND(F.lit(IN_PARTITION)))
        .drop("id", "tie")
    )
    runs = placed.groupBy("source", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # Spark broadcasts this by its written size, or else splits hot sources in a sort-merge join.
    plan = settle(
        starts.join(targets, F.col("source").eqNullSafe(F.col("name")))
        .withColumn("share", F.coalesce(F.floor(F.try_divide("target", "source_size") * UNIT), F.lit(0)))
        .withColumn("offset", _offset("source", seed))
        .select("name", F.col("part").alias("run"), "before", "first", "source_size", "target", "share", "offset")
    )
    joined = placed.join(plan, (F.col("part") == F.col("run")) & F.col("source").eqNullSafe(F.col("name")))
    rank = F.col("before") + F.col("at") - F.col("first")
    crossed = [F.shiftright((rank + k) * F.col("share") + F.col("offset"), 24) for k in (0, 1)]
    return joined.select("row", "size", "source_size", "target", (crossed[1] - crossed[0]).alias("copies"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns it came with."""
    mixed = mix(docs, docs.columns, **settings).filter(F.col("copies") > 0)
    repeated = mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select("row.*")


def op1_mix(spark, folder):
    """All documents with the words the mix takes of each."""
    from tidemark.llm.text import table

    mixed = mix(table(spark, folder, "documents"), ["doc_id"])
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken, "copies")
