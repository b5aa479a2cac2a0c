"""Merkle manifest of a dataset: one root for all rows, and for each row the proof that leads to it.

Leaves are digests of rows, numbered by (source, id) in one range shuffle. A tree of runs of FAN joins the
leaves of each source to its subroot, another one the subroots to the root. Every level is a written table
whose rows are runs; from it come the links, one for each node: its parent, and the digests that stand
before and after it in its run. A recursive query starts at each leaf with the digest of a row that may have been
tampered with, ascends link by link, takes the siblings along and folds them around what it holds.

The climb is two recursive queries with a written table in between: one over the links of the lowest LOW
levels, which are most, and one over those above, which are few enough to be broadcast for all but very
large tables. So no step reads links it cannot need, and the lineage stays short.

Defined results: a NULL value counts as `-`; NULL ids and sources come first; rows equal in id go by their
leaves, and rows equal in all columns are interchangeable, each with a place and a proof of its own; a
source with one row has its leaf as subroot, a table with one source its subroot as root; a proof without
siblings is the digest of the empty text; NULL ids are never tampered with; an empty table gives no
rows. Only the five columns are read, whatever others there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import settle, table

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 3
# Levels whose links the first climb reads; those above have 1 / FAN**LOW as many nodes as there are leaves.
LOW = 6
# A node is known by its first leaf and its level: first * LEVELS + level; above the subroots it is negative.
LEVELS = 64
IN_PARTITION = (1 << 33) - 1
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"

CLIMB = """
WITH RECURSIVE climb (leaf, step, node, digest, siblings) AS (
  SELECT leaf, step, node, digest, CAST(NULL AS BINARY) FROM {start}
  UNION ALL
  SELECT c.leaf, c.step + 1, l.parent,
         unhex(sha2(concat(lower(hex(l.before)), lower(hex(c.digest)), lower(hex(l.after))), 256)),
         concat(l.before, l.after)
  FROM climb c JOIN {links} l ON c.node = l.node
)
SELECT * FROM climb
"""


def _field(name: str, value: Column | None = None) -> Column:
    """`-`, or the number of bytes, a colon and the value."""
    text = (F.col(name) if value is None else value).cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def text_of(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows with their number, from 0, in a strict order: one range shuffle, then one row for each range."""
    placed = settle(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33))
    )
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    # As many rows as ranges.
    numbered = placed.join(F.broadcast(settle(starts)), "part")
    return numbered.withColumn("number", F.col("start") + F.col("at").bitwiseAND(F.lit(IN_PARTITION))).drop("at", "part", "start")


def leaves(docs: DataFrame) -> DataFrame:
    """Frame (doc_id, leaf, tampered, number, first, n): digests, place in the dataset, and the source's first place and rows."""
    untouched = _digest(*map(_field, FIELDS))
    shorter = F.replace("text", F.lit("\n"), F.lit(""))
    tampered = (F.crc32(F.col("doc_id").cast("string")) % 2 == 0) & F.contains("text", F.lit("\n"))
    rows = docs.select(
        "doc_id",
        "source",
        untouched.alias("leaf"),
        F.when(tampered, _digest(*map(_field, FIELDS[:-1]), _field("text", shorter))).alias("tampered"),
        F.monotonically_increasing_id().alias("row"),
    )
    # Written first: the ranges are sampled from digests, and rows equal in all else keep their number.
    numbered = settle(_numbered(settle(rows), ["source", "doc_id", "leaf", "row"]).drop("row"))
    sources = numbered.groupBy("source").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    sources = settle(sources.withColumnRenamed("source", "name"))
    # Spark broadcasts the sources by their written size, or else splits hot ones in a sort-merge join.
    return settle(numbered.join(sources, F.col("source").eqNullSafe(F.col("name"))).drop("source", "name"))


def _levels(n: int) -> int:
    """Levels of runs above n nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def _tree(nodes: DataFrame, most: int, sign: int) -> tuple[list[DataFrame], DataFrame]:
    """Links of each level, and the tops (first, node, digest) of the trees in `nodes` (first, n, place, node, digest).

    `most`: nodes of the largest tree. A run is a group of at most FAN rows.
    """
    links, tops, width = [], [], 1
    for level in range(1, _levels(most) + 1):
        tops.append(nodes.filter("n = 1"))
        width *= FAN
        members = F.sort_array(F.collect_list(F.struct("place", "node", "digest")))
        run = F.expr(f"place div {FAN}").alias("place")
        runs = nodes.filter("n > 1").groupBy("first", "n", run).agg(members.alias("members"))
        parent = (F.lit(sign) * ((F.col("first") + F.col("place") * width) * LEVELS + level)).alias("parent")
        whole = _digest(*[F.coalesce(text_of(F.get("members.digest", F.lit(k))), F.lit("")) for k in range(FAN)])
        runs = settle(runs.select("first", "n", "place", "members", parent, whole.alias("digest")))
        member = runs.select("parent", F.posexplode("members").alias("at", "member"), "members")
        beside = [F.coalesce(F.get("members.digest", F.lit(k)), F.lit(b"")) for k in range(FAN)]
        before = [F.when(F.col("at") > k, one).otherwise(F.lit(b"")) for k, one in enumerate(beside)]
        after = [F.when(F.col("at") < k, one).otherwise(F.lit(b"")) for k, one in enumerate(beside)]
        links.append(member.select("member.node", "parent", F.concat(*before).alias("before"), F.concat(*after).alias("after")))
        fewer = F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n")
        nodes = runs.select("first", fewer, "place", F.col("parent").alias("node"), "digest")
    tops.append(nodes.filter("n = 1"))
    return links, settle(reduce(DataFrame.unionByName, tops).select("first", "node", "digest"))


def _climbed(start: DataFrame, links: DataFrame) -> DataFrame:
    """Every step (leaf, step, node, digest, siblings) from `start` (leaf, step, node, digest) along the links, as a written table."""
    spark = start.sparkSession
    limit = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")  # a climb has as many rows as the dataset, times its levels
    try:
        return settle(spark.sql(CLIMB, start=start, links=links))
    finally:
        spark.conf.set(ROW_LIMIT, limit)


def manifest(docs: DataFrame) -> DataFrame:
    """Frame (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified): one row for each document."""
    rows = leaves(docs)
    ground = rows.select(
        "first",
        "n",
        (F.col("number") - F.col("first")).alias("place"),
        (F.col("number") * LEVELS).alias("node"),
        F.col("leaf").alias("digest"),
    )
    most = rows.agg(F.max("n")).first()[0] or 0
    below, subroots = _tree(ground, most, 1)
    counted = _numbered(subroots, ["first"]).select("node", "digest", F.col("number").alias("place"))
    many = counted.count()
    above, top = _tree(counted.withColumns({"first": F.lit(0).cast("long"), "n": F.lit(many).cast("long")}), many, -1)

    none = docs.sparkSession.createDataFrame([], "node long, parent long, before binary, after binary")
    low = settle(reduce(DataFrame.unionByName, below[:LOW], none))
    high = settle(reduce(DataFrame.unionByName, below[LOW:] + above, none))
    hops = sum(((F.col("n") > FAN**k).cast("int") for k in range(LOW)), F.lit(0))
    held = F.coalesce("tampered", "leaf").alias("digest")
    start = settle(rows.select(F.col("number").alias("leaf"), hops.alias("hops"), (F.col("number") * LEVELS).alias("node"), held))
    lower = _climbed(start.select("leaf", F.lit(0).alias("step"), "node", "digest"), low)
    ends = lower.join(start.select("leaf", F.col("hops").alias("step")), ["leaf", "step"])
    upper = _climbed(settle(ends.select("leaf", "step", "node", "digest")), high)

    steps = lower.unionByName(upper.filter(F.col("siblings").isNotNull()))
    taken = F.sort_array(F.collect_list(F.when(F.col("siblings").isNotNull(), F.struct("step", "siblings"))))
    folded = steps.groupBy("leaf").agg(F.max_by("digest", "step").alias("folded"), taken.alias("taken"))
    proof = F.sha2(F.array_join(F.transform("taken", lambda x: text_of(x["siblings"])), ""), 256)
    proofs = folded.select(F.col("leaf").alias("number"), text_of("folded").alias("folded_root"), proof.alias("proof_sha256"))
    (root,) = top.agg(F.any_value(text_of("digest"))).first()
    named = subroots.select("first", text_of("digest").alias("subroot"))
    found = rows.join(proofs, "number").join(named, "first").withColumn("root", F.lit(root).cast("string"))
    return found.select(
        "doc_id",
        text_of("leaf").alias("leaf"),
        "subroot",
        "root",
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with its proof, and whether what may have been tampered with still leads to the root."""
    return manifest(table(spark, folder, "documents"))
