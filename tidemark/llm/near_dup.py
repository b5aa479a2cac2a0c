"""Near duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Two collections of SIDE hashes are made, each of JOINED minhash values. A table's key is one hash of
the first collection with one of the second, so SIDE * SIDE tables need only 2 * SIDE * JOINED
minhash values. Two documents of similarity s share a table with a chance of
(1 - (1 - s**JOINED)**SIDE)**2: 0.9996 at 0.85, more above.

Documents with equal shingle sets are one class from the start. Classes that share a key are
candidates. A bucket of at most SMALL classes gives all its pairs. A larger one ties each class to its
first one, and is split by the next STEP hashes of either collection, again and again, so that
classes which differ part and the closest meet in a small bucket. Candidates are compared on their full sets,
and links joined to components.

What is left of the large buckets is exact: classes of a large bucket that the links found so far do not
join into one component are compared by their full sets. Shingles have one order, the rarer ones first as
far as SLOTS counts tell. Two sets that are similar enough share one of their first shingles, and the place of
the first they share bounds their overlap, so that pages on one template meet only if they are near copies. A
shingle of many classes is joined in blocks. Pairs of one component are not formed again.

Defined results: a text without words has an empty set and is linked with nothing; fewer words than
WIDTH are one shingle; NULL ids are one id, smaller ids come first, and a class of NULL ids alone
keeps NULL; rows equal in id and text are one document in `deduplicate`; an empty table gives none.
Only the id and the text are read, under names of this module.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bloom import fill, passes, words_for
from tidemark.llm.graph import components
from tidemark.llm.text import in_few_tasks, settle, table, with_package
from tidemark.llm.tokens import bites, mixed, release, shingles, word_hashes

WIDTH = 5
# Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
SIDE, JOINED = 9, 3
# Hashes of either collection that split a large bucket at a time; a power of two above SIDE * SIDE.
STEP, TABLES = 2, 128
SMALL = 64
# Counts that order shingles by how common they are: 8 MB in a task. Any order gives the same pairs.
SLOTS = 1 << 20
# Classes with one shingle that a task joins with others.
BLOCK = 2048
# Classes to be compared up to these many are broadcast (2 MB), or held as bits (60 MB), to pick out their texts before the shuffle.
FEW_ASKED, MOST_ASKED = 50_000, 50_000_000
# Texts, or pairs of them, that a task should have at least.
TEXTS = 2_000
_SEEDS = np.random.default_rng(11).integers(1, 1 << 63, 2 * SIDE * JOINED, dtype=np.uint64)

ROWS = "doc_id long, text_hash long, n_shingles long, class binary, hashes array<long>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of distinct shingles, class and the hashes of both collections for each document."""
    release()
    names = [field.split()[0] for field in ROWS.split(", ")]
    for batch, texts in bites(batches):
        sets = _sets(texts)
        filled = [s for s in sets if len(s)]
        hashes = iter(_collections(filled)) if filled else iter(())
        values = [next(hashes) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("text_hash"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                pa.array(values, pa.list_(pa.int64())),
            ],
            names,
        )


def _collections(sets: list[np.ndarray]) -> list[list[int]]:
    """For each set 2 * SIDE hashes, each of JOINED minhash values."""
    every, starts = np.concatenate(sets), np.cumsum([0, *map(len, sets[:-1])])
    found = np.zeros((2 * SIDE, len(sets)), np.uint64)
    for k, seed in enumerate(_SEEDS):
        least = np.minimum.reduceat((every ^ seed) * (seed | np.uint64(1)), starts)
        found[k // JOINED] = mixed(found[k // JOINED] + least)
    return found.T.copy().view(np.int64).tolist()


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    known = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
        F.col(text).cast("string").alias("text"),
    )
    with_package(docs.sparkSession)
    return settle(known.mapInArrow(_signatures, ROWS))


def _candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Distinct pairs (a, b) of nodes, a < b, that share a key, and (key, node) of the large buckets if there are any.

    A key's low bits are its table's number, so that rows are no more than a key and a node.
    """
    rows = classes.select("node", "hashes", F.explode(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))).alias("table"))
    rows, pairs, large = rows.select(_key(F.lit(0), F.col("table"), 0).alias("key"), "node"), [], None
    last, n = (SIDE - 1) // STEP + 1, None
    for level in range(last + 1):
        heads = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head"))
        heads = heads.filter("n > 1")
        heads = settle(in_few_tasks(heads, n) if level else heads)
        shared = rows.join(heads, "key")
        shared = settle(in_few_tasks(shared, 2 * n) if level else shared)
        few = shared.filter(F.col("n") <= SMALL).select("key", "node")
        others = few.select("key", F.col("node").alias("b"))
        pairs.append(few.join(others, "key").filter("node < b").select(F.col("node").alias("a"), "b"))
        many = shared.filter(F.col("n") > SMALL)
        pairs.append(many.filter("head < node").select(F.col("head").alias("a"), F.col("node").alias("b")))
        if level == last or not (n := many.count()):
            break
        large = many.select("key", "node") if large is None else large
        rows = many.select("node", "key").join(classes.select("node", "hashes"), "node")
        table = F.col("key").bitwiseAND(F.lit(TABLES - 1))
        rows = settle(rows.select(_key(F.col("key"), table, 1 + level * STEP).alias("key"), "node"))
    found = pairs[0]
    for more in pairs[1:]:
        found = found.unionByName(more)
    return settle(found.distinct()), large


def _key(before: Column, table: Column, first: int) -> Column:
    """Key of a table from the hashes of either collection that are `first` and on after the table's own."""
    hashes = []
    for further in range(first, first + STEP if first else 1):
        hashes.append(F.get("hashes", ((F.floor(table / SIDE) + further) % SIDE).cast("int")))
        hashes.append(F.get("hashes", ((table + further) % SIDE + SIDE).cast("int")))
    return F.xxhash64(before, *hashes).bitwiseAND(F.lit(-TABLES)).bitwiseOR(table.cast("long"))


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Frame (node, text): one text of each of the nodes."""
    asked = settle(classes.join(nodes, "node", "left_semi").select("node", "text_hash", F.col("doc_id").alias("id")))
    known = docs.select(
        F.col(doc_id).cast("long").alias("of"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("hash"),
        F.col(text).alias("text"),
    )
    if (n := asked.count()) <= FEW_ASKED:
        asked = F.broadcast(asked)
    elif n <= MOST_ASKED:
        bits = fill(asked.select(F.col("text_hash").alias("key")), 1, words_for(n))
        known = known.filter(passes(F.col("hash"), 1, words_for(n), bits))
    same = (F.col("hash") == F.col("text_hash")) & F.col("of").eqNullSafe(F.col("id"))
    # Rows equal in id and text give the same text; one of them is enough.
    found = asked.join(known, same).groupBy("node").agg(F.any_value("text").alias("text"))
    return settle(in_few_tasks(found, n, TEXTS))


def _confirmed(pairs: DataFrame, classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Pairs (u, v) whose full sets are similar enough.

    Texts of classes that are candidates meet their pairs in two joins. The many pairs of one leader
    may be split over tasks; a task keeps the leader's set while its pairs follow each other.
    """
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = _texts(nodes, classes, docs, doc_id, text)
    second = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        last, one = None, None
        for batch, texts in bites(batches, "text_b"):
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            fine = []
            for row, other in enumerate(_sets(texts)):
                if a[row] != last:
                    last, one = a[row], _sets([batch.column("text_a")[row].as_py()])[0]
                common = len(np.intersect1d(one, other, assume_unique=True))
                fine.append(100 * common >= PERCENT * (len(one) + len(other) - common))
            kept = [row for row, ok in enumerate(fine) if ok]
            yield pa.RecordBatch.from_pydict(
                {"u": pa.array([a[r] for r in kept], pa.int64()), "v": pa.array([b[r] for r in kept], pa.int64())}
            )

    with_package(docs.sparkSession)
    both = in_few_tasks(both.select("a", "b", "text_a", "text_b"), pairs.count(), TEXTS)
    return settle(both.mapInArrow(compared, "u long, v long"))


def _open(large: DataFrame, placed: DataFrame) -> DataFrame:
    """Frame (node, root) of the classes in large buckets that hold more than one component."""
    placed = settle(large.join(placed, "node"))
    n = placed.count()
    parted = placed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    parted = settle(in_few_tasks(parted.filter("least < most").select("key"), n))
    return settle(in_few_tasks(placed.join(parted, "key", "left_semi").select("node", "root").distinct(), n))


def _rest(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of nodes with different roots: all that can be similar enough, by their first shingles.

    The smaller set of a pair (the smaller node of equal ones) has its first common shingle so early that
    it could still hold the whole overlap needed, and so has the larger one.
    """
    spark = with_package(texts.sparkSession)

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        counts = np.zeros(SLOTS, np.int64)
        for _, values in bites(batches):
            np.add.at(counts, _slots(np.concatenate(_sets(values))), 1)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])

    counted = texts.mapInArrow(slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counted, common = counted.toArrow(), np.zeros(SLOTS, np.int64)
    common[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    sent = spark.sparkContext.broadcast(common)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch, values in bites(batches):
            columns = {name: [] for name in ("shingle", "node", "root", "size", "place")}
            for row, one in enumerate(_sets(values)):
                one = one[np.lexsort((one, sent.value[_slots(one)]))]
                upto = len(one) - -(-PERCENT * len(one) // 100) + 1
                columns["shingle"].append(one[:upto].view(np.int64))
                columns["place"].append(np.arange(upto))
                for name, value in (("node", batch["node"][row]), ("root", batch["root"][row]), ("size", len(one))):
                    columns[name].append(np.full(upto, value if name == "size" else value.as_py(), np.int64))
            yield pa.RecordBatch.from_pydict({name: pa.array(np.concatenate(v)) for name, v in columns.items()})

    kind = "shingle long, node long, root long, size long, place long"
    rows = settle(texts.join(nodes, "node").select("node", "root", "text").mapInArrow(firsts, kind))
    sent.destroy()
    # The overlap that a set needs with one of its own size is the least that it needs with a larger one.
    early = F.col("place") <= F.col("size") - F.ceil(F.lit(2 * PERCENT) * F.col("size") / (100 + PERCENT))
    groups = rows.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(early).alias("early"),
        F.min("root").alias("least"),
        F.max("root").alias("most"),
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    n = rows.count()
    groups = settle(in_few_tasks(groups.filter("early > 0 AND least < most").select("shingle", blocks), n))
    rows = settle(in_few_tasks(rows.join(groups, "shingle"), 2 * n).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    of = ["shingle", "own", "other"]
    one = rows.filter(early).withColumn("other", every)
    one = one.select(*of, *[F.col(c).alias(f"{c}_a") for c in ("node", "root", "size", "place")])
    two = rows.withColumnRenamed("own", "other").withColumn("own", every)
    two = two.select(*of, *[F.col(c).alias(f"{c}_b") for c in ("node", "root", "size", "place")])
    needed = F.lit(PERCENT) * (F.col("size_a") + F.col("size_b"))
    could = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b")) * (100 + PERCENT) >= needed
    ordered = (F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("node_a") < F.col("node_b")))
    pairs = one.join(two, of).filter((F.col("root_a") != F.col("root_b")) & ordered & could)
    a, b = F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")
    return settle(pairs.select(a, b).distinct())


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) % np.uint64(SLOTS)).astype(np.int64)


def _roots(classes: DataFrame, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Frame (node, root) of all classes, by the links of pairs that share a key and of what is left of large buckets.

    What is left links components, so that only their roots are joined again.
    """
    pairs, large = _candidates(classes)
    roots = components(_confirmed(pairs, classes, docs, doc_id, text))
    placed = classes.select("node").join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
    placed = settle(placed)
    if large is None:
        return placed
    nodes = _open(large, placed)
    if not nodes.head(1):
        return placed
    rest = _rest(nodes, _texts(nodes.select("node"), classes, docs, doc_id, text))
    links = _confirmed(rest, classes, docs, doc_id, text)
    links = links.join(nodes.select(F.col("node").alias("u"), F.col("root").alias("root_u")), "u")
    links = links.join(nodes.select(F.col("node").alias("v"), F.col("root").alias("root_v")), "v")
    tops = components(links.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")))
    tops = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    return settle(placed.join(tops, "root", "left").select("node", F.coalesce("top", "root").alias("root")))


def _sets(texts: list[str]) -> list[np.ndarray]:
    """Distinct shingles of each text, sorted."""
    hashes, ends = word_hashes(texts, True)
    return [np.unique(shingles(hashes[a:b], WIDTH)) for a, b in zip([0, *ends[:-1]], ends)]


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Frame (doc_id, text_hash, n_shingles, component_id, first_hash): one row per document.

    component_id is the smallest id reachable over links; `first_hash` the smallest hash of the
    texts that have that id.
    """
    rows = _rows(docs, doc_id, text)
    grouped = rows.filter("n_shingles > 0").groupBy("class").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("least"),
        F.any_value("hashes").alias("hashes"),
    )
    classes = grouped.select(
        "class", "least", "least.doc_id", "least.text_hash", "hashes", F.monotonically_increasing_id().alias("node")
    )
    classes = settle(classes)
    placed = classes.select("class", "least", "node").join(_roots(classes, docs, doc_id, text), "node")
    placed = settle(placed.select("class", "least", "root"))
    least = settle(placed.groupBy("root").agg(F.min("least").alias("first")))
    first = settle(placed.join(least, "root").select(F.col("class").alias("of"), "first"))
    found = rows.join(first, F.col("class") == F.col("of"), "left")
    alone = F.col("n_shingles") == 0
    return found.select(
        "doc_id",
        "text_hash",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.col("text_hash")).otherwise(F.col("first.text_hash")).alias("first_hash"),
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """The first document of each component, with all its columns."""
    told = near_duplicates(docs)
    stay = told.filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash")))
    stay = settle(stay.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")).distinct())
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col("doc_id").cast("long").alias("of"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("text_hash"),
    )
    kept = rows.join(stay, F.col("of").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left_semi")
    return kept.groupBy("of", "text_hash").agg(F.any_value("row").alias("row")).select("row.*")


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their component and whether they are its first."""
    told = near_duplicates(table(spark, folder, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    return told.select("doc_id", "n_shingles", "component_id", kept)
