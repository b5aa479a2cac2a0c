"""Exact n-gram Jaccard join by a token-group matrix.

Documents with equal sets are one class. Classes are put into groups of similar ones: those with the same
smallest shingle hash, cut into pieces of bounded size. A group is known by the union of its tokens
(shingles). A set that is similar enough to a member shares so many tokens with the union as it needs
with the member, so that a group whose union holds fewer is never opened.

The bound is checked in two steps. Tokens have one order, the rarer ones first as far as SLOTS counts tell.
The first KEEP tokens that two similar sets share stand among the first ones of both, how many follows
from the sizes; so the matrix holds a group's first tokens only, and a group qualifies if KEEP of a
query's first tokens are among them, in members of fitting sizes. For what is left, group and queries meet in a task, which
counts the overlap with the whole union, opens the group if it is enough and counts the overlaps with the members.

Before the matrix is made, each group is opened for its own members and for the first class of its
smallest hash; then for queries that have tokens in common with it, one group for each token. What these links join
needs no further comparison: a query is not tested against a group whose members
with the shared token all are in its component already. So one large family of near copies costs its
groups, not its pairs. Links between different components are all found, whatever the order.

Defined results: texts without words have an empty set, link with nothing and are their own
component; fewer words than WIDTH are one shingle; NULL ids come last, and a component of NULL ids
alone keeps NULL; repeated rows are in one class; an empty table gives no rows. Words are compared by 64-bit
hashes. Only id and text are read, under names of this module.
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
from tidemark.llm.text import settle, table, with_package
from tidemark.llm.tokens import bites, mixed, release, shingles, word_hashes

WIDTH = 4
# Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
# Shared first tokens that a group must have; a larger number makes the lists a little longer and the test sharper.
KEEP = 4
# Counts that order tokens by how common they are: 2 MB in a task. Any order gives the same links.
SLOTS = 1 << 18
# Members and tokens of a group; a larger set is a group of its own. Queries of a group that go to one task.
MEMBERS, TOKENS, QUERIES = 512, 1 << 19, 1024
# Keys up to this many are held as bits (60 MB) to leave out rows before a shuffle.
MOST_BITS = 50_000_000

ROWS = "doc_id long, text_hash long, size long, class binary, smallest long, firsts array<long>"


def _at_least(share: int, of: int, size: Column | int) -> Column | int:
    """share * size / of, rounded up."""
    return F.ceil(share * size / of) if isinstance(size, Column) else -(-share * size // of)


def _sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Distinct shingles of each text, sorted."""
    hashes, ends = word_hashes(texts, True)
    return [np.unique(shingles(hashes[a:b], width)) for a, b in zip([0, *ends[:-1]], ends)]


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (mixed(tokens) & np.uint64(SLOTS - 1)).astype(np.int64)


def _document() -> list[Column]:
    return [F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("unknown"), F.col("text_hash").alias("hash")]


class Group:
    """Sets of one group in a task: its union with the members that hold each token."""

    def __init__(self, members: list[np.ndarray]):
        every = np.concatenate(members)
        order = np.argsort(every, kind="stable")
        self.sizes = np.array([len(m) for m in members], np.int64)
        self.owner = np.repeat(np.arange(len(members)), self.sizes)[order]
        every = every[order]
        self.first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        self.union = every[self.first]
        self.upto = np.append(self.first[1:], len(every))

    def linked(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members similar enough to the query; the group is opened only if its union holds enough of it."""
        spot = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        spot = spot[self.union[spot] == query]
        if 100 * len(spot) < percent * len(query):
            return np.zeros(0, np.int64)
        length = self.upto[spot] - self.first[spot]
        place = np.repeat(self.first[spot] - np.cumsum(length) + length, length) + np.arange(length.sum())
        common = np.bincount(self.owner[place], minlength=len(self.sizes))
        return np.flatnonzero(100 * common >= percent * (self.sizes + len(query) - common))


class Join:
    """One join: the documents, and what links them."""

    def __init__(self, docs: DataFrame, width: int, percent: int, doc_id: str, text: str):
        self.spark = with_package(docs.sparkSession)
        self.width, self.percent = width, percent
        # Sets below this size have no similar one but their equals.
        self.least = _at_least(percent, 100 - percent, 1)
        self.docs = docs.select(
            F.col(doc_id).cast("long").alias("doc_id"),
            F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_hash"),
            F.col(text).cast("string").alias("text"),
        )

    def common(self) -> np.ndarray:
        """How many documents hold a token of each slot; SLOTS numbers reach the driver."""
        width = self.width

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            counts = np.zeros(SLOTS, np.int64)
            for _, texts in bites(batches):
                counts += np.bincount(_slots(np.concatenate(_sets(texts, width))), minlength=SLOTS)
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["slot", "n"])

        counted = self.docs.select("text").mapInArrow(slots, "slot long, n long")
        counted = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        common = np.zeros(SLOTS, np.int64)
        common[counted["slot"].to_numpy()] = counted["n"].to_numpy()
        return common

    def rows(self) -> DataFrame:
        """Written frame ROWS: a document's set by size, digest, smallest hash and first tokens."""
        width, percent, least = self.width, self.percent, self.least
        sent = self.spark.sparkContext.broadcast(self.common())

        def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            for batch, texts in bites(batches):
                sets, firsts = _sets(texts, width), []
                for one in sets:
                    upto = len(one) - _at_least(percent, 100, len(one)) + KEEP
                    order = np.lexsort((one, sent.value[_slots(one)]))[:upto]
                    firsts.append(one[order].view(np.int64) if len(one) >= least else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("text_hash"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                        pa.array([int(mixed(s).min().view(np.int64)) if len(s) else None for s in sets], pa.int64()),
                        pa.array(firsts, pa.list_(pa.int64())),
                    ],
                    [field.split()[0] for field in ROWS.split(", ")],
                )

        written = settle(self.docs.mapInArrow(signed, ROWS))
        sent.destroy()
        return written

    def grouped(self, classes: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Classes that may have links, with their group; and requests (group, node) of the groups' own members."""
        rows = classes.filter(F.col("size") >= self.least).drop("class", "firsts")
        share = F.greatest(F.ceil(F.count(F.lit(1)) / MEMBERS), F.ceil(F.sum("size") / TOKENS))
        families = rows.groupBy("smallest").agg(
            share.alias("pieces"), F.count(F.lit(1)).alias("n"), F.min("node").alias("head")
        )
        piece = F.pmod(F.xxhash64("node"), F.col("pieces"))
        rows = settle(
            rows.join(settle(families), "smallest").withColumn("group", F.xxhash64("smallest", piece)).drop("pieces", "smallest")
        )
        several = rows.filter("n > 1").select("group", "node", "head")
        own = several.select("group", "node").unionByName(several.select("group", F.col("head").alias("node")))
        return rows, settle(own.distinct())

    def with_texts(self, nodes: DataFrame, asked: DataFrame) -> DataFrame:
        """Rows of `nodes` with the `text` of their document (id, unknown, hash); `asked` has each of these once.

        Rows equal in id and text give the same text; one of them is taken, in the shuffle that the join uses.
        """
        docs = self.docs
        if 0 < (n := asked.count()) <= MOST_BITS:
            bits = fill(asked.select(F.col("hash").alias("key")), 1, words_for(n))
            docs = docs.filter(passes(F.col("text_hash"), 1, words_for(n), bits))
        docs = docs.select(*_document(), "text").groupBy("id", "unknown", "hash").agg(F.any_value("text").alias("text"))
        return docs.join(nodes, ["id", "unknown", "hash"])

    def links(self, requests: DataFrame, rows: DataFrame) -> DataFrame:
        """Written links (u, v) of queries (group, node) to members of their groups, on whole sets.

        A group's members go with every QUERIES of its queries, so that no task gets all queries of one group.
        A link between two that the links before have joined in the same task is not written.
        """
        width, percent = self.width, self.percent
        sizes = requests.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES).alias("blocks"))
        sizes = settle(sizes)
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        queries = requests.join(sizes, "group").select("group", block.alias("block"), F.lit(1).alias("role"), "node")
        blocks = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int"))).alias("block")
        members = rows.select("group", "node").join(sizes, "group").select("group", blocks, F.lit(0).alias("role"), "node")
        both = settle(members.unionByName(queries).join(rows.select("node", *_document()), "node"))
        order = ["group", "block", "role", "node"]
        texts = self.with_texts(both, settle(both.select("id", "unknown", "hash").distinct()))
        placed = texts.select(*order, "text").repartition("group", "block").sortWithinPartitions(*order)

        def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release()
            now, nodes, members, group = None, [], [], None
            for batch, texts in bites(batches):
                group_of, block_of, role_of, node_of = (batch.column(name).to_pylist() for name in order)
                u, v = [], []
                for row, one in enumerate(_sets(texts, width)):
                    if (group_of[row], block_of[row]) != now:
                        now, nodes, members, group = (group_of[row], block_of[row]), [], [], None
                    if role_of[row] == 0:
                        nodes.append(node_of[row])
                        members.append(one)
                        continue
                    if group is None:
                        group = Group(members)
                        joined, own = np.arange(len(nodes)), {node: k for k, node in enumerate(nodes)}
                    near = group.linked(one, percent)
                    if node_of[row] in own:
                        near = np.concatenate([[own[node_of[row]]], near])
                    parts, which = np.unique(joined[near], return_index=True)
                    for k in near[np.sort(which)]:
                        if nodes[k] != node_of[row]:
                            u.append(node_of[row])
                            v.append(nodes[k])
                    joined[np.isin(joined, parts)] = parts.min(initial=len(nodes))
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        return settle(placed.mapInArrow(opened, "u long, v long"))

    def tokens(self, classes: DataFrame) -> DataFrame:
        """Written first tokens (token, node, size, early) that several classes have.

        Tokens are told apart before anything is joined to them. An early one stands for pairs with sets no smaller than its own.
        """
        early = F.col("at") < F.col("size") - _at_least(2 * self.percent, 100 + self.percent, F.col("size")) + KEEP
        tokens = classes.select("node", "size", F.posexplode("firsts").alias("at", "token"))
        return self._shared(tokens.withColumn("early", early).drop("at"), "node", 2)

    def qualifying(self, tokens: DataFrame, rows: DataFrame, links: DataFrame, single: bool) -> DataFrame:
        """Requests (group, node): groups that the matrix does not rule out for a query of another component.

        `single` asks of the groups with a token for the one with the smallest component only.
        """
        roots = settle(components(links))
        placed = rows.join(roots, "node", "left").select("node", "group", F.coalesce("root", "node").alias("root"))
        tokens = self._shared(settle(tokens.join(settle(placed), "node")), "root", 3)
        matrix = tokens.filter("early").groupBy("token", "group").agg(
            F.min("root").alias("least"),
            F.max("root").alias("most"),
            F.min("size").alias("smallest"),
            F.max("size").alias("largest"),
        )
        if single:
            first = F.min(F.struct("least", "group", "most", "smallest", "largest")).alias("first")
            matrix = matrix.groupBy("token").agg(first).select("token", "first.*")
        fits = (F.col("smallest") <= F.col("size")) & (100 * F.col("largest") >= self.percent * F.col("size"))
        other = (F.col("least") != F.col("root")) | (F.col("most") != F.col("root"))
        hits = tokens.drop("group", "early").join(settle(matrix), "token").filter(fits & other)
        needed = F.least(F.lit(KEEP), _at_least(self.percent, 100, F.col("size")))
        counted = hits.groupBy("node", "group").agg(F.count(F.lit(1)).alias("hits"), F.any_value("size").alias("size"))
        return counted.filter(F.col("hits") >= needed).select("group", "node")

    def _shared(self, tokens: DataFrame, of: str, level: int) -> DataFrame:
        """Written rows of `tokens` whose token occurs with several values of `of`, once at least as an early one."""
        several = tokens.groupBy("token").agg(F.max("early").alias("early"), F.min(of).alias("least"), F.max(of).alias("most"))
        several = settle(several.filter("early AND least < most").select("token"))
        if 0 < (n := several.count()) <= MOST_BITS:
            bits = fill(several.select(F.col("token").alias("key")), level, words_for(n))
            tokens = tokens.filter(passes(F.col("token"), level, words_for(n), bits))
        return settle(tokens.join(several, "token", "left_semi"))


def ngram_components(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Frame (doc_id, n_shingles, component_id): one row for each document.

    Two documents are linked if 100 * intersection >= percent * union of their sets of `width`-word
    shingles; component_id is the smallest id reachable over links.
    """
    join = Join(docs, width, percent, doc_id, text)
    rows = join.rows()
    least = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("least")
    classes = rows.filter("size > 0").groupBy("class").agg(
        least, *[F.any_value(name).alias(name) for name in ("size", "smallest", "firsts")]
    )
    classes = settle(
        classes.select("class", "least.doc_id", "least.text_hash", "size", "smallest", "firsts", F.monotonically_increasing_id().alias("node"))
    )
    members, opened = join.grouped(classes)
    tokens, links = join.tokens(classes), join.links(opened, members)
    for single in (True, False):
        asked = join.qualifying(tokens, members, links, single)
        asked = settle(asked.join(opened, ["group", "node"], "left_anti"))
        links, opened = links.unionByName(join.links(asked, members)), opened.unionByName(asked)
    roots = settle(components(links))
    placed = classes.select("class", "doc_id", "node").join(roots, "node", "left")
    placed = settle(placed.select("class", "doc_id", F.coalesce("root", "node").alias("root")))
    first = settle(placed.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    named = settle(placed.join(first, "root").select("class", "component_id"))
    found = rows.join(named, "class", "left")
    component = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return found.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))


def op12_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with the component of their links."""
    return ngram_components(table(spark, folder, "documents"))
