"""Ranked lexical search: the best documents for each item, in integers, by a hybrid of term and document order.

Items are taken in blocks of bounded text. For a block, one pass over the documents writes their
postings for the block's terms (an index by documents), from which the counts of the whole table follow. A second pass
reads that index in segments. In a segment an item's short posting lists are summed term at a time
into accumulators; these stand as one more list, bounded by their largest sum, beside the long lists. Then
ranges of documents are visited in order: a range whose bounds together stay below the item's worst kept
score is skipped, and in the others only lists that can still lift a document over it are opened (the
bounded rest is looked up for the documents that are left). A task keeps the best of all its
segments, so that bounds grow sharper; it returns no more than those, and a rank limit joins tasks.

Defined results: texts without terms, empty and NULL ones are counted nowhere and found by nothing; items without
terms find nothing; repeated documents are ranked one by one, repeated items each on their own; equal scores
go by ascending id, NULL ids last; an empty table gives no rows. Only id and text are read of either table.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import settle, table, with_package
from tidemark.llm.tokens import HashTable, bites, release, stretch_hashes

# A term: code points that are letters or digits of ASCII, or no ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_IN_TERM = np.array([TERM.fullmatch(bytes([b])) is not None for b in range(256)])
TOP = 10
# Characters of items that are searched for at a time: their terms and weights are held by every task.
BLOCK_CHARS = 1 << 22
# Postings of a segment, its documents in a range, and the share of its documents that makes a list long.
SEGMENT, RANGE, LONG = 1 << 21, 10, 1 / 16
INDEX = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND = "item long, item_id long, doc_id long, score long"


def _terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, A-Z lower-cased, and where each text's terms end."""
    coded = [text.encode("utf-8", "replace").lower() for text in texts]
    data = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
    inside = np.concatenate([[False], _IN_TERM[data]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edges[::2], edges[1::2]
    return stretch_hashes(data, start, end), np.searchsorted(start, np.cumsum([len(c) + 1 for c in coded]))


@dataclass(frozen=True)
class Items:
    """A block of items: ids, distinct terms of all, and each one's places among them."""

    ids: list[int | None]
    vocabulary: np.ndarray
    places: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Items:
        hashes, ends = _terms([text for _, text in rows])
        vocabulary, place = np.unique(hashes, return_inverse=True)
        places = [np.unique(place[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
        return cls([i for i, _ in rows], vocabulary, places)


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Items]:
    """Blocks of items of at most BLOCK_CHARS characters, or one item; the driver holds one at a time."""
    rows, size = [], 0
    for row in items.select(F.col(item_id).cast("long"), F.col(text)).toLocalIterator():
        one = (row[0], row[1] or "")
        if rows and size + len(one[1]) > BLOCK_CHARS:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append(one)
        size += len(one[1])
    if rows:
        yield Items.of(rows)


def index(docs: DataFrame, vocabulary: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Written frame INDEX: for each document with a term how many it has, and which of the vocabulary how often."""
    spark = with_package(docs.sparkSession)
    sent = spark.sparkContext.broadcast(vocabulary)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        known = HashTable.of(sent.value)
        width = max(1, len(sent.value))
        for batch, texts in bites(batches):
            hashes, ends = _terms(texts)
            size = np.diff(ends, prepend=0)
            place = known.find(hashes)
            hit = place >= 0
            spot, times = np.unique(np.repeat(np.arange(len(texts)), size)[hit] * width + place[hit], return_counts=True)
            offsets = pa.array(np.searchsorted(spot, np.arange(len(texts) + 1) * width), pa.int32())
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(size, pa.int64()),
                    "terms": pa.ListArray.from_arrays(offsets, pa.array(spot % width, pa.int32())),
                    "counts": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32())),
                }
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    written = settle(rows.mapInArrow(counted, INDEX).filter("n > 0"))
    sent.destroy()
    return written


def _weights(indexed: DataFrame, terms: int, documents: int) -> np.ndarray:
    """Weight of each term by the documents that hold it; as many rows reach the driver as the block has terms."""
    holding = np.zeros(terms, np.int64)
    counts = indexed.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    holding[counts["term"].to_numpy()] = counts["count"].to_numpy()
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holding], np.int64)


class Best:
    """The TOP documents of an item so far."""

    def __init__(self) -> None:
        self.score, self.id, self.unknown = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A score below this is not kept."""
        return int(self.score[-1]) if len(self.score) == TOP else 1

    def add(self, score: np.ndarray, ids: np.ndarray, unknown: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        unknown = np.concatenate([self.unknown, unknown])
        kept = np.lexsort((ids, unknown, -score))[:TOP]
        self.score, self.id, self.unknown = score[kept], ids[kept], unknown[kept]


class Segment:
    """Posting lists of some documents: what a term gives each of them, and the most it gives in each range."""

    def __init__(self, columns: list[tuple], weights: np.ndarray, documents: int, length: int):
        ids = [i for part in columns for i in part[0]]
        self.unknown = np.array([i is None for i in ids], bool)
        self.ids = np.array([0 if i is None else i for i in ids], np.int64)
        damped = np.array([10 + 90 * int(n) * documents // length for part in columns for n in part[1]], np.int64)
        per = np.concatenate([part[2] for part in columns])
        term, times = (np.concatenate([part[k] for part in columns]) for k in (3, 4))
        order = np.argsort(term, kind="stable")
        term, times = term[order], times[order].astype(np.int64)
        self.doc = np.repeat(np.arange(len(ids)), per)[order]
        self.start = np.searchsorted(term, np.arange(len(weights) + 1))
        self.gain = weights[term] * (1_000_000_000 * times // (1000 * times + 8 * damped[self.doc]))
        self.ranges = (len(ids) >> RANGE) + 1

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.start[term], self.start[term + 1]
        return self.doc[a:b], self.gain[a:b]

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Let `best` take the segment's documents that belong among the item's TOP."""
        size = self.start[terms + 1] - self.start[terms]
        long = size > len(self.ids) * LONG
        lists = [self.list_of(t) for t in terms[long]]
        short = [self.list_of(t) for t in terms[~long & (size > 0)]]
        if short:  # term at a time, into one more list
            docs, place = np.unique(np.concatenate([d for d, _ in short]), return_inverse=True)
            sums = np.zeros(len(docs), np.int64)
            np.add.at(sums, place, np.concatenate([g for _, g in short]))
            lists.append((docs, sums))
        if not lists:
            return
        borders = np.arange(self.ranges + 1) << RANGE
        cuts = np.array([np.searchsorted(d, borders) for d, _ in lists])
        most = np.zeros((len(lists), self.ranges), np.int64)
        for row, ((_, gain), cut) in enumerate(zip(lists, cuts)):
            filled = np.flatnonzero(cut[1:] > cut[:-1])
            most[row, filled] = np.maximum.reduceat(gain, cut[filled])
        bounds = most.sum(axis=0)
        for at in np.flatnonzero(bounds >= best.least):
            if bounds[at] >= best.least:
                pieces = [(d[c[at] : c[at + 1]], g[c[at] : c[at + 1]]) for (d, g), c in zip(lists, cuts)]
                self._visit(pieces, most[:, at], best)

    def _visit(self, pieces: list[tuple], most: np.ndarray, best: Best) -> None:
        """One range, document at a time for all its documents that the lists with the highest bounds hold."""
        order = np.argsort(most, kind="stable")
        below = np.cumsum(most[order])
        # Documents only in the first lists cannot reach what is kept.
        first = int(np.searchsorted(below, best.least))
        opened = [pieces[k] for k in order[first:]]
        docs, place = np.unique(np.concatenate([d for d, _ in opened]), return_inverse=True)
        score = np.zeros(len(docs), np.int64)
        np.add.at(score, place, np.concatenate([g for _, g in opened]))
        for k in range(first - 1, -1, -1):
            able = score + below[k] >= best.least
            docs, score = docs[able], score[able]
            held, gain = pieces[order[k]]
            if len(held) and len(docs):
                spot = np.minimum(np.searchsorted(held, docs), len(held) - 1)
                score = score + np.where(held[spot] == docs, gain[spot], 0)
        able = score >= best.least
        if able.any():
            docs = docs[able]
            best.add(score[able], self.ids[docs], self.unknown[docs])


def _searched(indexed: DataFrame, items: Items, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """Written frame FOUND of the best documents of each task's segments for each item."""
    sent = indexed.sparkSession.sparkContext.broadcast((items.ids, items.places, weights))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        ids, places, weights = sent.value
        best, columns, held = [Best() for _ in ids], [], 0

        def done() -> None:
            segment = Segment(columns, weights, documents, length)
            for one, terms in zip(best, places):
                if len(terms):
                    segment.search(terms, one)

        for batch in batches:
            terms, counts = batch.column("terms"), batch.column("counts")
            per = terms.value_lengths().to_numpy(zero_copy_only=False)
            flat = terms.flatten().to_numpy(), counts.flatten().to_numpy()
            columns.append((batch.column("doc_id").to_pylist(), batch.column("n").to_pylist(), per, *flat))
            held += len(flat[0])
            if held >= SEGMENT:
                done()
                columns, held = [], 0
        if columns:
            done()
        for number, one in enumerate(best):
            yield pa.RecordBatch.from_pydict(
                {
                    "item": pa.array([number] * len(one.id), pa.int64()),
                    "item_id": pa.array([ids[number]] * len(one.id), pa.int64()),
                    "doc_id": pa.array(one.id, pa.int64(), mask=one.unknown),
                    "score": pa.array(one.score, pa.int64()),
                }
            )

    found = settle(indexed.mapInArrow(searched, FOUND))
    sent.destroy()
    return found


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Frame (item_id, rank, doc_id, score): the TOP documents of each item with a score above 0."""
    spark = docs.sparkSession
    found = spark.createDataFrame([], f"block int, {FOUND}")
    for number, block in enumerate(_blocks(items, item_id, text)):
        indexed = index(docs, block.vocabulary, doc_id, text)
        documents, length = indexed.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not documents:
            break
        weights = _weights(indexed, len(block.vocabulary), documents)
        best = _searched(indexed, block, weights, documents, length)
        found = found.unionByName(best.withColumn("block", F.lit(number)))
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP)
    return ranked.select("item_id", "rank", "doc_id", "score")


def op11_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
