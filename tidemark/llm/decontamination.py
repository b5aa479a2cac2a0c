"""Benchmark decontamination by SimHash of item-sized windows.

Each benchmark item has a fingerprint of BITS bits: the signs of the sum of its shingles' random
signs, each shingle weighing as often as it occurs. A document's windows of as many words as an item
has are fingerprinted the same way and looked up in a multi-index: fingerprints are cut into BLOCKS
blocks, and any two within RADIUS bits agree up to one bit in some block, so a table of each
block's value and its one-bit neighbours finds every item within the radius. Candidates are then
compared exactly: the sum of the smaller shingle counts is at least LEAST of the sum of the larger.

A window that shares no shingle with an item has similarity 0, so only windows over a shared one are
fingerprinted. Documents are read once for each block of BLOCK_ITEMS items and never shuffled; an
item block is the only thing that is broadcast, and results do not depend on the blocks.

Defined results: A-Z is lower-cased; an item without words is in no document, one of fewer words than
WIDTH is a single shingle; a document shorter than an item is compared as a whole if it has at least
LEAST of its words; NULL or empty texts hold nothing; rows equal in all columns are judged each;
an empty benchmark finds nothing. Items that share an id are told by it.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import table, with_package
from tidemark.llm.tokens import bites, grams, held, mixed, shingles, word_hashes

WIDTH, LEAST = 5, 0.8
# 16 blocks of 8 bits: within 31 bits some block differs in at most one. Windows as similar as LEAST
# differ in 19 bits on average, with a deviation of 4; unrelated ones in 64.
BITS, BLOCKS, RADIUS = 128, 16, 31
BLOCK_ITEMS = 5_000
# Windows fingerprinted at a time, and the slots of the first test whether a shingle is any item's.
AT_ONCE, SLOTS = 4096, 1 << 22

FOUND = "doc_id long, item_id long, similarity double, start long, n_words long"


def _each(texts: list[str]) -> list[np.ndarray]:
    """Hashes of each text's words."""
    hashes, ends = word_hashes(texts, True) if texts else (np.zeros(0, np.uint64), [])
    return [hashes[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def _signs(hashes: np.ndarray) -> np.ndarray:
    """BITS signs for each shingle, as 0 and 1."""
    halves = np.stack([mixed(hashes + np.uint64(k)) for k in (1, 2)], axis=1)
    return np.unpackbits(halves.view(np.uint8).reshape(len(hashes), -1), axis=1)


def fingerprints(hashes: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint (packed) of each run of `width` shingles: differences of running sums."""
    total = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(_signs(hashes), axis=0, out=total[1:])
    return np.packbits(2 * (total[width:] - total[:-width]) > width, axis=1)


class Items:
    """A block of the benchmark as the tasks hold it."""

    def __init__(self, rows: list[tuple[int, str]]):
        words = [(item, w) for (item, _), w in zip(rows, _each([text for _, text in rows])) if len(w)]
        self.ids = [item for item, _ in words]
        self.lengths = np.array([len(w) for _, w in words], np.int64)
        lists = [shingles(w, WIDTH) for _, w in words]
        self.counts = [np.unique(s, return_counts=True) for s in lists]
        prints = [fingerprints(s, len(s))[0] for s in lists]
        self.prints = np.stack(prints) if prints else np.zeros((0, BITS // 8), np.uint8)
        self.of: dict[int, set[int]] = defaultdict(set)
        for item, s in enumerate(lists):
            for shingle in s.tolist():
                self.of[shingle].add(item)
        self.slots = np.zeros(SLOTS, bool)
        every = np.fromiter(self.of, np.uint64, len(self.of))
        self.slots[(every % np.uint64(SLOTS)).astype(np.int64)] = True
        # Items whose block has a value or differs from it in one bit.
        self.tables: list[dict[int, list[int]]] = [defaultdict(list) for _ in range(BLOCKS)]
        for item, found in enumerate(self.prints):
            for table_of, value in zip(self.tables, found.tolist()):
                for near in [value, *[value ^ (1 << b) for b in range(8)]]:
                    table_of[near].append(item)
        self.short = sorted({n for n in self.lengths.tolist() if n < WIDTH})

    def shared(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """Positions in a text where a shingle of an item starts, with the shingle."""
        found = []
        for width in [WIDTH, *self.short]:
            here = shingles(hashes[:width], WIDTH) if len(hashes) == width < WIDTH else grams(hashes, width)
            if width < WIDTH and len(hashes) != width:
                here = here + np.uint64(width)
            for at in np.flatnonzero(self.slots[(here % np.uint64(SLOTS)).astype(np.int64)]).tolist():
                if (shingle := int(here[at])) in self.of:
                    found.append((at, shingle))
        return found

    def within(self, found: np.ndarray, length: int) -> list[int]:
        """Items of a length whose fingerprint is within RADIUS bits."""
        near = {i for t, value in zip(self.tables, found.tolist()) for i in t.get(value, ()) if self.lengths[i] == length}
        return [i for i in near if int(np.bitwise_count(self.prints[i] ^ found).sum()) <= RADIUS]

    def similarity(self, item: int, listed: np.ndarray) -> float:
        own, n = self.counts[item]
        other, m = np.unique(listed, return_counts=True)
        _, a, b = np.intersect1d(own, other, assume_unique=True, return_indices=True)
        common = int(np.minimum(n[a], m[b]).sum())
        return common / (int(n.sum()) + len(listed) - common)

    def search(self, hashes: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Items in a text: similarity, first word and number of words of the best window."""
        best: dict[int, tuple[float, int, int]] = {}
        wanted: dict[int, set[int]] = defaultdict(set)
        n = len(hashes)
        for at, shingle in self.shared(hashes):
            for length in {int(self.lengths[i]) for i in self.of[shingle]}:
                if n >= length:
                    wanted[length].update(range(max(0, at - length + min(WIDTH, length)), min(at, n - length) + 1))
                elif n >= math.ceil(LEAST * length):
                    wanted[length].add(0)
        for length, starts in wanted.items():
            size = min(length, n)
            width = max(1, size - WIDTH + 1)
            for run in _runs(sorted(starts)):
                piece = hashes[run[0] : run[-1] + size]
                listed = grams(piece, size) + np.uint64(size) if size < WIDTH else grams(piece, WIDTH)
                for k, found in enumerate(fingerprints(listed, width)):
                    for item in self.within(found, length):
                        alike = self.similarity(item, listed[k : k + width])
                        if alike >= LEAST and alike > best.get(item, (0.0,))[0]:
                            best[item] = (alike, run[0] + k, size)
        return best


def _runs(starts: list[int]) -> Iterator[range]:
    """Consecutive starts, at most AT_ONCE together."""
    first = last = starts[0]
    for start in starts[1:]:
        if start != last + 1 or start - first >= AT_ONCE:
            yield range(first, last + 1)
            first = start
        last = start
    yield range(first, last + 1)


def _items(rows: list[tuple[int, str]]) -> Items:
    return held(("items", zlib.crc32(repr(rows).encode("utf-8", "replace"))), lambda: Items(rows))


def item_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """The benchmark in blocks of about BLOCK_ITEMS items, cut by a hash; one block is on the driver at a time."""
    rows = benchmark.filter(F.col(text).isNotNull()).select(F.col(item_id).cast("long"), F.col(text).cast("string"))
    rows = rows.toDF("item_id", "text")
    blocks = -(-rows.count() // BLOCK_ITEMS)
    for block in range(blocks):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield sorted(map(tuple, mine.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def contaminations(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Frame (doc_id, item_id, similarity, start, n_words): each item found in a document, with its best window."""
    spark = with_package(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = spark.createDataFrame([], FOUND)
    for block in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = _items(sent.value)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            for batch, texts in bites(batches):
                out = []
                for doc, hashes in zip(batch.column("doc_id").to_pylist(), _each(texts)):
                    told = items.search(hashes)
                    out += [(doc, items.ids[item], *best) for item, best in sorted(told.items())]
                if out:
                    names = [field.split()[0] for field in FOUND.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        found = found.unionByName(rows.mapInArrow(search, FOUND))
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item."""
    spark = with_package(docs.sparkSession)
    for block in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = _items(sent.value)
            for batch, texts in bites(batches, text):
                yield batch.filter(pa.array([not items.search(hashes) for hashes in _each(texts)]))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Every benchmark item found in a document."""
    return contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
