"""Token ids in binary files of bit-plane shuffled, compressed blocks.

Documents are range-partitioned by id, encoded, closed with an end id and run together into one
stream of ids a partition. Every BLOCK ids form a chunk: the ids as a matrix of bytes (or bits) are
transposed, so that each plane holds the same byte (bit) of all ids, and each plane is compressed
with zstandard. A chunk row holds its planes and its part of the index: where it starts, how many
ids it has, and the documents that lie in it. The rows are kept in Parquet files, which Spark reads
and writes wherever its storage is; a chunk can be read without any other.

The encoder cuts a text only where no token can span the cut, and remembers the ids of parts it has
met, by a 64-bit hash; the ids are those of the whole text.

Defined results: a NULL or empty text has the end id alone; NULL ids come first; rows that share an
id are ordered by a hash of their text, and equal rows are written each; an empty table gives an
empty folder of files; only the id and the text are read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import settle, table, with_package
from tidemark.llm.tokens import BASE, HashTable, held, mixed, release, stretch_hashes
from tidemark.session import work_folder

BLOCK = 1 << 16
LEVEL = 3
END = 0
# Characters encoded at a time. Slots for words whose ids a task remembers, until 5 of 8 are taken: then those go that
# were not met again. A batch, or a text of up to twice its size, has fewer words than 3 of 8 slots.
AT_ONCE, SLOTS = 1 << 18, 1 << 21
# Words that the tokenizer is given as one text: with more, or each by itself, it takes longer for a word.
TOGETHER = 100
# Longer words, in bytes, are not told apart by their hash.
LONGEST = 64
# Where a text may be cut: before one blank or line feed between other characters, after such a line
# feed, and after a Latin letter or digit before punctuation. No token spans these places.
BLANK = re.compile(r"(?<=\S)(?= \S)")
INNER = re.compile(r"(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)|(?<=[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f])(?=[.,;:!?])")

CHUNKS = (
    "part int, chunk long, first long, n_ids int, planes array<binary>, "
    "docs array<struct<number: long, doc_id: long, at: long, n: long>>"
)
PIECES = "part int, number long, doc_id long, doc_at long, n_tokens long, at long, n long, crc long"


class Encoder:
    """A public tokenizer with a memory for words.

    A text's parts between blanks are found and hashed (64 bits) in numpy for many texts at once; the
    ids of a part come from a hash table, and the tokenizer is asked for the parts it lacks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)  # by id: does a token begin with a blank?
        self.blank[[i for token, i in vocabulary.items() if token[:1] == "\u0120"]] = True
        self._forget()

    def _forget(self) -> None:
        self.table = HashTable(SLOTS)
        self.ids, self.n_ids = np.zeros(1 << 20, "<u4"), 0
        # Where a remembered part's ids start and how many they are; -1: its text needs more care.
        self.start, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int32)
        self.again = np.zeros(SLOTS, bool)

    def _thin(self) -> None:
        """Forget parts not met again since they were remembered or kept; all parts, if that leaves most of them."""
        keys, kept = self.table.in_order(), np.flatnonzero(self.again[: self.table.n])
        ids, start, count = self.ids, self.start[kept], self.count[kept]
        self._forget()
        if 2 * len(kept) <= len(keys):
            self._store(keys[kept], count, ids[_places(start, np.maximum(count, 0))])

    def _coded(self, pieces: list[str]) -> list[list[int]]:
        return [found.ids for found in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def _careful(self, text: str) -> bytes:
        """Ids of a text with any white space, of any length."""
        pieces = [core for piece in BLANK.split(text) for core in INNER.split(piece)]
        known = dict.fromkeys(pieces)
        known.update(zip(known, self._coded(list(known))))
        return array("I", [i for piece in pieces for i in known[piece]]).tobytes()

    def _after_blanks(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has after a blank, and all ids; no word is empty or has white space at an end.

        Words are joined by blanks: a blank between other characters is the first of a token, and no other token has one.
        """
        joined = [" " + " ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        ids = _flat(self._coded(joined))
        first = np.flatnonzero(self.blank[ids])
        if len(first) == len(words):
            return np.diff(first, append=len(ids)), ids
        each = self._coded([" " + word for word in words])  # a tokenizer with other tokens
        return np.array([len(one) for one in each], np.int64), _flat(each)

    def _parts(self, parts: list[str], heads: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each part has, and all ids; all but heads stand after a blank. -1: white space at an end."""
        head = np.array(heads, bool)
        even = np.array([bool(part) and part == part.strip() for part in parts], bool)
        counts = np.full(len(parts), -1, np.int64)
        counts[head & np.array([not part for part in parts], bool)] = 0
        after, ids = self._after_blanks(list(compress(parts, even & ~head)))
        first = self._coded(list(compress(parts, even & head)))
        counts[even & ~head] = after
        counts[even & head] = [len(one) for one in first]
        # Where each part's ids lie among those of the parts after blanks and then of the heads.
        order = np.concatenate([np.flatnonzero(even & ~head), np.flatnonzero(even & head)])
        start = np.zeros(len(parts), np.int64)
        start[order] = np.cumsum(counts[order]) - counts[order]
        return counts, np.concatenate([ids, _flat(first)])[_places(start, np.maximum(counts, 0))]

    def _store(self, keys: np.ndarray, counts: np.ndarray, flat: np.ndarray) -> None:
        if self.n_ids + len(flat) > len(self.ids):
            larger = np.zeros(2 * (self.n_ids + len(flat)), "<u4")
            larger[: self.n_ids] = self.ids[: self.n_ids]
            self.ids = larger
        new = slice(self.table.n, self.table.n + len(keys))
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        sizes = np.maximum(counts, 0)
        self.start[new], self.count[new] = self.n_ids + np.cumsum(sizes) - sizes, counts
        self.n_ids += len(flat)
        self.table.add(keys)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(texts) == 1 and len(texts[0]) > 2 * AT_ONCE:
            return [self._careful(texts[0])]
        if 8 * self.table.n > 5 * SLOTS:
            self._thin()
        coded = [text.encode("utf-8", "replace") for text in texts]
        whole = b"".join(coded)
        data = np.frombuffer(whole, np.uint8)
        stop = np.cumsum([len(c) for c in coded])
        begin = np.concatenate([[0], stop[:-1]])
        blanks = np.flatnonzero(data == 32)
        start, end = np.sort(np.concatenate([begin, blanks + 1])), np.sort(np.concatenate([stop, blanks]))
        parts = np.searchsorted(blanks, stop) - np.searchsorted(blanks, begin) + 1
        first = np.cumsum(parts) - parts
        head = np.zeros(len(start), bool)
        head[first] = True
        keys = stretch_hashes(data, start, end)
        keys = np.where(head, mixed(keys + BASE), keys) | np.uint64(1)
        found = self.table.find(keys)
        self.again[found[found >= 0]] = True
        uneven = np.zeros(len(texts), bool)
        uneven |= (start[first] == end[first]) & (stop > begin)
        of = np.repeat(np.arange(len(texts)), parts)
        long = end - start > LONGEST
        uneven[of[long]] = True
        missing = np.flatnonzero((found < 0) & ~long)
        if len(missing):
            new, at = np.unique(keys[missing], return_index=True)
            at = missing[at]
            self._store(new, *self._parts(_strings(data, start[at], end[at]), head[at].tolist()))
            found[missing] = self.table.find(keys[missing])
        found[long] = found[~long][0] if (~long).any() else 0
        count = self.count[found]
        uneven[of[count < 0]] = True
        count = np.maximum(count, 0)
        after = np.cumsum(count)
        ids = self.ids[_places(self.start[found], count)]
        octets, ends = ids.tobytes(), after[first + parts - 1].tolist()
        out = [octets[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
        for at in np.flatnonzero(uneven).tolist():
            out[at] = self._careful(texts[at])
        return out


def _places(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Each place of the stretches that start there and are so long, one stretch after the other."""
    after = np.cumsum(count)
    return np.repeat(start - (after - count), count) + np.arange(after[-1] if len(after) else 0)


def _flat(listed: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(listed), "<u4")


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[str]:
    """Stretches of UTF-8 without a blank, as strings."""
    size = end - start
    after = np.cumsum(size + 1)
    joined = np.full(after[-1], 32, np.uint8)
    joined[_places(after - size - 1, size)] = data[_places(start, size)]
    return joined.tobytes().decode("utf-8").split(" ")[:-1]


def _encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


def to_planes(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Compressed planes of an array of u4: four of bytes, or 32 of bits."""
    octets = ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4)
    if bits:
        octets = np.packbits(np.unpackbits(octets, axis=1).T, axis=1).T
    pack = zstandard.ZstdCompressor(level=LEVEL).compress
    return [pack(np.ascontiguousarray(plane).tobytes()) for plane in octets.T]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    octets = np.stack([np.frombuffer(unpack(p), np.uint8) for p in planes])
    if len(planes) == 32:
        octets = np.packbits(np.unpackbits(octets, axis=1)[:, :n].T, axis=1).T
    return np.ascontiguousarray(octets.T).view("<u4").ravel()


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts, at most AT_ONCE characters (or one text) at a time."""
    for batch in batches:
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            text = text.as_py() or ""
            if ids and size + len(text) > AT_ONCE:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id.as_py())
            texts.append(text)
            size += len(text)
        if ids:
            yield ids, texts


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, bits: bool = False, block: int = BLOCK, end: int = END
) -> None:
    """Write the token files of `docs` (doc_id, text) in ascending order of id."""
    closing = int(end).to_bytes(4, "little")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        schema = pa.schema(
            [("part", pa.int32()), ("chunk", pa.int64()), ("first", pa.int64()), ("n_ids", pa.int32()),
             ("planes", pa.list_(pa.binary())),
             ("docs", pa.list_(pa.struct([(n, pa.int64()) for n in ("number", "doc_id", "at", "n")])))]
        )
        held, first, number, chunk, inside = bytearray(), 0, 0, 0, []

        def row(n: int) -> pa.RecordBatch:
            planes = to_planes(np.frombuffer(bytes(held[: 4 * n]), "<u4"), bits)
            values = {"part": part, "chunk": chunk, "first": first, "n_ids": n, "planes": planes, "docs": inside}
            return pa.RecordBatch.from_pylist([values], schema)

        for ids, texts in _texts(batches):
            for doc_id, coded in zip(ids, encoder.encode(texts)):
                at, n = first + len(held) // 4, len(coded) // 4 + 1
                inside.append({"number": number, "doc_id": doc_id, "at": at, "n": n})
                number += 1
                held += coded
                held += closing
                while len(held) >= 4 * block:
                    yield row(block)
                    del held[: 4 * block]
                    chunk, first = chunk + 1, first + block
                    inside = [d for d in inside[-1:] if d["at"] + d["n"] > first]
        if held:
            yield row(len(held) // 4)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    tie = F.xxhash64("text")
    ranged = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, F.length("text"))
    with_package(docs.sparkSession)
    ranged.mapInArrow(chunks, CHUNKS).write.parquet(folder)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(CHUNKS).parquet(folder)


def read_pieces(chunks: DataFrame) -> DataFrame:
    """What each chunk has of each document: position, number of ids and their crc32."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        names = [field.split()[0] for field in PIECES.split(", ")]
        kinds = [pa.int32(), *[pa.int64()] * (len(names) - 1)]
        for batch in batches:
            for at in range(batch.num_rows):
                row, out = batch.slice(at, 1).to_pylist()[0], []
                first, n = row["first"], row["n_ids"]
                octets = memoryview(from_planes(row["planes"], n).tobytes())
                for d in row["docs"]:
                    low, high = max(d["at"], first), min(d["at"] + d["n"], first + n)
                    crc = zlib.crc32(octets[4 * (low - first) : 4 * (high - first)])
                    out.append((row["part"], d["number"], d["doc_id"], d["at"], d["n"], low, high - low, crc))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    with_package(chunks.sparkSession)
    return chunks.mapInArrow(decoded, PIECES)


def crc_joined(pieces: list[tuple[int, int]]) -> int:
    """crc32 of bytes from the crc32 and length of their pieces.

    Appending n zero bytes is a linear map of the 32 bits: the product of those of the powers of two in 8 * n.
    """
    whole = 0
    for crc, n in pieces:
        carried, power, bits = whole, 0, 8 * n
        while bits:
            if bits & 1:
                carried = _mapped(_zero_bits(power), carried)
            power, bits = power + 1, bits >> 1
        whole = carried ^ crc
    return whole


@cache
def _zero_bits(power: int) -> tuple[int, ...]:
    """Columns of the map that appends 2**power zero bits."""
    if not power:
        return (0xEDB88320, *(1 << i for i in range(31)))
    half = _zero_bits(power - 1)
    return tuple(_mapped(half, column) for column in half)


def _mapped(columns: tuple[int, ...], vector: int) -> int:
    out = 0
    for column in columns:
        if vector & 1:
            out ^= column
        vector >>= 1
    return out


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Frame (doc_id, start, n_tokens, ids_crc32) from the files: one row per document.

    A document that lies in several chunks gets its checksum from theirs, so a chunk is read by
    itself and ids are not shuffled; only such documents are grouped. Starts need the totals of earlier partitions, a row for each.
    """
    chunks = read_chunks(spark, folder)
    totals = chunks.groupBy("part").agg(F.max(F.col("first") + F.col("n_ids")).alias("total"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("total").over(earlier), F.lit(0))
    offsets = settle(totals.select("part", before.alias("before")))
    pieces = settle(read_pieces(chunks))
    single = pieces.filter("n = n_tokens").select("part", "doc_id", "doc_at", "n_tokens", "crc")
    # A document has one piece for each BLOCK of its own ids, and one more.
    listed = F.array_sort(F.collect_list(F.struct("at", "n", "crc"))).alias("pieces")
    first = [F.first(name).alias(name) for name in ("doc_id", "doc_at", "n_tokens")]
    several = pieces.filter("n < n_tokens").groupBy("part", "number").agg(*first, listed)
    joined = F.udf(lambda listed: crc_joined([(p["crc"], 4 * p["n"]) for p in listed]), "long", useArrow=True)
    several = several.select("part", "doc_id", "doc_at", "n_tokens", joined("pieces").alias("crc"))
    return single.unionByName(several).join(offsets, "part").select(
        "doc_id", (F.col("before") + F.col("doc_at")).alias("start"), "n_tokens", F.col("crc").alias("ids_crc32")
    )


def written_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the token files to a new folder of the shared one and list the documents from them."""
    folder = work_folder(docs.sparkSession, "tokens")
    write_tokens(docs, folder, tokenizer)
    return read_index(docs.sparkSession, folder)


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in token files, listed from the files."""
    return written_and_read(table(spark, folder, "documents"), tokenizer_path())
