"""Language-model scores from a weighted backoff automaton.

Tokens are words with A-Z lower-cased, closed by one end of text. The base gives a token the chance
(c + 1) / (N + V + 1): c its count in training, N all training tokens, V the distinct ones; what the
V tokens leave is for all unseen ones together. The model is an interpolated n-gram model with
absolute discounting on top of the base:

    P(w | h) = max(c(hw) - D, 0) / c(h) + rest(h) * P(w | shorter h)

over the n-grams it keeps; rest(h) is what they leave of h, so chances add up to 1. A kept n-gram is
a state. Its arcs lead to the kept n-grams that it begins, and its failure arc, of weight rest(h), to
the state of its longest proper suffix. Since only n-grams are kept whose first and last n - 1 tokens
are kept too, the state after a token is the longest kept n-gram that ends there. A traversal goes
from left to right, order by order for all positions of many texts at once, and adds up log10 of the
arcs taken.

The query uses `whole_scores`: every n-gram of training is kept, and no bound depends on the size of the
corpus. No task holds the model: each block of documents builds the automaton of its own n-grams, whose
weights come from counts over all blocks. A history is told by KEY_BITS of a hash and the part it is in, what
follows it by MARK_BITS more. All that begins with one word is counted in one task (with two words, if the
first is frequent), combined in each block before.

`train` and `score` are for a bounded model. Counting covers every training token: each order is a grouped
count, combined in the tasks before it is shuffled. An order keeps its most frequent n-grams, at most KEPT of
them (a bound on the model, held by every task: about 60 bytes each); equal counts are kept or left together.
Counts of rarer words are exact too: a text's tokens outside the kept words are joined with the table of
their counts, so both scores use the count of every token.

Defined results: a NULL or empty text is one end of text; NULL ids are trained on; equal rows are
scored each; without training documents every token has chance 1 by the formula, score 0; only the
id and the text are read.
"""

from __future__ import annotations

import io
import math
import string
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import WORD, settle, table, with_package
from tidemark.llm.tokens import HashTable, bites, mixed, release, word_hashes

ORDER = 3
KEPT = 1 << 19
DISCOUNT = 0.75
# The query learns from documents with another remainder.
HELD_OUT = (7, 2)
# Hash of the end of text; a word's hash is that only by a chance of 2**-64.
END = np.uint64(xxhash.xxh3_64_intdigest(b" end of text "))
# Bits that tell histories apart, and what follows one of them.
KEY_BITS, MARK_BITS = 56, 40
# Tokens of a block, and characters of the corpus for each part of the histories.
BLOCK_TOKENS, PART_CHARS = 3 << 19, 1 << 23
# Words whose trigrams are not counted where their bigrams are, told from a sample of about so many documents.
FREQUENT_WORDS, SAMPLE_DOCS = 512, 2000
# Tokens whose n-grams are combined in a task before they go to the shuffle.
COMBINED = 1 << 21
# Bits for the last token's index in the key of an n-gram.
SHIFT = 21

SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "rare array<struct<word: long, n: long>>"
)


def held_out(doc_id: str = "doc_id", folds: tuple[int, int] = HELD_OUT) -> Column:
    of, remainder = folds
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % of == remainder, F.lit(False))


@dataclass
class Order:
    """The kept n-grams of one order: sorted keys, and by position count, log10 chance and log10 rest.

    A key is the position of the first n - 1 tokens in the order below, and that of the last token
    among the words. `suffix` is the position of the last n - 1 tokens. Words' keys are their hashes.
    """

    keys: np.ndarray
    counts: np.ndarray
    chance: np.ndarray
    rest: np.ndarray
    suffix: np.ndarray

    @cached_property
    def table(self) -> HashTable:
        """Made by each Python worker for itself."""
        return HashTable.of(self._spread(self.keys))

    @staticmethod
    def _spread(keys: np.ndarray) -> np.ndarray:
        return mixed(keys.astype(np.uint64, copy=False)) | np.uint64(1)

    def light(self, scores: bool) -> Order:
        """What tasks need of it: the keys, and to score with it the chances."""
        none = np.zeros(0)
        return Order(self.keys, none, self.chance if scores else none, self.rest if scores else none, none)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 without."""
        found = self.table.find(self._spread(keys))
        return np.where((found >= 0) & (self.keys[found] == keys), found, -1) if len(self.keys) else found


@dataclass(frozen=True)
class Model:
    orders: tuple[Order, ...]
    tokens: int
    distinct: int

    def space(self) -> int:
        return self.tokens + self.distinct + 1


def tokens_of(texts: list[str], words: Order) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position among the kept words (or -1) and hash of all tokens of some texts, and where each text's end."""
    hashes, ends = word_hashes(texts, True)
    hashes = np.insert(hashes, ends, END)
    return words.find(hashes), hashes, ends + np.arange(1, len(ends) + 1)


def lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Position of each value in sorted keys, -1 without."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def states(orders: tuple[Order, ...], tokens: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the position of the kept n-gram that ends at each token, -1 without."""
    found = np.where(tokens >= 0, tokens, -1)
    yield found
    begins = np.zeros(len(tokens), bool)
    begins[np.concatenate([[0], ends[:-1]])] = True
    for order in orders[1:]:
        # The n-gram before must be kept, and must not reach into the text before.
        before = np.concatenate([[-1], found[:-1]])
        before[begins] = -1
        wanted = np.flatnonzero((before >= 0) & (tokens >= 0))
        found = np.full(len(tokens), -1, np.int64)
        found[wanted] = order.find(_keys(before[wanted], tokens[wanted]))
        yield found


def _keys(before: np.ndarray, last: np.ndarray) -> np.ndarray:
    return (before << SHIFT) | last


def _counted(keys: np.ndarray) -> pa.RecordBatch:
    keys, n = np.unique(keys, return_counts=True)
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["key", "n"])


def _grouped(parts: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Counts of keys, of about COMBINED of them at a time."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part)
        if size >= COMBINED:
            yield _counted(np.concatenate(held))
            held, size = [], 0
    if size:
        yield _counted(np.concatenate(held))


def _word_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()

    def parts() -> Iterator[np.ndarray]:
        for _, texts in bites(batches):
            yield word_hashes(texts, True)[0]
            yield np.full(len(texts), END)

    return _grouped(parts())


def _gram_keys(sent):
    """Keys of the next order's n-grams whose first and last n - 1 tokens are kept."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[np.ndarray]:
            orders = sent.value
            for _, texts in bites(batches):
                tokens, _, ends = tokens_of(texts, orders[0])
                *_, last = states(orders, tokens, ends)
                begins = np.zeros(len(tokens), bool)
                begins[np.concatenate([[0], ends[:-1]])] = True
                before = np.concatenate([[-1], last[:-1]])
                kept = np.flatnonzero((before >= 0) & (last >= 0) & ~begins)
                yield _keys(before[kept], tokens[kept])

        return _grouped(parts())

    return keys


def _floor(counts: DataFrame, most: int) -> int | None:
    """The smallest count n that at most `most` rows reach, None if there is no such."""
    sizes = counts.groupBy("n").agg(F.count(F.lit(1)).alias("grams"))
    down = Window.orderBy(F.col("n").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fits = sizes.withColumn("above", F.sum("grams").over(down)).filter(F.col("above") <= most)
    return fits.agg(F.min("n")).first()[0]


def _most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts from the smallest count on that leaves at most `most` of them."""
    floor = _floor(counts, most)
    if floor is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kept = counts.filter(F.col("n") >= floor).toArrow()
    return kept["key"].to_numpy(), kept["n"].to_numpy()


def _order(lower: tuple[Order, ...], keys: np.ndarray, counts: np.ndarray, discount: float) -> Order:
    """Arcs of an order: discounted chances, on top of what the state's failure arc leads to."""
    sort = np.argsort(keys)
    keys, counts = keys[sort], counts[sort]
    before, last = keys >> SHIFT, keys & ((1 << SHIFT) - 1)
    below = lower[-1]
    if len(lower) == 1:
        suffix, shorter = last, below.chance[last]
    else:
        suffix = lookup(below.keys, _keys(below.suffix[before], last))
        shorter = below.chance[suffix]
    whole = below.counts[before].astype(np.float64)
    taken = (counts - discount) / whole
    left = 1 - np.bincount(before, taken, len(below.keys))
    below.rest[:] = np.log10(left)
    chance = np.log10(taken + left[before] * 10**shorter)
    return Order(keys, counts, chance, np.zeros(len(keys)), suffix)


def train(
    docs: DataFrame, text: str = "text", order: int = ORDER, kept: int = KEPT, discount: float = DISCOUNT
) -> tuple[Model, DataFrame]:
    """The model, and the written counts (key, n) of all words by hash."""
    spark = with_package(docs.sparkSession)
    texts = docs.select(F.col(text).cast("string").alias("text"))
    total = F.sum("n").alias("n")
    words = settle(texts.mapInArrow(_word_keys, "key long, n long").groupBy("key").agg(total))
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    keys, counts = _most_frequent(words, kept)
    keys = keys.view(np.uint64)
    sort = np.argsort(keys)
    keys, counts = keys[sort], counts[sort]
    chance = np.log10((counts + 1) / (tokens + distinct + 1))
    orders = (Order(keys, counts, chance, np.zeros(len(keys)), np.zeros(len(keys), np.int64)),)
    for _ in range(2, order + 1):
        sent = spark.sparkContext.broadcast(tuple(o.light(False) for o in orders))
        grams = texts.mapInArrow(_gram_keys(sent), "key long, n long").groupBy("key").agg(total)
        keys, counts = _most_frequent(settle(grams.filter("n > 1")), kept)
        sent.destroy()
        if not len(keys):
            break
        orders = (*orders, _order(orders, keys, counts, discount))
    return Model(orders, tokens, distinct), words


def _scored(model: Model, texts: list[str]) -> tuple:
    """For each text tokens, known ones, log10 chances by base and model without its rare words, and those."""
    tokens, hashes, ends = tokens_of(texts, model.orders[0])
    log_space, first = math.log10(model.space()), model.orders[0]
    known = tokens >= 0
    base = np.full(len(tokens), -log_space)
    base[known] = first.chance[tokens[known]]
    begins = np.zeros(len(tokens), bool)
    begins[np.concatenate([[0], ends[:-1]])] = True
    score, taken, before = base.copy(), np.zeros(len(tokens), np.int64), None
    for level, found in enumerate(states(model.orders, tokens, ends)):
        if level:
            # In a state of this level's length the arc is taken if there is one; else its failure
            # arc leads to what shorter states have given.
            state = np.concatenate([[-1], before[:-1]])
            state[begins] = -1
            inside = state >= 0
            score[inside] += model.orders[level - 1].rest[state[inside]]
            arc = found >= 0
            score[arc] = model.orders[level].chance[found[arc]]
        before = found
    starts = np.concatenate([[0], ends[:-1]])
    sums = [np.add.reduceat(values, starts) for values in (known.astype(np.int64), base, score)]
    rare = []
    for a, b in zip(starts, ends):
        values, n = np.unique(hashes[a:b][~known[a:b]].view(np.int64), return_counts=True)
        rare.append([{"word": v, "n": k} for v, k in zip(values.tolist(), n.tolist())])
    return ends - starts, *sums, rare


def _score(sent):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare"]
        kind = pa.list_(pa.struct([("word", pa.int64()), ("n", pa.int64())]))
        for batch, texts in bites(batches):
            n, known, base, score_, rare = _scored(model, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(n.astype(np.int64)),
                    pa.array(known),
                    pa.array(base),
                    pa.array(score_),
                    pa.array(rare, kind),
                ],
                names,
            )

    return score


def score(
    docs: DataFrame, model: Model, words: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Frame (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per document."""
    spark = with_package(docs.sparkSession)
    orders = tuple(o.light(True) for o in model.orders)
    sent = spark.sparkContext.broadcast(Model(orders, model.tokens, model.distinct))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).cast("string").alias("text")
    )
    scored = rows.mapInArrow(_score(sent), SCORES).withColumn("row", F.monotonically_increasing_id())
    scored = settle(scored)
    rare = scored.select("row", F.explode("rare").alias("one")).select("row", "one.word", F.col("one.n").alias("times"))
    held_words = len(model.orders[0].keys)
    if held_words < model.distinct:  # else a token outside the kept words is in no training text
        floor = int(model.orders[0].counts.min()) if held_words else None
        others = words if floor is None else words.filter(F.col("n") < floor)
        found = rare.join(others.select(F.col("key").alias("word"), "n"), "word")
        more = found.groupBy("row").agg(
            F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more")
        )
        scored = scored.join(more, "row", "left")
    else:
        scored = scored.withColumns({"more_known": F.lit(0), "more": F.lit(0.0)})
    more = F.coalesce("more", F.lit(0.0))
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of some texts, and where each text's end."""
    hashes, ends = word_hashes(texts, True)
    return np.insert(hashes, ends, END), ends + np.arange(1, len(ends) + 1)


@dataclass
class Level:
    """The histories of one length in a block, by key, and their arcs: what follows each, by mark.

    `first` is where a history's arcs begin, `order` the place of each history among the block's own states and
    `arcs` that of each arc.
    """

    keys: np.ndarray
    first: np.ndarray
    marks: np.ndarray
    trained: np.ndarray
    order: np.ndarray
    arcs: np.ndarray

    @classmethod
    def of(
        cls, order: np.ndarray, keys: np.ndarray, arcs: np.ndarray, before: np.ndarray, last: np.ndarray, trained: np.ndarray
    ) -> Level:
        """From the states `order` with the hashes `keys` of all, and the arcs `arcs` that leave them.

        `before`, `last` and `trained` are the state, the token's hash and the occurrences of every arc.
        """
        rank = np.zeros(len(keys), np.uint64)
        rank[order] = np.arange(len(order), dtype=np.uint64)
        marks = mixed(keys[before[arcs]] + last[arcs]) >> np.uint64(64 - MARK_BITS)
        at = rank[before[arcs]]
        sort = np.argsort((at << np.uint64(MARK_BITS)) | marks)
        first = np.concatenate([[0], np.cumsum(np.bincount(at.astype(np.int64), minlength=len(order)))])
        arcs = arcs[sort]
        return cls(keys[order] >> np.uint64(64 - KEY_BITS), first, marks[sort], trained[arcs], order, arcs)

    def range(self, low: int, high: int) -> tuple[int, int]:
        a, b = np.searchsorted(self.keys, np.array([low, high], np.uint64))
        return int(a), int(b)

    def heads(self, a: int, b: int, low: int) -> np.ndarray:
        """Differences of the keys of histories a to b."""
        return np.diff(self.keys[a:b], prepend=np.uint64(low))

    def tails(self, a: int, b: int) -> list[np.ndarray]:
        """What follows them: number, marks and occurrences."""
        c, d = self.first[a], self.first[b]
        return [np.diff(self.first[a : b + 1]), self.marks[c:d], self.trained[c:d]]


class Block:
    """The n-grams of some texts: `words`, and for each token the place of its word, bigram and trigram.

    A text's first token has no bigram, its first two no trigram (-1). Three levels are asked about: `one`, words and
    what follows them; `two`, the bigrams in that same order and what follows those without a frequent first
    word; and `hot`, the bigrams that have one, by keys of their own.
    """

    def __init__(self, hashes: np.ndarray, ends: np.ndarray, held: np.ndarray, frequent: np.ndarray):
        self.ends, starts = ends, np.concatenate([[0], ends[:-1]])
        self.sizes = ends - starts
        at = np.arange(len(hashes), dtype=np.int32) - np.repeat(starts.astype(np.int32), self.sizes)
        trained = np.repeat(~held, self.sizes)
        self.texts = int((~held).sum())
        self.words, word = np.unique(hashes, return_inverse=True)
        word = word.astype(np.int32)
        self.places, self.arcs, state, levels = [word], [], word, []
        for order in (1, 2):
            here = np.flatnonzero(at >= order)
            codes, which = np.unique((state[here - 1].astype(np.int64) << 32) | word[here], return_inverse=True)
            before, last = (codes >> 32).astype(np.int32), (codes & 0xFFFFFFFF).astype(np.int32)
            # The state that an arc fails to has the arc of the same token.
            suffix = np.empty(len(codes), np.int32)
            suffix[which] = self.places[-1][here]
            self.arcs.append((before, suffix))
            levels.append((before, self.words[last], np.bincount(which[trained[here]], minlength=len(codes))))
            state = np.full(len(hashes), -1, np.int32)
            state[here] = which
            self.places.append(state)
            del here, codes, which
        del at, trained
        first, last, _ = levels[0]
        self.one = Level.of(np.arange(len(self.words)), self.words, np.arange(len(first)), *levels[0])
        keys = mixed(mixed(self.words[first]) + last)
        often = np.isin(self.words, frequent)[first]
        before = levels[1][0]
        self.two = Level.of(self.one.arcs, keys, np.flatnonzero(~often[before]), *levels[1])
        states = np.flatnonzero(often)
        states = states[np.argsort(keys[states] >> np.uint64(64 - KEY_BITS))]
        self.hot = Level.of(states, keys, np.flatnonzero(often[before]), *levels[1])

    def asked(self, low: int, high: int) -> list[np.ndarray]:
        """What is sent about histories with keys from low to high."""
        a, b = self.one.range(low, high)
        c, d = self.hot.range(low, high)
        heads, own = self.one.heads(a, b, low), self.one.tails(a, b)
        inner = self.two.tails(int(self.one.first[a]), int(self.one.first[b]))
        return [heads, *own, *inner, self.hot.heads(c, d, low), *self.hot.tails(c, d)]

    def traversed(self, answers: list[list[np.ndarray]], tokens: int, distinct: int, texts: int) -> tuple:
        """For each text tokens, known ones, and log10 chances by base and model.

        `answers` are for each level the tokens that follow its histories, the different ones, and the occurrences
        of each arc, all in training. All texts are traversed at once: from its longest state in training a token
        takes its arc if there is one; else the failure arc leads to the next shorter state, at last to the root.
        """
        levels = iter(zip((self.one, self.two, self.hot), answers))
        states, known = len(self.words), None
        arcs, fails = [], []
        for take, (before, suffix) in zip((1, 2), self.arcs):
            whole, kinds, times = np.zeros(states), np.zeros(states), np.zeros(len(before))
            for _ in range(take):
                level, answer = next(levels)
                for values, at, found in zip((whole, kinds, times), (level.order, level.order, level.arcs), answer):
                    values[at] = found
            if known is None:
                count = np.where(self.words == END, texts, whole)
                known, chance = count > 0, (count + 1) / (tokens + distinct + 1)
                base = np.log10(chance)[self.places[0]]
            left = np.where(whole > 0, DISCOUNT * kinds / np.maximum(whole, 1), 1.0)
            chance = np.maximum(times - DISCOUNT, 0) / np.maximum(whole, 1)[before] + left[before] * chance[suffix]
            arcs.append(np.where(times > 0, np.log10(chance), np.nan))
            fails.append(np.log10(left)[before])
            states = len(before)
        n = len(base)
        score, open_ = np.zeros(n), np.ones(n, bool)
        for place, arc, fail in zip(self.places[:0:-1], arcs[::-1], fails[::-1]):
            at = np.flatnonzero(open_ & (place >= 0))
            taken = arc[place[at]]
            found = ~np.isnan(taken)
            score[at] += np.where(found, taken, fail[place[at]])
            open_[at[found]] = False
        score[open_] += base[open_]
        starts = self.ends - self.sizes
        seen = known[self.places[0]].astype(np.int64)
        return self.sizes, *[np.add.reduceat(values, starts) for values in (seen, base, score)]


def _packed(arrays: list[np.ndarray]) -> bytes:
    """Arrays of whole numbers from 0 up in one binary, each in byte planes compressed one by one."""
    with io.BytesIO() as out:
        for values in arrays:
            values = np.ascontiguousarray(values, "<u8")
            width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
            planes = [zstandard.compress(p.tobytes(), 3) for p in values.view(np.uint8).reshape(-1, 8).T[:width]]
            out.write(struct.pack(f"<qB{width}q", len(values), width, *map(len, planes)))
            out.writelines(planes)
        return out.getvalue()


def _unpacked(data: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(data):
        n, width = struct.unpack_from("<qB", data, at)
        sizes = struct.unpack_from(f"<{width}q", data, at + 9)
        at += 9 + 8 * width
        values = np.zeros((n, 8), np.uint8)
        for plane, size in enumerate(sizes):
            values[:, plane] = np.frombuffer(zstandard.decompress(data[at : at + size]), np.uint8)
            at += size
        arrays.append(values.reshape(-1).view("<u8"))
    return arrays


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list[pa.RecordBatch], list[np.ndarray]]]:
    """A task's documents in blocks of about `most` tokens: number, rows, hashes of all tokens and ends of texts."""
    release()
    number, rows, parts, size = 0, [], [], 0

    def made() -> tuple[int, list[pa.RecordBatch], list[np.ndarray]]:
        named = (rows[0].column("task")[0].as_py() << 32) | number
        whole = [np.concatenate(column) for column in zip(*parts)]
        parts.clear()
        pa.default_memory_pool().release_unused()
        return named, rows, whole

    for batch, texts in bites(batches):
        hashes, ends = _tokens(texts)
        rows.append(batch)
        parts.append((hashes, ends + size))
        size += len(hashes)
        if size >= most:
            yield made()
            number, rows, parts, size = number + 1, [], [], 0
    if rows:
        yield made()


def _held(rows: list[pa.RecordBatch]) -> np.ndarray:
    return np.concatenate([np.array(r.column("held_out").to_pylist(), bool) for r in rows])


def _stamp(hashes: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) >> 1


def _bounds(parts: int) -> list[int]:
    return [(k << KEY_BITS) // parts for k in range(parts + 1)]


SENT = "block long, part int, stamp long, texts long, data binary"


def _row(*values) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    names = [field.split()[0] for field in SENT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _ask(most: int, parts: int, frequent: np.ndarray):
    """For each block a row to every part with its n-grams there."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds(parts)
        for number, rows, (hashes, ends) in _cut(batches, most):
            block, stamp = Block(hashes, ends, _held(rows), frequent), _stamp(hashes)
            del rows, hashes, ends
            block.places.clear()  # only a traversal needs them
            for part, (low, high) in enumerate(zip(bounds, bounds[1:])):
                data = _packed(block.asked(low, high))
                yield _row(number, part, stamp, block.texts, data)

    return ask


def _pack_texts(most: int):
    """For each block a row with its documents."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows, (hashes, _) in _cut(batches, most):
            stamp = _stamp(hashes)
            del hashes
            with io.BytesIO() as out:
                options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
                with pa.ipc.new_stream(out, rows[0].schema, options=options) as stream:
                    for batch in rows:
                        stream.write_batch(batch)
                yield _row(number, -1, stamp, 0, out.getvalue())

    return pack


def _same(history: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The history of each different arc, and which of them each arc is."""
    if not len(history) or int(history.max()) < 1 << (64 - MARK_BITS):
        codes, which = np.unique((history.astype(np.uint64) << np.uint64(MARK_BITS)) | marks, return_inverse=True)
        return (codes >> np.uint64(MARK_BITS)).astype(np.int64), which
    sort = np.lexsort((marks, history))
    new = np.concatenate([[True], (np.diff(history[sort]) != 0) | (np.diff(marks[sort]) != 0)])
    which = np.empty(len(sort), np.int64)
    which[sort] = np.cumsum(new) - 1
    return history[sort][new], which


def _answer(asked: pa.Table) -> pa.Table:
    """A part's histories and arcs, counted over all blocks, for each block in the order it asked for them."""
    lists = [_unpacked(data) for data in asked.column("data").to_pylist()]
    answers: list[list[np.ndarray]] = [[] for _ in lists]

    def joined(column: int) -> np.ndarray:
        return np.concatenate([arrays[column] for arrays in lists])

    def counted(states: np.ndarray, n: int, column: int) -> tuple[np.ndarray, np.ndarray]:
        """Answers about all blocks' histories, numbered by `states`; the tokens that follow each, and their arcs."""
        history, which = _same(np.repeat(states, joined(column).astype(np.int64)), joined(column + 1))
        times = np.bincount(which, joined(column + 2), len(history))
        whole, kinds = np.bincount(history, times, n), np.bincount(history[times > 0], minlength=n)
        at = arc = 0
        for own, arrays in zip(answers, lists):
            here, own_arcs = states[at : at + len(arrays[column])], which[arc : arc + len(arrays[column + 1])]
            own += [whole[here], kinds[here], times[own_arcs]]
            at, arc = at + len(here), arc + len(own_arcs)
        return whole, which

    def numbered(column: int) -> tuple[np.ndarray, int]:
        keys, which = np.unique(np.concatenate([np.cumsum(arrays[column]) for arrays in lists]), return_inverse=True)
        return which, len(keys)

    whole, bigrams = counted(*numbered(0), 1)
    counted(bigrams, int(bigrams.max(initial=-1)) + 1, 4)
    counted(*numbered(7), 8)
    totals = np.array([int(whole.sum()), int((whole > 0).sum()), sum(asked.column("texts").to_pylist())])
    data = [_packed([*own, totals]) for own in answers]
    return pa.table(
        [asked.column(c) for c in ("block", "part", "stamp", "texts")] + [pa.array(data, pa.binary())],
        asked.column_names,
    )


def _score_blocks(frequent: np.ndarray):
    """A block's documents, by the automaton of its n-grams with the answers of all parts."""

    def score(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("part")
        texts, *answered = rows.column("data").to_pylist()
        if rows.column("part")[0].as_py() != -1 or len(set(rows.column("stamp").to_pylist())) > 1 or not answered:
            raise ValueError("the documents were not read in the same order twice; write them to a table before")
        (_, batches, (hashes, ends)), = _cut(iter(pa.ipc.open_stream(texts)), 1 << 62)
        block = Block(hashes, ends, _held(batches), frequent)
        lists = [_unpacked(data) for data in answered]
        totals = np.sum([arrays.pop() for arrays in lists], axis=0)
        columns = [np.concatenate(column) for column in zip(*lists)]
        levels = [columns[k : k + 3] for k in range(0, len(columns), 3)]
        tokens, distinct, trained = int(totals[0]), int(totals[1]), int(totals[2]) // len(answered)
        sums = block.traversed(levels, tokens + trained, distinct + (trained > 0), trained)
        docs = pa.Table.from_batches(batches).select(["doc_id", "held_out"])
        names = ["n_tokens", "n_known", "base_score", "score"]
        every = pa.array(np.full(docs.num_rows, tokens + trained, np.int64))
        return pa.table([*docs.columns, *map(pa.array, sums), every], [*docs.column_names, *names, "train_tokens"])

    return score


def _frequent(rows: DataFrame, most: int, sample: int) -> np.ndarray:
    """Hashes of the most frequent words in a sample of about `sample` documents."""
    share = min(1.0, sample / max(1, rows.count()))
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    words = rows.sample(share, 7).select(F.explode(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))).alias("word"))
    found = words.groupBy("word").count().orderBy(F.col("count").desc(), "word").limit(most).collect()
    return np.concatenate([np.zeros(0, np.uint64), *(word_hashes([row["word"]])[0] for row in found)])


def whole_scores(
    docs: DataFrame,
    held: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    block: int = BLOCK_TOKENS,
    part: int = PART_CHARS,
    frequent_words: int = FREQUENT_WORDS,
) -> DataFrame:
    """Frame as of `score`, by a trigram model of all n-grams of the documents that are not held out.

    A task's documents are cut into blocks of about `block` tokens. Each sends its different n-grams to parts by
    hash of their first word, in one trie; trigrams that begin with one of the `frequent_words` go by hash of
    their first two (which words these are changes the load of parts only, and a sample tells them). A part
    counts the n-grams and answers every block in the order of its question. With the
    answers a block has the states, arcs and failure arcs of the whole model that its texts can reach, and is
    traversed. There is a part for every `part` characters. Documents are read twice in one plan, in the same
    order, as a table is; a block whose two readings differ is an error, not a wrong score.
    """
    with_package(docs.sparkSession)
    # The number of the partition read, which is the same wherever the plan reads it.
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        held.alias("held_out"),
        F.col(text).cast("string").alias("text"),
        F.spark_partition_id().alias("task"),
    )
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + chars // part
    frequent = _frequent(rows, frequent_words, SAMPLE_DOCS)
    asked = rows.mapInArrow(_ask(block, parts, frequent), SENT)
    answered = asked.groupBy("part").applyInArrow(_answer, SENT)
    packed = rows.mapInArrow(_pack_texts(block), SENT)
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, train_tokens long"
    scored = answered.unionByName(packed).groupBy("block").applyInArrow(_score_blocks(frequent), kinds)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """All documents scored by what the documents that are not held out teach."""
    docs = table(spark, folder, "documents")
    return whole_scores(docs, held_out())
