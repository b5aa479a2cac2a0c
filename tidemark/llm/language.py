"""Language by cross-parsing: which language's text explains a document in the fewest phrases.

For each language a suffix automaton holds all substrings of its labelled sample. A text is parsed
greedily: follow the automaton as far as it goes, count a phrase, start again. Parsing with a
sample of n characters costs log2(n) bits a phrase; the language with the fewest bits wins. Only
letters are parsed: words one by one with a blank for all else, so that a word's phrases are found
once for a task's many occurrences of it, and every word of a text of any length counts.

The labelled sample is made from counts over all labelled text (`counted`): every word, and every run of up to GRAM
letters, is counted in each whole text, and those that SAMPLE_CHARS characters of the label's text would hold at
least once on average make up its sample, the most frequent first. So the sample is bounded by what it is made of,
whatever the number of texts, and a few texts in another language add nothing to a label with many. A word longer than
LONG letters counts by its runs. With very many labels each has an equal share of TOTAL_CHARS, but LEAST_CHARS at
least (an automaton takes about 330 bytes a character in every Python worker). Every label is learned. One with less
text keeps all of its words and takes nothing from the others; below LEAST_CHARS its phrases cost as much as with
LEAST_CHARS, so that a few characters explain no other text cheaply. Only the sample goes through the driver.

`accepted` also tells texts in no language learned by their bits a character. The limit of a label is MOST_BITS,
or more if its own text needs more: 1.1 times what OWN_SHARE of all its texts stay within.

Defined results: a NULL text and one without any letter is `und` with score 0, as is every text when
there is nothing to learn from; equal bits go to the first label by code point; rows without a label
or text teach nothing; equal rows get equal answers; other columns pass through untouched.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.text import settle, table, with_package
from tidemark.llm.tokens import AT_ONCE, bites, held, release

SAMPLE_CHARS = 40_000
LEAST_CHARS = 1024
TOTAL_CHARS = 2_400_000
# Letters of the runs that are counted, letters of a word that is counted as one, bytes of different words a task holds.
GRAM, LONG, HELD_BYTES = 3, 64, 1 << 24
# A text counts as much as so many; its copies share that.
WEIGHT = 1 << 20
PIECES = "lang string, gram boolean, piece string, n long"
UNKNOWN = "und"
# Words whose phrases a task remembers, and how many phrase counts at most.
REMEMBERED, REMEMBERED_COUNTS = 350_000, 1 << 22
# Words looked up at a time: so many, or more with few languages, up to so many phrase counts.
STEP, STEP_COUNTS = 4096, 1 << 20
# The query and the pipeline learn from documents with another remainder.
HELD_OUT = (4, 2)
LETTER, OTHER = re.compile(r"[^\W\d_]"), re.compile(r"[\W\d_]+")
# The same between words that a line break keeps apart.
OTHERS = re.compile(r"(?:[^\w\n]|[\d_])+")
# More bits a character than this (phrases of under three letters) say that a text is in no language learned.
MOST_BITS, OWN_SHARE = 6.0, 0.95


def held_out(doc_id: str = "doc_id", folds: tuple[int, int] = HELD_OUT) -> Column:
    """Whether the crc32 of the id as text has the held-out remainder; a NULL id has not."""
    of, remainder = folds
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % of == remainder, F.lit(False))


def _plains(words: list[str]) -> list[str]:
    """What is parsed of each word, without the blanks around it."""
    # No word has a line break, so that all are changed at once and stay apart.
    return [plain.strip() for plain in OTHERS.sub(" ", "\n".join(words).lower()).split("\n")]


def _summed(**columns: pa.Array) -> pa.Table:
    """The sums of `n` for each combination of the other columns."""
    keys = [name for name in columns if name != "n"]
    return pa.table(columns).group_by(keys, use_threads=False).aggregate([("n", "sum")]).rename_columns([*keys, "n"])


def _grams(plains: list[str], n: np.ndarray) -> Iterator[tuple[list[str], pa.Array]]:
    """Counts of the runs of letters (and blanks at their ends) of plain words that occur `n` times, size by size."""
    points = np.frombuffer(f" {' \n '.join(plains)} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    apart = points == 10
    times, key, within = n[np.cumsum(apart)], np.zeros(len(points), np.uint64), ~apart
    for size in range(1, GRAM + 1):
        # The key of the run from here is that of the shorter one and one letter more, of 21 bits.
        last = len(points) - size + 1
        key = (key[:last] << np.uint64(21)) | points[size - 1 :]
        within = within[:last] & ~apart[size - 1 :]
        counts = _summed(key=pa.array(key[within]), n=pa.array(times[:last][within]))
        letters = counts["key"].to_numpy()[:, None] >> np.arange(21 * (size - 1), -1, -21, dtype=np.uint64)
        runs = np.ascontiguousarray(letters & np.uint64((1 << 21) - 1), np.uint32).tobytes().decode("utf-32-le")
        yield [runs[at : at + size] for at in range(0, len(runs), size)], counts["n"].combine_chunks()


def _pieces(words: list[str], n: pa.Array) -> Iterator[tuple[bool, list[str | None], pa.Array]]:
    """Counts of the plain words and of their runs of letters, and of all characters, of words that occur `n` times."""
    whole = _summed(plain=pa.array(_plains(words), pa.string()), n=n)
    whole = whole.filter(pc.not_equal(whole["plain"], ""))
    plains, n = whole["plain"].to_pylist(), whole["n"].to_numpy()
    sizes = np.fromiter(map(len, plains), np.int64, len(plains))
    yield False, [None], pa.array([int((n * (sizes + 1)).sum())], pa.int64())
    if plains:
        short = sizes <= LONG
        yield False, [plain for plain, kept in zip(plains, short) if kept], pa.array(n[short])
        for runs, counts in _grams(plains, n):
            yield True, runs, counts


def _words(batch: pa.RecordBatch) -> pa.Table:
    """Weight of each label's different words in the texts of a batch."""
    split = pc.ascii_split_whitespace(batch.column("text"))
    coded = split.flatten().dictionary_encode()
    row = pc.list_parent_indices(split)
    found = _summed(
        lang=batch.column("lang").dictionary_encode().indices.take(row), word=coded.indices, n=batch.column("weight").take(row)
    )
    langs = batch.column("lang").dictionary_encode().dictionary
    return pa.table(
        {"lang": langs.take(found["lang"]), "word": coded.dictionary.take(found["word"]), "n": found["n"]}
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the pieces of a task's texts; those without a piece are all characters of the label."""
    release()
    known: list[pa.Table] = []

    def joined() -> pa.Table:
        words = pa.concat_tables(known)
        return _summed(lang=words["lang"], word=words["word"], n=words["n"])

    def emptied(words: pa.Table) -> Iterator[pa.RecordBatch]:
        for lang in words["lang"].unique():
            own = words.filter(pc.equal(words["lang"], lang))
            for gram, pieces, n in _pieces(own["word"].to_pylist(), own["n"]):
                names = pa.repeat(lang, len(pieces)), pa.repeat(pa.scalar(gram), len(pieces))
                yield pa.RecordBatch.from_arrays([*names, pa.array(pieces, pa.string()), n], ["lang", "gram", "piece", "n"])

    for batch, _ in bites(batches):
        known.append(_words(batch))
        if sum(table.nbytes for table in known) > HELD_BYTES:
            known = [joined()]
            if known[0].nbytes > HELD_BYTES // 2:
                yield from emptied(known.pop())
    if known:
        yield from emptied(joined())


def counted(labelled: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Frame (lang, gram, piece, n): how often all texts of a label hold each word, or run of letters (`gram`).

    Copies of a text count as one text; `n` is in units of 1 / WEIGHT. The row without a piece has the label's characters.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    again = settle(rows.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1"))
    weight = F.expr(f"{WEIGHT} div coalesce(copies, 1)").alias("weight")
    weighed = rows.join(again, ["lang", "hash"], "left").select("lang", "text", F.greatest(weight, F.lit(1)).alias("weight"))
    with_package(labelled.sparkSession)
    pieces = weighed.mapInArrow(_count, PIECES)
    return pieces.groupBy("lang", "gram", "piece").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"))


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, str]:
    """Sample text of each language: its words and runs of letters that are frequent enough in all its text."""
    pieces = settle(counted(labelled, text, lang))
    # One row for each label.
    totals = settle(pieces.filter("piece IS NULL AND n > 0").select("lang", F.col("n").cast("double").alias("chars")))
    share = min(SAMPLE_CHARS, max(LEAST_CHARS, TOTAL_CHARS // max(1, totals.count())))
    frequent = pieces.filter("piece IS NOT NULL").join(totals, "lang").filter(F.col("n").cast("double") * share >= F.col("chars"))
    # No more than this many pieces fill a sample.
    first = Window.partitionBy("lang", "gram").orderBy(F.desc("n"), F.desc("piece"))
    frequent = frequent.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= share)
    samples: dict[str, str] = {}
    for row in frequent.orderBy("lang", "gram", "place").select("lang", "gram", "piece").collect():
        so_far = samples.get(row["lang"], " ")
        if len(so_far) >= share:
            continue
        if not row["gram"]:
            samples[row["lang"]] = f"{so_far}{row['piece']} "
        elif row["piece"] not in so_far:
            # No text has a line break between its words, so that runs stay apart.
            samples[row["lang"]] = f"{so_far}\n{row['piece']}"
    return {name: samples[name][:share] for name in sorted(samples) if LETTER.search(samples[name])}


def suffix_automaton(text: str) -> list[dict[str, int]]:
    """Arcs of the smallest automaton that follows exactly the substrings of a text."""
    arcs: list[dict[str, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in text:
        state = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and symbol not in arcs[p]:
            arcs[p][symbol] = state
            p = link[p]
        if p >= 0:
            q = arcs[p][symbol]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(arcs)
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and arcs[p].get(symbol) == q:
                    arcs[p][symbol] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return arcs


def phrases(arcs: list[dict[str, int]], text: str) -> int:
    """Longest matches, end to end; a symbol that the automaton lacks is one by itself."""
    found, state, root = 0, 0, arcs[0]
    for symbol in text:
        further = arcs[state].get(symbol)
        if further is None:
            found += state > 0
            further = root.get(symbol, 0)
            found += further == 0
        state = further
    return found + (state > 0)


class Parser:
    """The languages' automata in a task, with the phrases of the words met so far."""

    def __init__(self, samples: dict[str, str]):
        self.names = list(samples)
        self.automata = [suffix_automaton(sample) for sample in samples.values()]
        self.bits = np.log2([max(LEAST_CHARS, len(sample)) for sample in samples.values()])
        self.rows: dict[str, int] = {}
        # Phrases of a word in each language, and its characters.
        self.most = max(2 * STEP, min(REMEMBERED, REMEMBERED_COUNTS // (len(self.names) + 1)))
        self.step = min(self.most // 2, max(STEP, STEP_COUNTS // (len(self.names) + 1)))
        self.counts = np.zeros((self.most, len(self.names) + 1))

    def _places(self, words: list[str]) -> np.ndarray:
        """Rows of `counts` of different words, no more than it has."""
        # Words that differ in capitals and in what is no letter are parsed alike.
        plains = _plains(words)
        places = list(map(self.rows.get, plains))
        if len(self.rows) + places.count(None) > self.most:
            self.rows.clear()
            places = [None] * len(words)
        for at, place in enumerate(places):
            if place is None:
                places[at] = self._row(plains[at])
        return np.array(places, np.int64)

    def _row(self, plain: str) -> int:
        row = self.rows.get(plain)
        if row is None:
            row = self.rows[plain] = len(self.rows)
            text = f" {plain} "
            self.counts[row] = [*(phrases(arcs, text) for arcs in self.automata), len(text)] if plain else 0
        return row

    def costs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text in each language, and its characters."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        words, row = split.flatten(), pc.list_parent_indices(split).to_numpy()
        total = np.zeros((len(texts), len(self.names) + 1))
        for at in range(0, len(words), self.step):
            coded, own = words.slice(at, self.step).dictionary_encode(), row[at : at + self.step]
            counts = self.counts[self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            total[own[first]] += np.add.reduceat(counts, first, axis=0)
        return total[:, :-1] * self.bits, total[:, -1]

    def predictions(self, texts: list[str | None]) -> Iterator[tuple[str, float, float | None]]:
        """Language, score and bits a character of each text."""
        plain = [text if self.names and text is not None and LETTER.search(text) else None for text in texts]
        begin, size = 0, 0
        for end, text in enumerate([*plain, None], 1):
            size += len(text or "")
            if size >= AT_ONCE or end > len(plain):
                yield from self._predicted(plain[begin:end])
                begin, size = end, 0

    def _predicted(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        found: list[tuple[str, float, float | None]] = [(UNKNOWN, 0.0, None)] * len(texts)
        parsed = [at for at, text in enumerate(texts) if text is not None]
        if parsed:
            cost, size = self.costs([texts[at] for at in parsed])
            best = cost.argmin(axis=1)
            least = cost[np.arange(len(best)), best]
            share = 1 / np.exp2(np.maximum(least[:, None] - cost, -1000)).sum(axis=1)
            bits = least / np.maximum(1, size)
            for at, *one in zip(parsed, best.tolist(), share.tolist(), bits.tolist()):
                found[at] = (self.names[one[0]], one[1], one[2])
        return found


def _parser(samples: dict[str, str]) -> Parser:
    known = zlib.crc32("\0".join([*samples, *samples.values()]).encode("utf-8", "replace"))
    return held(("language", known), lambda: Parser(samples))


def predicted(spark: SparkSession, samples: dict[str, str], text: str | Column = "text") -> Column:
    """Struct (lang, score, bits) of a text: the language, the share of its likelihood, 2**-bits, in the sum
    over languages, and its bits a character."""
    sent = with_package(spark).sparkContext.broadcast(samples)

    @F.pandas_udf("lang string, score double, bits double")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = _parser(sent.value)
        for texts in batches:
            yield pd.DataFrame(list(parser.predictions(texts.tolist())), columns=["lang", "score", "bits"])

    return parse(F.col(text) if isinstance(text, str) else text)


def identify(
    docs: DataFrame, labelled: DataFrame, name: str = "language", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """All rows of `docs` with the struct column `name`; `labelled` rows teach."""
    return docs.withColumn(name, predicted(docs.sparkSession, learn(labelled, text, lang), text))


def accepted(
    docs: DataFrame,
    labelled: DataFrame,
    least: float = 0.3,
    most: float = MOST_BITS,
    wanted: Sequence[str] | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Documents in a known (and wanted) language: a share of at least `least`, and bits within the label's limit.

    `among` tells which rows of `docs` are the `labelled` ones, if they are some of them: all are then parsed once.
    """
    name = "language"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    samples = learn(labelled)
    told = docs.withColumn(name, predicted(docs.sparkSession, samples))
    if among is None:
        own = labelled.select("text", "lang").withColumn(name, predicted(docs.sparkSession, samples))
    else:
        told = settle(told)
        own = told.filter(among)
    limit = F.lit(most)
    if higher := _limits(own, name, most):
        pairs = F.create_map(*[F.lit(x) for pair in sorted(higher.items()) for x in pair])
        limit = F.coalesce(F.element_at(pairs, F.col(name)["lang"]), limit)
    fine = (F.col(name)["lang"] != UNKNOWN) & (F.col(name)["score"] >= least) & (F.col(name)["bits"] <= limit)
    if wanted is not None:
        fine = fine & F.col(name)["lang"].isin(*wanted)
    return told.filter(fine).drop(name)


def _limits(own: DataFrame, name: str, most: float) -> dict[str, float]:
    """Bits a character of labels whose own text needs more than `most`, by all texts with the label, told in `name`."""
    own = own.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col(f"{name}.bits").isNotNull())
    # In steps of 1 / 64, so that a label has few different values however many texts it has.
    bits = F.ceil(F.col(f"{name}.bits") * 64) / 64
    needed = own.groupBy("lang").agg(F.percentile(bits, F.lit(OWN_SHARE)).alias("bits"))
    return {lang: 1.1 * bits for lang, bits in needed.filter(1.1 * F.col("bits") > most).collect()}


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = table(spark, folder, "documents")
    told = identify(docs.select("doc_id", "text"), docs.filter(~held_out()))
    return told.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
