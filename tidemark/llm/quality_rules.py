"""Quality rules as a short-circuit cascade.

Each rule is tried on a bounded sample: how many documents it rejects and how long it takes. Rules
then run in order of rejections per second, and a document is done with at the first rule that it
breaks. The order decides only how fast the verdict is found, never what it is.

All counts are per document and built in, without a shuffle: texts of any length stay in their row.

Defined results: a NULL or empty text has no words, lines or symbols and fails the base; equal rows
are judged each; an empty table gives none and leaves the rules in their written order; only the
columns named here are used, under names of their own.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.text import count_words, settle, table, words

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5
# Documents on which rules are tried: those with this residue of a text hash, up to the number.
SAMPLE_OF, SAMPLE_ROWS = 16, 2_000


def word_chars(text: Column) -> Column:
    """Code points in words."""
    return F.length(F.translate(text, WHITE, "")).cast("long")


def count_of(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def _lines(text: Column) -> Column:
    """Lines that have a word."""
    return F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, WHITE, "")) > 0)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = _lines(text)
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeated_words(df: DataFrame, listed: str, name: str) -> DataFrame:
    """Add how many words of an array lie in windows that are found twice or more in it.

    Windows are compared by a 64-bit hash. A text whose windows all differ, most do, is told by
    one pass; else equal windows are brought together by a sort within the row.
    """
    df = df.withColumn("_hashed", F.transform(listed, lambda word: F.xxhash64(word)))
    w = F.col("_hashed")
    starts = F.when(F.size(w) >= WINDOW, F.sequence(F.lit(0), F.size(w) - WINDOW)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_hashes", F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])))
    hashes = F.col("_hashes")
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    some = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn("_ordered", F.when(some, ordered))
    o = F.col("_ordered")
    twice = F.filter(
        o,
        lambda x, n: (F.get(o, n - 1)["h"].eqNullSafe(x["h"])) | (F.get(o, n + 1)["h"].eqNullSafe(x["h"])),
    )
    df = df.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    covered = F.aggregate(
        "_places",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    return df.withColumn(name, F.coalesce(covered, F.lit(0).cast("long"))).drop("_hashed", "_hashes", "_ordered", "_places")


def measures(text: Column) -> dict[str, Column]:
    """What rules may ask about a text, by name."""
    return {
        "n_words": count_words(text),
        "word_chars": word_chars(text),
        "n_symbols": count_of(text, SYMBOLS),
        "n_marks": count_of(text, "!"),
        "n_letters": F.length(F.regexp_replace(text, r"\P{L}+", "")),
        "n_dup_lines": duplicate_lines(text),
        "n_lines": F.size(_lines(text)),
    }


@dataclass(frozen=True)
class Rule:
    """What the measures of a text must satisfy."""

    name: str
    holds: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("few symbols", lambda m: 10 * m["n_symbols"] <= m["n_words"]),
    Rule("few exclamation marks", lambda m: 5 * m["n_marks"] <= m["n_words"]),
    Rule("words of usual length", lambda m: m["word_chars"].between(2 * m["n_words"], 15 * m["n_words"])),
    Rule("mostly letters", lambda m: 2 * m["n_letters"] >= m["word_chars"]),
    Rule("few repeated lines", lambda m: 10 * m["n_dup_lines"] <= 3 * m["n_lines"]),
)


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[Rule]:
    """The rules by rejections per second on the sample, most first."""
    known = F.coalesce(F.col(text), F.lit("")).alias("text")
    drawn = docs.select(known).filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_OF)) == 0).limit(SAMPLE_ROWS)
    sample, worth = settle(drawn), []
    for rule in rules:
        began = time.perf_counter()
        rejected = sample.filter(~rule.holds(measures(F.col("text")))).count()
        worth.append(((rejected + 1) / (time.perf_counter() - began), rule))
    if not sample.head(1):
        return list(rules)
    return [rule for _, rule in sorted(worth, key=lambda x: -x[0])]


def all_hold(rules: Sequence[Rule], known: dict[str, Column]) -> Column:
    """The cascade: a rule, and what it alone asks for, is evaluated only if those before it hold."""
    verdict = F.lit(True)
    for rule in reversed(rules):
        verdict = F.when(~rule.holds(known), F.lit(False)).otherwise(verdict)
    return verdict


def judge_quality(
    docs: DataFrame, rules: Sequence[Rule] = RULES, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Frame (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    The base fails below 10 words or if over 20 % of the words lie in repeated 5-word windows; the
    cascade is not asked about such a document.
    """
    order = ordered_rules(docs, rules, text)
    known = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), known.alias("text"), words(text).alias("_words"))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    rows = with_repeated_words(rows, "_words", "n_repeat_words")
    body = F.col("text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    asked = measures(body)
    counted = ["n_words", "word_chars", "n_symbols", "n_dup_lines"]
    rows = rows.withColumns({name: asked[name] for name in counted[1:]})
    known = asked | {name: F.col(name) for name in counted}
    kept = F.when(failed, F.lit(False)).otherwise(all_hold(order, known))
    return rows.select("doc_id", *counted, "n_repeat_words", failed.alias("base_failed"), kept.alias("kept"))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All documents with their counts and verdicts."""
    return judge_quality(table(spark, folder, "documents"))
