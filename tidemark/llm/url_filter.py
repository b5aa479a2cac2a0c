"""URL filters: host and path rules, then a Bloom filter cascade over listed hosts.

The key universe is known in full: every host of the corpus. A list names domains; the hosts of the
universe in them are the listed keys. The first level is a Bloom filter of the listed keys. The keys of the universe that are not listed but pass it
are the keys of the second level, the listed keys that pass the second are the keys of the third,
and so on until nothing passes by mistake. A key is listed exactly if the levels that it passes in
a row are odd in number, so a page is judged by looking at bits, without any join.

Defined results: a NULL url, or one without `://`, has an empty host and path, fits no rule and is
allowed; NULL keys are not listed; listed keys outside the universe change nothing; an empty list
allows everything; repeated rows are judged each; only the columns named here are used or returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bloom import fill, passes, words_for
from tidemark.llm.text import settle, table

# Verdict and host/path of the rules, longest first.
RULES = (("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"), ("block", "net/"))
# Labels whose domains the query lists.
LISTED = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
# Listed hosts up to this many are held as bits by every task (60 MB for the first level, a hundredth
# of that for the others). A longer list gives the same answers by a join on the host.
MOST_LISTED = 50_000_000


def parse_url(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    found = F.coalesce(F.locate("://", F.col(url)) > 0, F.lit(False))
    rest = F.substring_index(F.col(url), "://", 1)
    rest = F.substr(F.col(url), F.length(rest) + F.lit(4))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(found, lowered).otherwise(""), F.when(found, path).otherwise("")


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits a host (or a domain above it) and path start."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for say, written in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, start = written.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + start))
        rule = F.when(fits, F.lit(written)).otherwise(rule)
        verdict = F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def domains(host: Column) -> Column:
    """A host and every domain above it: a.b.c, b.c, c."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


@dataclass(frozen=True)
class Cascade:
    """Written one-row tables of 64-bit words, one for each level, with their number of words."""

    levels: tuple[tuple[DataFrame, int], ...]

    def lists(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for number, (bits, words) in reversed(list(enumerate(self.levels, 1))):
            answer = F.when(passes(key, number, words, bits), answer).otherwise(F.lit(number % 2 == 0))
        return F.when(key.isNull(), F.lit(False)).otherwise(answer)


def build_cascade(known: DataFrame) -> Cascade:
    """Cascade over a universe of distinct keys: (key, on), `on` for the listed ones.

    Each level after the second has about a hundredth of the keys of the one before last, so few
    levels are needed; only counts and bits come to the driver.
    """
    inside, outside, levels = known.filter("on"), known.filter(~F.col("on")), []
    while n := inside.count():
        words = words_for(n)
        levels.append((fill(inside, len(levels) + 1, words), words))
        passing = outside.filter(passes(F.col("key"), len(levels), words, levels[-1][0]))
        inside, outside = settle(passing.select("key")), inside
    return Cascade(tuple(levels))


def judge_pages(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    most_listed: int = MOST_LISTED,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Frame (page_id, host, path, rule, verdict); `listed` has the blocked domains as `key`.

    A page without a fitting rule is blocked if its host or a domain above it is listed.
    """
    host, path = parse_url(url)
    parsed = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = settle(_listed_hosts(parsed, listed))
    if known.filter("on").count() <= most_listed:
        tested = parsed.withColumn("hit", build_cascade(known).lists(F.col("host")))
    else:
        blocked = known.filter("on").select(F.col("key").alias("host"), F.lit(True).alias("hit"))
        tested = parsed.join(blocked, "host", "left")
    rule, said = fitting_rule(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(said, F.when(F.col("hit") & (F.col("host") != ""), F.lit("block")).otherwise(F.lit("allow")))
    return tested.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


def _listed_hosts(parsed: DataFrame, listed: DataFrame) -> DataFrame:
    """Every host of the corpus (key) and whether it lies in a listed domain (on); one shuffle for each join key."""
    hosts = parsed.filter(F.col("host") != "").select("host").distinct()
    above = hosts.select(F.col("host").alias("key"), F.explode(domains(F.col("host"))).alias("domain"))
    marks = listed.select(F.col("key").alias("domain"), F.lit(True).alias("mark")).distinct()
    found = above.join(marks, "domain", "left")
    return found.groupBy("key").agg(F.coalesce(F.max("mark"), F.lit(False)).alias("on"))


def listed_domains(pages: DataFrame, labels: Sequence[str] = LISTED, url: str = "url") -> DataFrame:
    """The domains of the corpus that begin with one of the labels."""
    host, _ = parse_url(url)
    hosts = pages.select(host.alias("host")).filter(F.col("host") != "").distinct()
    above = hosts.select(F.explode(domains(F.col("host"))).alias("key"))
    return above.filter(F.substring_index("key", ".", 1).isin(*labels) & F.contains("key", F.lit("."))).distinct()


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Every page judged by the rules and, beyond them, by the domains with a listed first label."""
    pages = table(spark, folder, "pages")
    return judge_pages(pages, listed_domains(pages))
