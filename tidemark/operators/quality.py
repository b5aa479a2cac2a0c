"""Data-quality rules, the valid/rejected split and the dead-letter set."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import join_lookup, settle

NULL_KEY = "NULL_CUSTOMER_ID"
FUTURE = "FUTURE_TIMESTAMP"
DUPLICATE = "DUPLICATE_EVENT"
NULL_TIME = "NULL_EVENT_TIME"
REASON = "dq_error_reason"


@dataclass(frozen=True)
class Rule:
    """A reason and the predicate a row breaks it by; a NULL predicate counts as not broken."""

    reason: str
    broken: Column


def standard_rules(as_of: Column, key: str = "customer_id", time: str = "event_time") -> list[Rule]:
    return [Rule(NULL_KEY, F.col(key).isNull()), Rule(FUTURE, F.col(time) > as_of)]


def untimed_rule(time: str = "event_time") -> Rule:
    """For rows as they arrive: without a time no lookback ever takes them up."""
    return Rule(NULL_TIME, F.col(time).isNull())


def any_broken(rules: Sequence[Rule]) -> Column:
    broken = F.lit(False)
    for rule in rules:
        broken = broken | F.coalesce(rule.broken, F.lit(False))
    return broken


def broken_rows(df: DataFrame, rule: Rule) -> DataFrame:
    return df.filter(rule.broken).withColumn(REASON, F.lit(rule.reason))


def repeated_ids(df: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Ids that occur more than once, with their count."""
    return df.groupBy(event_id).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def duplicate_rows(df: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Every copy of every repeated id; rows without an id are no duplicates."""
    ids = settle(repeated_ids(df, event_id).withColumnRenamed("copies", "count"))
    found = join_lookup(df, ids.select(event_id), event_id, "left_semi")
    return found.withColumn(REASON, F.lit(DUPLICATE))


def violations(df: DataFrame, rules: Sequence[Rule], event_id: str = "event_id") -> DataFrame:
    """One row per event and broken rule, rule by rule."""
    found = duplicate_rows(df, event_id)
    for rule in rules:
        found = found.unionByName(broken_rows(df, rule))
    return found


def flag(
    df: DataFrame,
    rules: Sequence[Rule],
    event_id: str = "event_id",
    null_id: str = "judge",
    unique_ids: bool = False,
) -> DataFrame:
    """Add `reasons` (rules the row breaks) and `rejected` (any row of its id breaks one).

    Ids are summarised first (combined before the shuffle); only those with something wrong go
    into the join, which is a broadcast while they are few. With `unique_ids`, as in a
    deduplicated table, each row stands for its id and nothing is shuffled. Rows without an id
    cannot share one: they are judged row by row, or always pass with null_id="leak".
    """
    broken = any_broken(rules)
    checks = [F.when(rule.broken, F.lit(rule.reason)) for rule in rules]
    if unique_ids:
        judged, rejected = df, broken
    else:
        suspects = settle(
            df.groupBy(event_id)
            .agg(F.count(F.lit(1)).alias("count"), F.max(broken).alias("_broken"))
            .filter((F.col("count") > 1) | F.col("_broken"))
            .filter(F.col(event_id).isNotNull())
            .drop("_broken")
        )
        lookup = suspects.withColumnRenamed("count", "_copies")
        judged = join_lookup(df, lookup, event_id, "left")
        checks.append(F.when(F.col("_copies") > 1, F.lit(DUPLICATE)))
        rejected = F.col("_copies").isNotNull()
    alone = broken if null_id == "judge" else F.lit(False)
    return judged.withColumns(
        {
            "reasons": F.array_compact(F.array(*checks)),
            "rejected": F.when(F.col(event_id).isNull(), alone).otherwise(rejected),
        }
    ).drop("_copies")


def dead_letters(flagged: DataFrame) -> DataFrame:
    """Violations of a flagged frame, one row per broken rule."""
    return flagged.withColumn(REASON, F.explode("reasons")).drop("reasons", "rejected")


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("rejected")).drop("reasons", "rejected")


def unseen_dead_letters(found: DataFrame, stored: DataFrame, event_id: str = "event_id") -> DataFrame:
    """Dead letters whose (id, reason) is not stored yet; those without an id always pass."""
    known = stored.filter(F.col(event_id).isNotNull()).select(event_id, REASON).distinct()
    return found.join(known, [event_id, REASON], "left_anti").select(*found.columns)
