"""Point-in-time join of facts to the version valid at their time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.intervals import join_valid
from tidemark.operators.skew import BROADCAST_ROWS, Ordered, join_lookup, settle
from tidemark.session import setting

# Versions per key up to which comparing a fact with each of them is cheaper than sorting.
FEW_VERSIONS = 256


def _range_join(facts: DataFrame, versions: DataFrame, key: str, time: str, carry: Sequence[str]) -> DataFrame:
    """Equi-join to few versions, with the validity window as residual condition."""
    v = versions.select(key, "start_date", "end_date", *[c for c in carry if c not in ("start_date", "end_date")])
    v = v.toDF(*[f"_v_{name}" for name in v.columns])
    valid = (
        (F.col(key) == F.col(f"_v_{key}"))
        & (F.col(time) >= F.col("_v_start_date"))
        & (F.col("_v_end_date").isNull() | (F.col(time) < F.col("_v_end_date")))
    )
    joined = facts.join(v, valid, "left")
    return joined.select(*facts.columns, *[F.col(f"_v_{name}").alias(name) for name in carry])


def _running_join(facts: DataFrame, versions: DataFrame, key: str, time: str, carry: Sequence[str]) -> DataFrame:
    """Versions and facts in one time-ordered pass; a fact takes the last version before it.

    One shuffle and one sort, and no pair of fact and version is ever formed, so many facts times
    many versions of one key stays linear. Needs versions that do not overlap and cover some time.
    At equal times versions come first; a fact without a time sorts before all of them.
    """
    held = list(dict.fromkeys([*carry, "end_date"]))
    # Key and time travel once, unless the union gives them another type.
    kind = lambda df, name: df.select(name).schema[0].dataType
    twice = (key, key, key), (time, "start_date", "_at")
    once = {c: union for c, start, union in twice if kind(facts, c) == kind(versions, start)}
    moved = {c: f"_fact_{c}" for c in facts.columns if c not in once}
    starts = versions.select(
        key,
        F.col("start_date").alias("_at"),
        F.lit(0).alias("_kind"),
        F.struct(*held).alias("_version"),
    )
    placed = facts.select(
        key,
        F.col(time).alias("_at"),
        F.lit(1).alias("_kind"),
        *[F.col(c).alias(name) for c, name in moved.items()],
    )
    both = starts.unionByName(placed, allowMissingColumns=True)
    rows = Ordered.by(both, key, ("_at", "_kind")).latest("_version", "_found")
    found = rows.frame().filter(F.col("_kind") == 1)
    until = F.col("_found.end_date")
    valid = until.isNull() | (F.col("_at") < until)
    own = [F.col((moved | once)[c]).alias(c) for c in facts.columns]
    return found.select(*own, *[F.when(valid, F.col(f"_found.{name}")).alias(name) for name in carry])


def _ordered_join(
    facts: DataFrame, versions: DataFrame, key: str, time: str, carry: Sequence[str], contiguous: bool
) -> DataFrame:
    """The running form where versions do not overlap; keys whose versions do are joined by time buckets.

    Versions that cover no time match nothing and are left out. Unless all are known to be contiguous, one
    ordered pass over the rest finds the keys with a version that starts before the one before it ends.
    """
    covering = (F.col("start_date") < F.col("end_date")) | F.col("end_date").isNull()
    versions = versions.filter(F.col(key).isNotNull() & F.col("start_date").isNotNull() & covering)
    keyed, keyless = facts.filter(F.col(key).isNotNull()), facts.filter(F.col(key).isNull())
    if contiguous:
        # Facts without a key find nothing and need not travel; Parquet skips files that have none.
        return _running_join(keyed, versions, key, time, carry).unionByName(keyless, allowMissingColumns=True)
    spans = versions.select(key, "start_date", "end_date")
    next_start = Ordered.by(spans, key, ("start_date", "end_date")).following("start_date", "_next").frame()
    overlap = F.col("_next") < F.col("end_date")
    overlap = overlap | (F.col("end_date").isNull() & F.col("_next").isNotNull())
    several = settle(next_start.filter(overlap).select(key).distinct())
    if several.isEmpty():
        joined = _running_join(keyed, versions, key, time, carry)
    else:
        single = [join_lookup(df, several, key, "left_anti") for df in (keyed, versions)]
        shared = [join_lookup(df, several, key, "left_semi") for df in (keyed, versions)]
        joined = _running_join(*single, key, time, carry).unionByName(join_valid(*shared, key, time, carry))
    return joined.unionByName(keyless, allowMissingColumns=True)


def _small(versions: DataFrame, key: str) -> bool:
    """Whether the versions fit a broadcast, all together and per key."""
    per_key = versions.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total, most = per_key.agg(F.sum("n"), F.max("n")).first()
    limit = setting(versions.sparkSession, "broadcastRows", BROADCAST_ROWS)
    few = setting(versions.sparkSession, "fewVersions", FEW_VERSIONS)
    return total is None or (total <= limit and most <= few)


def join_as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    time: str,
    carry: Sequence[str],
    how: str = "auto",
    contiguous: bool = False,
) -> DataFrame:
    """Every fact with the `carry` columns of each version valid at its time, or NULLs.

    `how`: "range" (versions that are few are broadcast, others go by time buckets), "buckets" (always by time
    buckets), "running" (one ordered pass; keys with overlapping versions by time buckets), or "auto",
    which counts the versions first: range if they are few, else running. All give the same rows, also where
    validity windows overlap. `contiguous` states that no two versions of a key overlap, as in a history
    that this library built, and saves the pass that looks for overlaps.
    """
    if how == "buckets":
        return join_valid(facts, versions, key, time, carry)
    if how == "running":
        return _ordered_join(facts, versions, key, time, carry, contiguous)
    few = _small(versions, key)
    if few:
        return _range_join(facts, F.broadcast(versions), key, time, carry)
    if how == "auto":
        return _ordered_join(facts, versions, key, time, carry, contiguous)
    return join_valid(facts, versions, key, time, carry)
