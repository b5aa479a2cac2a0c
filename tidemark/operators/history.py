"""Type-2 history: build it, fold batches into it, rebuild it for late events."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import with_hash
from tidemark.functions.keys import moved
from tidemark.functions.times import ntz
from tidemark.operators.skew import Ordered, hot_keys, join_lookup, prefix_sum, settle


@dataclass(frozen=True)
class History:
    """Which event columns make up a dimension."""

    tracked: tuple[str, ...] = ("first_name", "last_name", "email", "city", "country")
    key: str = "customer_id"
    time: str = "event_time"
    event_id: str = "event_id"
    null_safe_hash: bool = False

    @property
    def columns(self) -> list[str]:
        dates = ["start_date", "end_date", "is_current", "hash_diff", "source_event_id"]
        return [self.key, *self.tracked, *dates]

    def staged(self, events: DataFrame) -> DataFrame:
        """Events as candidate versions, still without an end."""
        hashed = with_hash(events, self.tracked, self.null_safe_hash)
        return hashed.select(
            self.key,
            *self.tracked,
            F.col(self.time).alias("start_date"),
            "hash_diff",
            F.col(self.event_id).alias("source_event_id"),
        )


def _closed(rows: Ordered, spec: History, *also: str) -> DataFrame:
    """Each remaining row ends where the next one of its key starts."""
    ended = rows.following("start_date", "end_date").frame()
    return ended.withColumn("is_current", F.col("end_date").isNull()).select(*spec.columns, *also)


def _changed() -> Column:
    return F.col("_before").isNull() | (F.col("_before") != F.col("hash_diff"))


def versions(
    events: DataFrame, spec: History, collapse: bool = True, counts_from: DataFrame | None = None
) -> DataFrame:
    """Whole history from events, ordered by (time, event id).

    `collapse` keeps only rows whose hash differs from the row before; without it every event is
    a version. Both windows share one shuffle and one sort.
    """
    staged = spec.staged(events)
    rows = Ordered.by(staged, spec.key, ("start_date", "source_event_id"), counts_from, unique=True)
    if collapse:
        rows = rows.previous("hash_diff", "_before").filter(_changed())
    return _closed(rows, spec)


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def as_of(dim: DataFrame, moment: Column) -> DataFrame:
    """Versions valid at `moment`; the end is exclusive."""
    return dim.filter(
        (F.col("start_date") <= moment) & (F.col("end_date").isNull() | (moment < F.col("end_date")))
    )


def changed_windows(old: DataFrame, new: DataFrame, spec: History, version: str) -> DataFrame:
    """Windows (key, start_date, end_date) in which the `version` valid at a time may differ between two states.

    Those are the windows of versions that only one of them has; equal versions cancel out in one grouped sum.
    """
    columns = [spec.key, version, "start_date", "end_date"]
    sides = [moved(df.select(*columns), version).withColumn("side", F.lit(side)) for df, side in ((old, -1), (new, 1))]
    differing = sides[0].unionByName(sides[1]).groupBy(*columns).agg(F.sum("side").alias("side")).filter("side <> 0")
    return differing.select(spec.key, "start_date", "end_date").distinct()


def valid_per_day(dim: DataFrame) -> DataFrame:
    """How many versions are valid at the start of each day, from the first change to the last.

    A sweep line: a version adds one on the first day that starts with it, and takes one away on the first that
    starts without. Changes are summed for each day before any shuffle; no version meets a calendar.
    """

    def first_day(moment: str) -> Column:
        day = F.to_date(moment)
        return F.when(day.cast("timestamp_ntz") < F.col(moment), F.date_add(day, 1)).otherwise(day).alias("day")

    begins = dim.filter("start_date IS NOT NULL").select(first_day("start_date"), F.lit(1).alias("change"))
    ends = dim.filter("start_date IS NOT NULL AND end_date IS NOT NULL").select(first_day("end_date"), F.lit(-1).alias("change"))
    changes = settle(begins.unionByName(ends).groupBy("day").agg(F.sum("change").alias("change")))
    bounds = changes.agg(F.min("day").alias("a"), F.max("day").alias("b")).filter("a IS NOT NULL")
    calendar = bounds.select(F.explode(F.sequence("a", "b")).alias("day"), F.lit(0).cast("long").alias("change"))
    daily = changes.unionByName(calendar).groupBy("day").agg(F.sum("change").alias("change"))
    return prefix_sum(daily, ["day"], "change", "versions").select("day", "versions")


def with_current_start(batch: DataFrame, dim: DataFrame, spec: History) -> DataFrame:
    """Each event with the start of its key's current version (NULL for a new key)."""
    starts = current(dim).select(spec.key, F.col("start_date").alias("current_start"))
    return join_lookup(batch, starts, spec.key, "left")


def late_events(batch: DataFrame, dim: DataFrame, spec: History) -> DataFrame:
    """Events before the start of the current version; an equal time is not late."""
    return with_current_start(batch, dim, spec).filter(F.col(spec.time) < F.col("current_start"))


def touched_keys(batch: DataFrame, dim: DataFrame, spec: History) -> DataFrame:
    """One row per key of the batch, with the time of its first event there.

    `late`: that event is before the start of the current version. `tied`: it is at the start,
    but has a lower id than the event that opened the version.
    """
    earliest = F.min(F.struct(spec.time, spec.event_id)).alias("_earliest")
    first = settle(batch.groupBy(spec.key).agg(earliest))
    starts = current(dim).select(
        spec.key, F.col("start_date").alias("_start"), F.col("source_event_id").alias("_source")
    )
    starts = join_lookup(starts, first.select(spec.key), spec.key, "left_semi")
    time, source = F.col(f"_earliest.{spec.time}"), F.col(f"_earliest.{spec.event_id}")
    late = F.coalesce(time < F.col("_start"), F.lit(False))
    tied = F.coalesce((time == F.col("_start")) & (source < F.col("_source")), F.lit(False))
    return first.join(starts, spec.key, "left").select(
        spec.key, time.alias("first_time"), late.alias("late"), tied.alias("tied")
    )


def without_keys(dim: DataFrame, keys: DataFrame, spec: History) -> DataFrame:
    """Drop the whole history of the given keys."""
    return join_lookup(dim, keys.select(spec.key), spec.key, "left_anti")


def changed_events(batch: DataFrame, dim: DataFrame, spec: History) -> DataFrame:
    """Events whose hash is not that of their key's current version."""
    known = current(dim).select(spec.key, F.col("hash_diff").alias("_known"))
    staged = with_hash(batch, spec.tracked, spec.null_safe_hash)
    joined = join_lookup(staged, known, spec.key, "left")
    return joined.filter(~F.col("_known").eqNullSafe(F.col("hash_diff"))).drop("_known")


def fold(
    open_rows: DataFrame, batch: DataFrame, spec: History, counts_from: DataFrame | None = None
) -> DataFrame:
    """Current versions and on-time events folded in one ordered pass.

    The current version enters as the first row of its key, so the comparison with it, its
    expiry and the new versions' ends all come from the same two windows. `is_stored` marks the
    rows that were in the dimension before.
    """
    stored = open_rows.drop("end_date", "is_current").withColumn("_new", F.lit(0))
    arrived = spec.staged(batch).withColumn("_new", F.lit(1))
    both = stored.unionByName(arrived, allowMissingColumns=True)
    extra = [name for name in open_rows.columns if name not in spec.columns]
    order = ("_new", "start_date", "source_event_id")
    rows = Ordered.by(both, spec.key, order, counts_from, unique=True)
    rows = rows.previous("hash_diff", "_before").filter((F.col("_new") == 0) | _changed())
    return _closed(rows, spec, *extra, "_new").withColumn("is_stored", F.col("_new") == 0).drop("_new")


def _on_time(dim: DataFrame, batch: DataFrame, spec: History) -> tuple[DataFrame, DataFrame]:
    keys = settle(touched_keys(batch, dim, spec).filter(~F.col("late")).select(spec.key))
    return join_lookup(current(dim), keys, spec.key, "left_semi"), join_lookup(batch, keys, spec.key, "left_semi")


def expired_versions(dim: DataFrame, batch: DataFrame, spec: History) -> DataFrame:
    """Stored current versions that an on-time change closes."""
    folded = fold(*_on_time(dim, batch, spec), spec, counts_from=batch)
    return folded.filter(F.col("is_stored") & ~F.col("is_current")).drop("is_stored")


def new_versions(dim: DataFrame, batch: DataFrame, spec: History) -> DataFrame:
    """Versions that on-time changes open."""
    folded = fold(*_on_time(dim, batch, spec), spec, counts_from=batch)
    return folded.filter(~F.col("is_stored")).drop("is_stored")


def merge(
    dim: DataFrame, batch: DataFrame, events: DataFrame, spec: History, collapse: bool = True
) -> DataFrame:
    """The dimension after a batch.

    Keys with a late event are rebuilt from all their `events`; other keys of the batch are
    folded onto their current version; everything else passes through. The number of Spark jobs
    does not depend on the number of rows or late events.
    """
    keys = settle(touched_keys(batch, dim, spec).select(spec.key, "late"))
    late = keys.filter("late").select(spec.key)
    on_time = keys.filter(~F.col("late")).select(spec.key)

    routed = join_lookup(dim, keys, spec.key, "left")
    folding = (F.col("late") == F.lit(False)) & F.col("is_current")
    passing = routed.filter(F.col("late").isNull() | (~F.col("late") & ~F.col("is_current"))).drop("late")
    arrived = join_lookup(batch, on_time, spec.key, "left_semi")
    folded = fold(routed.filter(folding).drop("late"), arrived, spec, counts_from=batch).drop("is_stored")
    merged = passing.unionByName(folded)
    if late.isEmpty():
        return merged
    rebuilt = versions(join_lookup(events, late, spec.key, "left_semi"), spec, collapse)
    return merged.unionByName(rebuilt, allowMissingColumns=True)


def merge_bucketed(
    dim: DataFrame, batch: DataFrame, events: DataFrame, spec: History, buckets: int, collapse: bool = True
) -> DataFrame:
    """`merge` into a dimension table bucketed by key (with the columns of `spec`), which is read once and not shuffled.

    The batch comes to the table's buckets. There, stored rows and events of a key are one ordered
    group: the closed versions, the current one, then the events. Routing (is the key in the batch, is it
    late) and comparison are windows over one sort; rows of late keys leave one marker, from which they
    are rebuilt. A batch with hot keys goes through `merge`, which splits them.
    """
    if hot_keys(batch, spec.key):
        return merge(dim, batch, events, spec, collapse)
    # Events have no end and no state yet: a NULL `is_current` tells them from stored rows.
    open_end = {"end_date": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(None).cast("boolean")}
    arrived = spec.staged(batch).withColumns(open_end).select(*spec.columns).repartition(buckets, spec.key)
    order = [F.col("is_current").asc_nulls_last(), "start_date", "source_event_id"]
    # Sorted right above the union: a projection that slips in between costs it the table's partitioning.
    both = dim.select(*spec.columns).union(arrived).sortWithinPartitions(spec.key, *order)
    line = Window.partitionBy(spec.key).orderBy(*order)
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    is_new, is_open = F.col("is_current").isNull(), F.coalesce("is_current", F.lit(False))
    first = F.min(F.when(is_new, F.col("start_date"))).over(whole)
    opened = F.max(F.when(is_open, F.col("start_date"))).over(whole)
    rows = both.withColumns(
        {
            "_late": F.coalesce(first < opened, F.lit(False)),
            "_before": F.lag(F.when(is_new | is_open, F.col("hash_diff"))).over(line),
            "_at": F.row_number().over(line),
        }
    )
    kept = rows.filter(F.when(F.col("_late"), F.col("_at") == 1).otherwise(~is_new | _changed()))
    ended = F.when(is_new | is_open, F.lead("start_date").over(line)).otherwise(F.col("end_date"))
    merged = kept.withColumn("_end", ended).withColumn("end_date", F.col("_end"))
    merged = settle(merged.withColumn("is_current", F.col("_end").isNull()).select(*spec.columns, "_late"))
    done, late = merged.filter(~F.col("_late")).drop("_late"), merged.filter("_late").select(spec.key)
    rebuilt = versions(join_lookup(events, late, spec.key, "left_semi"), spec, collapse)
    return done.unionByName(rebuilt)


@dataclass(frozen=True)
class Merged:
    """A merged dimension, and per key the time from which it may differ from a rebuild."""

    dim: DataFrame
    disturbed: DataFrame


def merge_recent(
    dim: DataFrame,
    batch: DataFrame,
    events_since: Callable[[datetime], DataFrame],
    disturbed: DataFrame,
    spec: History,
) -> Merged:
    """`merge` with collapse, reading older events only where the outcome depends on them.

    `batch` must hold every valid event after some time, as the lookback filter gives it. What a
    rebuild would make of older events is then already in the dimension, so a late key is redone
    from its first batch event on, folded onto the version valid just before.

    `disturbed` (key, since) lists where that is not so: keys with events that came too late for
    the lookback, replaced copies, or events at the time of a version's start that were folded
    after it. A late key among them is redone from `since`, with events read from there. The
    returned list leaves those keys out and adds the batch's own ties.
    """
    touched = settle(touched_keys(batch, dim, spec))
    known = disturbed.groupBy(spec.key).agg(F.min("since").alias("_known"))
    reach = F.least(F.col("first_time"), F.col("_known"))
    keys = settle(
        join_lookup(touched, known, spec.key, "left").select(
            spec.key,
            "late",
            F.when(F.col("late"), reach).alias("since"),
            (F.col("late") & (reach < F.col("first_time"))).alias("far"),
        )
    )

    routed = join_lookup(dim, keys.drop("far"), spec.key, "left")
    late, since, end = F.col("late"), F.col("since"), F.col("end_date")
    before = F.coalesce(end < since, F.lit(False))
    covers = (F.col("start_date") < since) & (end.isNull() | (end >= since))
    passing = routed.filter(late.isNull() | (~late & ~F.col("is_current")) | (late & before))
    opened = routed.filter((~late & F.col("is_current")) | (late & covers)).drop("late", "since")

    near = keys.filter(~F.col("far")).select(spec.key)
    arrived = join_lookup(batch, near, spec.key, "left_semi")
    counts = batch
    far = keys.filter("far").select(spec.key, "since")
    earliest = far.agg(F.min("since")).first()[0]
    if earliest is not None:
        older = events_since(earliest).filter(F.col(spec.time) >= ntz(earliest))
        older = join_lookup(older, far, spec.key, "inner").filter(F.col(spec.time) >= F.col("since"))
        arrived = arrived.unionByName(older.select(*arrived.columns))
        counts = None
    folded = fold(opened, arrived, spec, counts_from=counts).drop("is_stored")

    redone = keys.filter("late").select(spec.key)
    open_issues = join_lookup(disturbed, redone, spec.key, "left_anti")
    ties = touched.filter("tied").select(spec.key, F.col("first_time").alias("since"))
    return Merged(passing.drop("late", "since").unionByName(folded), open_issues.unionByName(ties))
