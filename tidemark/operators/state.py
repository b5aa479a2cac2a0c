"""High-water marks, run metrics and the freshness check."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import FIRST_MARK, LOOKBACK_DAYS, days_before, ntz, stale_minutes

PIPELINE = "customer_pipeline"
SLA_MINUTES = 120


def mark_of(marks: DataFrame, pipeline: str = PIPELINE) -> DataFrame:
    """One row: the stored high-water mark, or the initial one for a pipeline that has none."""
    stored = marks.filter(F.col("pipeline_name") == pipeline).agg(F.max("last_processed_ts").alias("stored"))
    return stored.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.coalesce("stored", ntz(FIRST_MARK)).alias("last_processed_ts"),
    )


def read_mark(marks: DataFrame, pipeline: str = PIPELINE) -> datetime:
    return mark_of(marks, pipeline).first()["last_processed_ts"]


def since_mark(events: DataFrame, mark: Column, time: str = "event_time", days: int = LOOKBACK_DAYS) -> DataFrame:
    """Events after the mark less the lookback; the border itself is out, and so are NULL times."""
    return events.filter(F.col(time) > days_before(mark, days))


def too_late(events: DataFrame, mark: Column, time: str = "event_time", days: int = LOOKBACK_DAYS) -> DataFrame:
    """Events that the lookback leaves out."""
    return events.filter(F.col(time) <= days_before(mark, days))


def advanced_marks(marks: DataFrame, processed: DataFrame, pipeline: str = PIPELINE, time: str = "event_time") -> DataFrame:
    """All marks, with that of `pipeline` moved to the newest processed time, never back."""
    newest = processed.agg(F.max(time).alias("last_processed_ts")).withColumn("pipeline_name", F.lit(pipeline))
    return (
        marks.unionByName(newest)
        .groupBy("pipeline_name")
        .agg(F.max("last_processed_ts").alias("last_processed_ts"))
    )


def run_metrics(flagged: DataFrame, too_late_rows: DataFrame, as_of: datetime, pipeline: str = PIPELINE) -> DataFrame:
    """One row; `records_failed` counts violations, so a row that breaks two rules counts twice."""
    counted = flagged.agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.coalesce(F.sum(F.size("reasons")), F.lit(0)).alias("records_failed"),
        F.count_if(~F.col("rejected")).alias("records_loaded"),
    )
    missed = too_late_rows.agg(F.count(F.lit(1)).alias("records_too_late"))
    counts = counted.unionByName(missed, allowMissingColumns=True)
    names = ("records_processed", "records_failed", "records_loaded", "records_too_late")
    return counts.agg(*[F.sum(name).alias(name) for name in names]).select(
        F.lit(pipeline).alias("pipeline_name"), ntz(as_of).alias("run_timestamp"), *names
    )


def counting_run(flagged: DataFrame) -> tuple[DataFrame, Observation]:
    """A flagged frame that is counted by the write that goes straight over it, and where the counts will be.

    Each task of that write counts once, so the frame must not be shuffled between here and there.
    """
    counts = Observation()
    return flagged.observe(
        counts,
        F.count(F.lit(1)).alias("records_processed"),
        F.coalesce(F.sum(F.size("reasons")), F.lit(0)).alias("records_failed"),
        F.count_if(~F.col("rejected")).alias("records_loaded"),
    ), counts


def counting_late(
    arrived: DataFrame, mark: Column, time: str = "event_time", days: int = LOOKBACK_DAYS
) -> tuple[DataFrame, Observation]:
    """Arrived events that count what the lookback leaves out while they are written."""
    missed = Observation()
    late = F.coalesce(F.col(time) <= days_before(mark, days), F.lit(False))
    return arrived.observe(missed, F.count_if(late).alias("records_too_late")), missed


def observed_metrics(
    spark: SparkSession, counts: Observation, missed: Observation, as_of: datetime, pipeline: str = PIPELINE
) -> DataFrame:
    """The row of `run_metrics` from writes that are done; reads nothing again."""
    found = counts.get | missed.get
    names = ("records_processed", "records_failed", "records_loaded", "records_too_late")
    kinds = ", ".join(f"{name} long" for name in names)
    values = spark.createDataFrame([tuple(found[name] for name in names)], kinds)
    return values.select(F.lit(pipeline).alias("pipeline_name"), ntz(as_of).alias("run_timestamp"), *names)


def freshness(dim: DataFrame, as_of: datetime, pipeline: str = PIPELINE, threshold: int = SLA_MINUTES) -> DataFrame:
    """One row: age of the newest version start against the SLA; NO_DATA for an empty table."""
    latest = F.col("latest_event_time")
    minutes = F.col("freshness_minutes")
    return dim.agg(F.max("start_date").alias("latest_event_time")).select(
        F.lit(pipeline).alias("pipeline_name"),
        ntz(as_of).alias("check_time"),
        "latest_event_time",
        stale_minutes(latest, ntz(as_of)).alias("freshness_minutes"),
        F.lit(threshold).alias("sla_threshold_minutes"),
    ).withColumn("status", sla_status(minutes, threshold))


def sla_status(minutes: Column, threshold: int = SLA_MINUTES) -> Column:
    return (
        F.when(minutes.isNull(), "NO_DATA").when(minutes > threshold, "SLA_BREACH").otherwise("OK")
    )
