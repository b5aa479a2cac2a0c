"""Dashboard queries over run metrics, SLA checks and dead letters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import day_start
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.quality import REASON

HLL_BITS = 12
PROCESSED, FAILED, LOADED = "records_processed", "records_failed", "records_loaded"


def throughput(metrics: DataFrame) -> DataFrame:
    """Records per day over all runs."""
    return metrics.groupBy(day_start(F.col("run_timestamp")).alias("run_day")).agg(
        F.count(F.lit(1)).alias("runs"), *[F.sum(name).alias(name) for name in (PROCESSED, FAILED, LOADED)]
    )


def sla_latest(checks: DataFrame) -> DataFrame:
    """Newest check of each pipeline."""
    return latest_per_key(checks, ["pipeline_name"], ["check_time"])


def sla_breaches(checks: DataFrame) -> DataFrame:
    breached = checks.filter(F.col("status") == "SLA_BREACH")
    return breached.groupBy("pipeline_name").agg(
        F.count(F.lit(1)).alias("breaches"), F.max("freshness_minutes").alias("worst_minutes")
    )


def breach_episodes(checks: DataFrame) -> DataFrame:
    """Runs of consecutive breaches of a pipeline, in the order of its checks.

    A breach opens an episode if the check before it was none, and the episodes are numbered by a running
    sum; both windows share one shuffle and one sort. `is_open`: the pipeline's last check is in it.
    """
    line = Window.partitionBy("pipeline_name").orderBy("check_time", "status")
    breach = F.col("status") == "SLA_BREACH"
    rows = checks.withColumns(
        {
            "opens": (breach & ~F.coalesce(F.lag("status").over(line) == "SLA_BREACH", F.lit(False))).cast("int"),
            "is_last": F.lead("status").over(line).isNull(),
        }
    )
    running = line.rowsBetween(Window.unboundedPreceding, 0)
    episodes = rows.withColumn("episode", F.sum("opens").over(running)).filter(breach)
    return episodes.groupBy("pipeline_name", "episode").agg(
        F.min("check_time").alias("first_breach"),
        F.max("check_time").alias("last_breach"),
        F.count(F.lit(1)).alias("checks"),
        F.max("freshness_minutes").alias("longest_minutes"),
        F.max("is_last").alias("is_open"),
    )


def run_sketches(rows: DataFrame, run: str, customer: str, delay: str) -> DataFrame:
    """For each run a sketch of its customers and one of its delays: two small values however many rows it had.

    Standard errors: 1.04 / sqrt(2**HLL_BITS) of the number of customers (1.6 %), about 1 % of a rank.
    """
    return rows.groupBy(run).agg(
        F.count(F.lit(1)).alias("rows"),
        F.hll_sketch_agg(customer, HLL_BITS).alias("customers"),
        F.kll_sketch_agg_bigint(F.col(delay).cast("long")).alias("delays"),
    )


def merged_sketches(sketches: DataFrame, period: Column, shares: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Customers and delay quantiles of each period from the sketches of its runs; the rows are not read again."""
    merged = sketches.groupBy(period.alias("period")).agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("customers"),
        F.kll_merge_agg_bigint("delays").alias("_delays"),
    )
    quantiles = [F.kll_sketch_get_quantile_bigint("_delays", F.lit(q)).alias(f"delay_p{round(100 * q)}") for q in shares]
    return merged.select("period", "rows", "customers", *quantiles)


def failures_by_reason_and_day(dead: DataFrame, time: str = "event_time") -> DataFrame:
    """Failures by reason and day, by either and in all, from one pass; `level` tells which (0: both, 3: all)."""
    day = day_start(F.col(time)).alias("failed_day")
    return dead.select(REASON, day).cube(REASON, "failed_day").agg(
        F.count(F.lit(1)).alias("failures"), F.grouping_id().alias("level")
    )


def errors_by_reason(dead: DataFrame) -> DataFrame:
    return dead.groupBy(REASON).agg(F.count(F.lit(1)).alias("failures"))


def recent_failures(dead: DataFrame, n: int, newest: str = "event_time", tiebreak: Sequence[str] = ("event_id", REASON)) -> DataFrame:
    """The n newest dead letters; Spark keeps n rows per task, it does not sort them all."""
    order = [F.col(newest).desc_nulls_last(), *[F.col(name).asc_nulls_last() for name in tiebreak]]
    return dead.orderBy(*order).limit(n)


def reliability(metrics: DataFrame) -> DataFrame:
    """Failed and processed records per pipeline and day with running totals.

    Aggregated before the window, so a pipeline has one row per day in it.
    """
    daily = metrics.groupBy("pipeline_name", day_start(F.col("run_timestamp")).alias("run_day")).agg(
        F.sum(PROCESSED).alias(PROCESSED), F.sum(FAILED).alias(FAILED)
    )
    so_far = Window.partitionBy("pipeline_name").orderBy("run_day").rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumns(
        {
            "failure_rate": F.try_divide(F.col(FAILED).cast("double"), F.col(PROCESSED).cast("double")),
            "processed_so_far": F.sum(PROCESSED).over(so_far),
            "failed_so_far": F.sum(FAILED).over(so_far),
        }
    )
