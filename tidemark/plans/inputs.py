"""Inputs of the registered queries, derived from the given tables.

The tables have no bad rows, so NULL keys, missing attributes, late arrivals and second copies
are put in by rule; every row of the source table takes part.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.hashing import with_hash
from tidemark.functions.keys import version_key
from tidemark.functions.times import day_start, micros, ntz, stale_minutes
from tidemark.operators import history, quality, star, state
from tidemark.operators.dedup import latest_per_key
from tidemark.operators.skew import settle
from tidemark.sources.bucketed import bucketed_table

AS_OF = datetime(2024, 1, 29)
CDC_CUT = datetime(2024, 1, 25)
ORDER_CUT = datetime(2000, 1, 1)
SPEC = history.History(tracked=("city",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _plus(hours: int = 0, days: int = 0):
    return F.make_dt_interval(days=F.lit(days), hours=F.lit(hours))


def cdc_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer events with NULL customers, NULL attributes, late ones, and ids delivered twice."""
    delivered = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    events = table(spark, sf_dir, "events").withColumn("again", F.explode(delivered))
    every = lambda n: (F.col("again") == 0) & (F.col("event_id") % n == 0)
    customer = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    return events.select(
        "event_id",
        F.when(~every(97), customer).alias("customer_id"),
        F.col("event_type").alias("city"),
        F.when(~every(13), F.col("props")).alias("country"),
        F.when(F.col("again") == 1, F.col("ts") + _plus(hours=1))
        .when(every(41), F.col("ts") - _plus(days=10))
        .otherwise(F.col("ts"))
        .alias("event_time"),
        F.when(F.col("again") == 1, F.col("ts") + _plus(hours=1)).otherwise(F.col("ts")).alias("arrival_ts"),
    )


def cdc_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(cdc_bronze(spark, sf_dir), ["event_id"], ["event_time", "arrival_ts"])


def cdc_rules() -> list[quality.Rule]:
    return quality.standard_rules(ntz(AS_OF))


def cdc_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = cdc_silver(spark, sf_dir).filter(~quality.any_broken(cdc_rules()))
    return with_hash(passed, SPEC.tracked)


def cdc_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events as the table a run would find."""
    return settle(cdc_valid(spark, sf_dir))


def early(events: DataFrame) -> DataFrame:
    """What the first of two runs sees."""
    return events.filter(F.col("arrival_ts") < ntz(CDC_CUT))


def newest(events: DataFrame) -> datetime:
    return events.agg(F.max("event_time")).first()[0]


def second_run(valid: DataFrame) -> DataFrame:
    """Valid events after the mark of the first run less the lookback."""
    return state.since_mark(valid, ntz(newest(early(valid))))


def cdc_versions(spark: SparkSession, sf_dir: str, collapse: bool = True) -> DataFrame:
    """History of the valid events; rows per customer are counted on bronze, before the dedup."""
    bronze = cdc_bronze(spark, sf_dir)
    return history.versions(cdc_valid(spark, sf_dir), SPEC, collapse, counts_from=bronze)


def ord_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few customers with long histories, same-day ties and two kinds of late arrival."""
    orders = table(spark, sf_dir, "orders")
    late = (
        F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + _plus(days=5))
        .when(F.col("o_orderkey") % 41 == 0, F.col("o_orderdate") + _plus(days=20))
        .otherwise(F.col("o_orderdate"))
    )
    return orders.select(
        F.col("o_orderkey").alias("event_id"),
        (F.col("o_custkey") % 50).alias("customer_id"),
        F.col("o_orderpriority").alias("city"),
        F.col("o_orderdate").alias("event_time"),
        late.alias("arrival_ts"),
    )


def ord_batch1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ord_cdc(spark, sf_dir).filter(F.col("arrival_ts") < ntz(ORDER_CUT))


def ord_mark(spark: SparkSession, sf_dir: str) -> datetime:
    return newest(ord_batch1(spark, sf_dir))


def ord_batch2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.since_mark(ord_cdc(spark, sf_dir), ntz(ord_mark(spark, sf_dir)))


def ord_dim1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after the first batch, as the table a run would find."""
    return settle(history.versions(ord_batch1(spark, sf_dir), SPEC))


def ord_dim1_bucketed(spark: SparkSession, sf_dir: str, buckets: int) -> DataFrame:
    """The same dimension as a table bucketed by customer."""
    built = history.versions(ord_batch1(spark, sf_dir), SPEC)
    return bucketed_table(built, "customer_id", ["start_date"], buckets, "ord_dim")


def customer_versions(spark: SparkSession, sf_dir: str, known: Column | None = None) -> DataFrame:
    """One version per order of a customer, with its key; of the orders that are `known`, if that is given."""
    spec = history.History(
        tracked=("o_orderpriority",), key="customer_id", time="o_orderdate", event_id="o_orderkey"
    )
    orders = table(spark, sf_dir, "orders")
    orders = (orders if known is None else orders.filter(known)).withColumnRenamed("o_custkey", "customer_id")
    built = history.versions(orders, spec, collapse=False)
    return built.withColumn("customer_sk", version_key("customer_id"))


def sales_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their customer; the order time is the ship date."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("order_date"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def product_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def sold_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product dimension that lacks some of the products sold."""
    return star.product_rows(product_feed(spark, sf_dir).filter(F.col("product_id") % 10 != 3))


def sales_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A calendar that lacks some of the dates of sale."""
    lines = table(spark, sf_dir, "lineitem").filter(F.dayofmonth("l_shipdate") != 13)
    return star.date_rows(star.order_dates(lines, "l_shipdate"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run metrics: one run per pipeline and day."""
    bad = F.count_if(F.col("event_id") % 97 == 0)
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("pipeline_name"), day_start(F.col("ts")).alias("run_timestamp"))
        .agg(
            F.count(F.lit(1)).alias("records_processed"),
            bad.alias("records_failed"),
            (F.count(F.lit(1)) - bad).alias("records_loaded"),
        )
    )


def sla_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness checks: each user's newest event of a day against the next midnight."""
    pipeline = F.concat(F.lit("C"), F.col("user_id").cast("string"))
    latest = (
        table(spark, sf_dir, "events")
        .groupBy(pipeline.alias("pipeline_name"), day_start(F.col("ts")).alias("day"))
        .agg(F.max("ts").alias("latest_event_time"))
    )
    checked = latest.select(
        "pipeline_name", (F.col("day") + _plus(days=1)).alias("check_time"), "latest_event_time"
    )
    minutes = stale_minutes(F.col("latest_event_time"), F.col("check_time"))
    return checked.withColumn("freshness_minutes", minutes).withColumn(
        "status", state.sla_status(F.col("freshness_minutes"))
    )


def run_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of daily runs with their customer and how long they waited for the next midnight."""
    events = table(spark, sf_dir, "events")
    return events.select(
        day_start(F.col("ts")).alias("run_day"),
        F.col("user_id").cast("string").alias("customer"),
        F.floor((micros(day_start(F.col("ts")) + _plus(days=1)) - micros(F.col("ts"))) / 1_000_000).alias("delay_seconds"),
    )
