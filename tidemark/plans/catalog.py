"""The registered queries: each takes (session, table folder) and returns a frame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.hashing import with_hash
from tidemark.functions.keys import version_key, with_dense_key
from tidemark.functions.times import ntz
from tidemark.operators import history, integrity, monitoring, quality, star, state
from tidemark.operators.dedup import latest_per_key, latest_per_key_by_max
from tidemark.operators.skew import join_lookup, settle
from tidemark.operators.temporal import join_as_of
from tidemark.plans import inputs as given
from tidemark.plans import medallion
from tidemark.plans.inputs import AS_OF, CDC_CUT, ORDER_CUT, SPEC
from tidemark.session import work_folder
from tidemark.sources import files
from tidemark.sources.warehouse import PART, State, Warehouse
from tidemark.streaming.feed import stream_feed
from tidemark.streaming.latest import read_latest, stream_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENT = ["event_id", "customer_id", "city", "country", "event_time", "arrival_ts"]
CHANGE = ["event_id", "customer_id", "city", "event_time", "arrival_ts"]
VERSION = SPEC.columns
FEED = schemas.table(
    event_id="long", customer_id="string", city="string", country="string",
    event_time="timestamp_ntz", arrival_ts="timestamp_ntz",
)
HASHED_FEED = schemas.table(
    event_id="string", customer_id="string", city="string", country="string",
    event_time="timestamp_ntz", arrival_ts="timestamp_ntz",
)
CDC_FIRST = datetime(2024, 1, 10)
LAYOUT = medallion.Layout(feed=FEED, spec=SPEC, buckets=8, id_buckets=8)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


# --- sources and sinks ---


@query
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    orders = given.table(spark, sf, "orders")
    folder = files.write_csv(orders, work_folder(spark, "orders-csv"))
    return files.read_csv_feed(spark, folder, orders.schema)


@query
def scan_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """Columns in another order than declared, one of them missing."""
    orders = given.table(spark, sf, "orders")
    turned = orders.select(*reversed([name for name in orders.columns if name != "o_orderpriority"]))
    folder = files.write_csv(turned, work_folder(spark, "orders-turned"))
    return files.read_csv_feed(spark, folder, orders.schema)


@query
def dq_unparsed(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of a feed with ids and times that do not parse."""
    events = given.table(spark, sf, "events").select("event_id", F.col("event_type").alias("city"), F.col("ts").alias("event_time"))
    text = events.select(
        F.when(F.col("event_id") % 31 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("event_id"),
        "city",
        F.when(F.col("event_id") % 37 == 0, "soon").otherwise(F.col("event_time").cast("string")).alias("event_time"),
    )
    folder = files.write_csv(text, work_folder(spark, "events-bad"))
    feed = files.read_csv_feed(spark, folder, events.schema, keep_corrupt=True)
    rules = [quality.untimed_rule(), quality.Rule("UNPARSED", F.col(files.CORRUPT).isNotNull())]
    flagged = quality.flag(feed, rules, unique_ids=True)
    return quality.dead_letters(flagged).withColumnRenamed(files.CORRUPT, "line")


@query
def bronze_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, the second one delivered twice."""
    bronze = given.cdc_bronze(spark, sf)
    early = F.col("arrival_ts") < ntz(CDC_CUT)
    path = work_folder(spark, "bronze")
    for batch, rows in (("b1", bronze.filter(early)), ("b2", bronze.filter(~early)), ("b2", bronze.filter(~early))):
        files.append_run(rows.withColumn("batch_id", F.lit(batch)), path, "batch_id")
    return spark.read.parquet(path).select(*EVENT, "batch_id")


@query
def silver_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """Silver recomputed from all of bronze through the warehouse, twice."""
    wh = Warehouse(spark, work_folder(spark, "silver"))
    wh.append(given.cdc_bronze(spark, sf), medallion.BRONZE, "r1")
    now = State()
    for run in ("r1", "r2"):
        now = wh.publish(medallion.overwrite_silver(wh, now, LAYOUT, run), run)
    return wh.read(wh.state(), medallion.SILVER, LAYOUT.events).select(*EVENT)


@query
def silver_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Silver kept by three deliveries; ids are hashed text, so that only the id index finds earlier copies."""
    bronze = given.cdc_bronze(spark, sf).withColumn("event_id", F.md5(F.col("event_id").cast("string")))
    layout = replace(LAYOUT, feed=HASHED_FEED, id_buckets=8)
    wh = Warehouse(spark, work_folder(spark, "silver-ids"))
    arrival, now = F.col("arrival_ts"), State()
    deliveries = arrival < ntz(CDC_FIRST), (arrival >= ntz(CDC_FIRST)) & (arrival < ntz(CDC_CUT)), arrival >= ntz(CDC_CUT)
    for n, delivered in enumerate(deliveries):
        now = wh.publish(medallion.refresh_silver(wh, now, bronze.filter(delivered), layout, f"r{n}"), f"r{n}")
    return wh.read(wh.state(), medallion.SILVER, layout.events).select(*EVENT)


@query
def dlq_append(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of one run, written twice under the same run."""
    dead = quality.dead_letters(quality.flag(given.cdc_bronze(spark, sf), given.cdc_rules()))
    wh = Warehouse(spark, work_folder(spark, "dlq"))
    dead = wh.stage(dead.withColumn("failed_at", ntz(AS_OF)), "dead", "r1")
    for _ in range(2):
        wh.append(dead, medallion.DEAD, "r1")
    return wh.log(medallion.DEAD, dead.schema).select(*EVENT, quality.REASON, "failed_at", "run_id")


@query
def dim_product_load(spark: SparkSession, sf: str) -> DataFrame:
    """Small parts first, then the whole feed: only unseen products are added."""
    feed = given.product_feed(spark, sf)
    path = work_folder(spark, "products")
    small = given.table(spark, sf, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("product_id"))
    first = star.product_rows(feed.join(small, "product_id", "left_semi"))
    files.append_run(first.withColumn("load", F.lit("r1")), path, "load")
    fresh = star.unseen(star.product_rows(feed), spark.read.parquet(path), "product_id")
    files.append_run(fresh.withColumn("load", F.lit("r2")), path, "load")
    return spark.read.parquet(path).drop("load")


def _dates_as_text(dates: DataFrame) -> DataFrame:
    return dates.withColumn("full_date", F.col("full_date").cast("string"))


@query
def dim_date_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of earlier orders are stored; loading all orders adds the rest once."""
    orders = given.table(spark, sf, "orders")
    path = work_folder(spark, "dates")
    for load, feed in (("r1", orders.filter(F.col("o_orderdate") < ntz(ORDER_CUT))), ("r2", orders), ("r3", orders)):
        rows = star.date_rows(star.order_dates(feed, "o_orderdate"))
        if load != "r1":
            rows = star.unseen(rows, spark.read.parquet(path), "full_date")
        files.append_run(rows.withColumn("load", F.lit(load)), path, "load")
    return _dates_as_text(spark.read.parquet(path).drop("load"))


@query
def select_to_schema(spark: SparkSession, sf: str) -> DataFrame:
    keyed = given.cdc_versions(spark, sf).withColumn("customer_sk", version_key("customer_id"))
    return schemas.select_to_schema(keyed, LAYOUT.dimension, {"created_at": ntz(AS_OF)})


# --- deduplication ---


@query
def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    return given.cdc_silver(spark, sf)


@query
def dedup_latest_maxby(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key_by_max(given.cdc_bronze(spark, sf), ["event_id"], ["event_time", "arrival_ts"])


@query
def dedup_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return latest_per_key(given.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def having_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.repeated_ids(given.cdc_bronze(spark, sf))


# --- data quality ---


@query
def dq_null_key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.broken_rows(given.cdc_bronze(spark, sf), given.cdc_rules()[0])


@query
def dq_future_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return quality.broken_rows(given.cdc_bronze(spark, sf), given.cdc_rules()[1])


@query
def dq_duplicate_event(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_rows(given.cdc_bronze(spark, sf))


@query
def dq_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.violations(given.cdc_bronze(spark, sf), given.cdc_rules())


@query
def dq_single_pass(spark: SparkSession, sf: str) -> DataFrame:
    return quality.dead_letters(quality.flag(given.cdc_bronze(spark, sf), given.cdc_rules()))


@query
def dq_valid_events(spark: SparkSession, sf: str) -> DataFrame:
    return quality.valid_rows(quality.flag(given.cdc_bronze(spark, sf), given.cdc_rules()))


@query
def dlq_new_only(spark: SparkSession, sf: str) -> DataFrame:
    """Dead letters of all rows that an earlier run over the early rows has not stored."""
    bronze = given.cdc_bronze(spark, sf)
    early = bronze.filter(F.col("arrival_ts") < ntz(CDC_CUT))
    stored, found = (
        quality.dead_letters(quality.flag(rows, given.cdc_rules())) for rows in (early, bronze)
    )
    return quality.unseen_dead_letters(found, stored)


@query
def dlq_replay(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same window store each failure once."""
    wh = Warehouse(spark, work_folder(spark, "dlq-replay"))
    for run in ("r1", "r2"):
        medallion.run_batch(wh, given.cdc_bronze(spark, sf), AS_OF, run, LAYOUT)
    kind = LAYOUT.events.add(quality.REASON, "string")
    return wh.log(medallion.DEAD, kind).select(*EVENT, quality.REASON, "run_id")


# --- change detection and history ---


@query
def hash_diff(spark: SparkSession, sf: str) -> DataFrame:
    return with_hash(given.cdc_silver(spark, sf), ["city", "country"]).select("event_id", "hash_diff")


@query
def hash_diff_nullsafe(spark: SparkSession, sf: str) -> DataFrame:
    hashed = with_hash(given.cdc_silver(spark, sf), ["city", "country"], null_safe=True)
    return hashed.select("event_id", "hash_diff")


@query
def scd2_full(spark: SparkSession, sf: str) -> DataFrame:
    return given.cdc_versions(spark, sf)


@query
def timeline_collapsed(spark: SparkSession, sf: str) -> DataFrame:
    return history.versions(given.ord_cdc(spark, sf), SPEC)


@query
def timeline_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    return given.cdc_versions(spark, sf, collapse=False)


@query
def timeline_rebuild_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Versions of all silver events with a customer and a time, events of the future too."""
    silver = given.cdc_silver(spark, sf).filter("customer_id IS NOT NULL AND event_time IS NOT NULL")
    return history.versions(with_hash(silver, SPEC.tracked), SPEC, collapse=False)


@query
def scd2_initial(spark: SparkSession, sf: str) -> DataFrame:
    """First run: every customer is new."""
    batch = settle(given.cdc_valid(spark, sf))
    none = spark.createDataFrame([], LAYOUT.dimension).select(*VERSION)
    return history.merge(none, batch, batch, SPEC)


@query
def scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    dim = given.ord_dim1_bucketed(spark, sf, LAYOUT.buckets)
    return history.merge_bucketed(dim, given.ord_batch2(spark, sf), given.ord_cdc(spark, sf), SPEC, LAYOUT.buckets)


@query
def scd2_incremental_per_event(spark: SparkSession, sf: str) -> DataFrame:
    """Rebuilt customers keep one version per event."""
    dim = given.ord_dim1_bucketed(spark, sf, LAYOUT.buckets)
    events = given.ord_cdc(spark, sf)
    return history.merge_bucketed(dim, given.ord_batch2(spark, sf), events, SPEC, LAYOUT.buckets, collapse=False)


@query
def scd2_noop_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The second batch merged twice."""
    events = given.ord_cdc(spark, sf)
    batch = given.ord_batch2(spark, sf)
    seen = (F.col("arrival_ts") < ntz(ORDER_CUT)) | (
        F.col("event_time") > ntz(given.ord_mark(spark, sf)) - F.make_dt_interval(days=F.lit(7))
    )
    silver = events.filter(seen)
    wh = Warehouse(spark, work_folder(spark, "replay"))
    once = wh.stage(history.merge(given.ord_dim1(spark, sf), batch, silver, SPEC), "once", "r1")
    return history.merge(once, batch, silver, SPEC)


@query
def scd2_expired_rows(spark: SparkSession, sf: str) -> DataFrame:
    return history.expired_versions(given.ord_dim1(spark, sf), given.ord_batch2(spark, sf), SPEC)


@query
def scd2_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    return history.new_versions(given.ord_dim1(spark, sf), given.ord_batch2(spark, sf), SPEC)


@query
def current_version_lookup(spark: SparkSession, sf: str) -> DataFrame:
    found = history.with_current_start(given.ord_batch2(spark, sf), given.ord_dim1(spark, sf), SPEC)
    return found.select(*CHANGE, "current_start")


@query
def late_event_detect(spark: SparkSession, sf: str) -> DataFrame:
    late = history.late_events(given.ord_batch2(spark, sf), given.ord_dim1(spark, sf), SPEC)
    return late.select(*CHANGE, "current_start")


def _year_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A lookback of a year: most of what it re-reads lies before the current version of its customer."""
    return state.since_mark(given.ord_cdc(spark, sf), ntz(given.ord_mark(spark, sf)), days=365)


@query
def late_event_detect_year(spark: SparkSession, sf: str) -> DataFrame:
    late = history.late_events(_year_batch(spark, sf), given.ord_dim1(spark, sf), SPEC)
    return late.select(*CHANGE, "current_start")


@query
def scd2_incremental_year(spark: SparkSession, sf: str) -> DataFrame:
    """Nearly every customer is late, so each history is redone."""
    return history.merge(given.ord_dim1(spark, sf), _year_batch(spark, sf), given.ord_cdc(spark, sf), SPEC)


def _late_keys(spark: SparkSession, sf: str) -> DataFrame:
    keys = history.touched_keys(given.ord_batch2(spark, sf), given.ord_dim1(spark, sf), SPEC)
    return settle(keys.filter("late").select("customer_id"))


@query
def late_customer_events(spark: SparkSession, sf: str) -> DataFrame:
    events = given.ord_cdc(spark, sf)
    late = join_lookup(events, _late_keys(spark, sf), "customer_id", "left_semi")
    return late.select(*CHANGE)


@query
def delete_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return history.without_keys(given.ord_dim1(spark, sf), _late_keys(spark, sf), SPEC)


@query
def insert_if_changed(spark: SparkSession, sf: str) -> DataFrame:
    changed = history.changed_events(given.ord_batch2(spark, sf), given.ord_dim1(spark, sf), SPEC)
    return changed.select(*CHANGE, "hash_diff")


@query
def current_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return history.current(given.cdc_versions(spark, sf))


@query
def snapshot_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return history.as_of(given.cdc_versions(spark, sf), F.expr("timestamp_ntz'2024-01-15 00:00:00'"))


@query
def versions_per_day(spark: SparkSession, sf: str) -> DataFrame:
    counts = history.valid_per_day(given.customer_versions(spark, sf))
    return counts.select(F.col("day").cast("string").alias("day"), "versions")


@query
def surrogate_key_durable(spark: SparkSession, sf: str) -> DataFrame:
    dim = given.cdc_versions(spark, sf)
    return dim.select(version_key("customer_id").alias("customer_sk"), *VERSION)


@query
def surrogate_key_dense(spark: SparkSession, sf: str) -> DataFrame:
    dim = given.cdc_versions(spark, sf)
    return with_dense_key(dim, ["customer_id", "start_date", "source_event_id"], "customer_sk")


# --- star schema ---


def _sales_as_of(spark: SparkSession, sf: str, how: str) -> DataFrame:
    """Versions of a built history, which are contiguous."""
    return join_as_of(
        given.sales_orders(spark, sf),
        given.customer_versions(spark, sf),
        "customer_id",
        "order_date",
        ["customer_sk", "o_orderpriority"],
        how,
        contiguous=True,
    )


@query
def temporal_customer_join(spark: SparkSession, sf: str) -> DataFrame:
    return _sales_as_of(spark, sf, "auto")


@query
def temporal_join_window(spark: SparkSession, sf: str) -> DataFrame:
    return _sales_as_of(spark, sf, "running")


def _overlapping(spark: SparkSession, sf: str) -> DataFrame:
    """Prices of a part that hold 40 days each from orders of any day: windows overlap, starts repeat."""
    lines = given.table(spark, sf, "lineitem")
    begin = F.date_trunc("month", "l_shipdate").cast("timestamp_ntz")
    return lines.groupBy((F.col("l_partkey") % 500).alias("product_id"), begin.alias("start_date"), "l_linenumber").agg(
        F.when(F.col("l_linenumber") < 6, begin + F.make_dt_interval(days=F.lit(12) * F.col("l_linenumber"))).alias("end_date"),
        F.max("l_extendedprice").alias("price"),
    )


@query
def temporal_join_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Every version valid at a time, where several are."""
    orders = given.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") % 520).alias("product_id"), F.col("o_orderdate").alias("order_date")
    )
    recent = settle(_overlapping(spark, sf))
    return join_as_of(orders, recent, "product_id", "order_date", ["l_linenumber", "price"], "buckets")


@query
def chk_sales_key_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Facts of a grain that repeats: orders without their line number."""
    facts = star.with_fact_key(fact_sales(spark, sf).drop("l_linenumber"))
    return integrity.repeated(facts, ["sales_sk"])


@query
def product_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = star.with_product(given.sales_orders(spark, sf), given.sold_products(spark, sf))
    return joined.select("order_id", "l_linenumber", "product_id", "product_sk", "quantity")


@query
def date_join(spark: SparkSession, sf: str) -> DataFrame:
    joined = star.with_date(given.sales_orders(spark, sf), given.sales_dates(spark, sf))
    return joined.select("order_id", "l_linenumber", "order_date", "date_sk", "quantity")


@query
def distinct_dates(spark: SparkSession, sf: str) -> DataFrame:
    return _dates_as_text(star.order_dates(given.table(spark, sf, "orders"), "o_orderdate"))


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    orders = given.table(spark, sf, "orders")
    return _dates_as_text(star.date_rows(star.order_dates(orders, "o_orderdate")))


@query
def fact_sales(spark: SparkSession, sf: str) -> DataFrame:
    return star.sales_facts(
        given.sales_orders(spark, sf),
        given.customer_versions(spark, sf),
        given.sold_products(spark, sf),
        given.sales_dates(spark, sf),
        ("order_id", "l_linenumber"),
    )


@query
def fact_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return star.unmatched_facts(fact_sales(spark, sf))


SALES_LAYOUT = medallion.Layout(
    feed=schemas.table(o_orderkey="long", customer_id="long", o_orderpriority="string", o_orderdate="timestamp_ntz"),
    spec=history.History(tracked=("o_orderpriority",), time="o_orderdate", event_id="o_orderkey"),
    buckets=8,
)
LATE_MONTHS = datetime(1995, 3, 1), datetime(1995, 5, 1)


def _publish_customers(wh: Warehouse, versions: DataFrame, run: str) -> None:
    dim = schemas.select_to_schema(versions, SALES_LAYOUT.dimension)
    now = wh.state()
    written = wh.write_parts(dim.withColumn(PART, SALES_LAYOUT.bucket()), medallion.CUSTOMERS, run)
    wh.publish(now.replaced(medallion.CUSTOMERS, now.parts(medallion.CUSTOMERS), written, run), run)


def _star_feeds(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sales = given.sales_orders(spark, sf)
    line = F.concat_ws("-", "order_id", "l_linenumber").alias("order_id")
    orders = sales.select(line, "customer_id", "product_id", "order_date", "quantity", "total_amount")
    # A feed is a table: lines and orders are joined once for all its readers.
    orders = settle(orders, "zstd")
    return orders, given.product_feed(spark, sf).filter(F.col("product_id") % 10 != 3)


def _stored_facts(wh: Warehouse) -> DataFrame:
    facts = wh.read(wh.state(), medallion.FACTS, schemas.FACT_SALES)
    return facts.select(
        "order_id", "customer_sk", "product_sk", "date_sk", "quantity",
        F.col("total_amount").cast("double").alias("total_amount"),
    )


@query
def fact_rebuild_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """Products, dates and facts loaded twice into a warehouse that holds the customer history."""
    wh = Warehouse(spark, work_folder(spark, "star"))
    _publish_customers(wh, given.customer_versions(spark, sf), "r0")
    orders, products = _star_feeds(spark, sf)
    for run in ("r1", "r2"):
        medallion.load_star(wh, orders, products, AS_OF, run, SALES_LAYOUT)
    return _stored_facts(wh)


@query
def fact_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Facts made without some customers' events of two months, then refreshed when these come in late."""
    wh = Warehouse(spark, work_folder(spark, "star-late"))
    first, last = LATE_MONTHS
    late = (F.col("o_custkey") % 20 == 0) & F.col("o_orderdate").between(ntz(first), ntz(last))
    _publish_customers(wh, given.customer_versions(spark, sf, ~late), "r0")
    orders, products = _star_feeds(spark, sf)
    medallion.load_star(wh, orders, products, AS_OF, "r1", SALES_LAYOUT)
    _publish_customers(wh, given.customer_versions(spark, sf), "r2")
    medallion.refresh_facts(wh, orders, AS_OF, "r3", SALES_LAYOUT)
    return _stored_facts(wh)


# --- state, metrics, whole runs ---


def _marks(spark: SparkSession, sf: str) -> DataFrame:
    """Marks of one pipeline per event type."""
    events = given.table(spark, sf, "events")
    return events.groupBy(F.col("event_type").alias("pipeline_name")).agg(F.max("ts").alias("last_processed_ts"))


@query
def watermark_read(spark: SparkSession, sf: str) -> DataFrame:
    """A stored mark, and the initial one of a pipeline that never ran."""
    marks = _marks(spark, sf)
    return state.mark_of(marks, "click").unionByName(state.mark_of(marks, state.PIPELINE))


@query
def watermark_advance(spark: SparkSession, sf: str) -> DataFrame:
    valid = given.cdc_stored(spark, sf)
    before = state.advanced_marks(_marks(spark, sf), given.early(valid))
    return state.advanced_marks(before, given.second_run(valid))


@query
def watermark_advance_all(spark: SparkSession, sf: str) -> DataFrame:
    """The mark over all rows after the lookback border, rejected ones too."""
    silver = settle(given.cdc_silver(spark, sf))
    border = ntz(given.newest(given.early(given.cdc_stored(spark, sf))))
    return state.advanced_marks(_marks(spark, sf), state.since_mark(silver, border))


@query
def incremental_lookback(spark: SparkSession, sf: str) -> DataFrame:
    return given.second_run(given.cdc_stored(spark, sf)).select(*EVENT)


@query
def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Second run: rows after the lookback border, their violations, and what came too late."""
    silver = settle(given.cdc_silver(spark, sf))
    valid = silver.filter(~quality.any_broken(given.cdc_rules()))
    mark = ntz(given.newest(given.early(valid)))
    flagged = quality.flag(state.since_mark(silver, mark), given.cdc_rules(), unique_ids=True)
    missed = state.too_late(silver.filter(F.col("arrival_ts") >= ntz(CDC_CUT)), mark)
    return state.run_metrics(flagged, missed, AS_OF)


@query
def run_metrics_observed(spark: SparkSession, sf: str) -> DataFrame:
    """The same row, observed while the flagged rows and the arrived ones are written."""
    silver = settle(given.cdc_silver(spark, sf))
    valid = silver.filter(~quality.any_broken(given.cdc_rules()))
    mark = ntz(given.newest(given.early(valid)))
    flagged = quality.flag(state.since_mark(silver, mark), given.cdc_rules(), unique_ids=True)
    flagged, counts = state.counting_run(flagged)
    arrived, missed = state.counting_late(silver.filter(F.col("arrival_ts") >= ntz(CDC_CUT)), mark)
    for written in (flagged, arrived):
        settle(written)
    return state.observed_metrics(spark, counts, missed, AS_OF)


@query
def freshness_sla(spark: SparkSession, sf: str) -> DataFrame:
    return state.freshness(given.cdc_versions(spark, sf), AS_OF)


def _two_deliveries(bronze: DataFrame) -> list[tuple[DataFrame, object]]:
    early = F.col("arrival_ts") < ntz(CDC_CUT)
    return [(bronze.filter(early), CDC_CUT), (bronze.filter(~early), AS_OF)]


def _dimension(wh: Warehouse) -> DataFrame:
    return wh.read(wh.state(), medallion.CUSTOMERS, LAYOUT.dimension).select("customer_sk", *VERSION)


@query
def medallion_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Feed to customer dimension in two runs."""
    wh = Warehouse(spark, work_folder(spark, "medallion"))
    for n, (rows, as_of) in enumerate(_two_deliveries(given.cdc_bronze(spark, sf))):
        medallion.run_batch(wh, rows, as_of, f"r{n}", LAYOUT)
    return _dimension(wh)


@query
def scd2_rebucket(spark: SparkSession, sf: str) -> DataFrame:
    """The second run has the dimension in other buckets than the first."""
    wh = Warehouse(spark, work_folder(spark, "rebucket"))
    for n, (rows, as_of) in enumerate(_two_deliveries(given.cdc_bronze(spark, sf))):
        medallion.run_batch(wh, rows, as_of, f"r{n}", replace(LAYOUT, buckets=4 + n))
    return _dimension(wh)


@query
def stream_available_now(spark: SparkSession, sf: str) -> DataFrame:
    """The same feed as files, each delivery picked up by the stream."""
    folder = work_folder(spark, "stream")
    wh = Warehouse(spark, f"{folder}/warehouse")
    for rows, as_of in _two_deliveries(given.cdc_bronze(spark, sf)):
        files.write_csv(rows, f"{folder}/feed", "append")
        stream = stream_feed(
            wh, f"{folder}/feed", f"{folder}/checkpoint", "customers", LAYOUT, lambda now=as_of: now
        )
        stream.awaitTermination()
    return _dimension(wh)


@query
def stream_stateful_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Silver by a stateful stream over two deliveries; the delay covers the latest of the late events."""
    folder = work_folder(spark, "stream-latest")
    bronze = given.cdc_bronze(spark, sf)
    for rows, _ in _two_deliveries(bronze):
        rows.write.mode("append").parquet(f"{folder}/feed")
        feed = spark.readStream.schema(bronze.schema).parquet(f"{folder}/feed")
        stream_latest(feed, f"{folder}/latest", f"{folder}/checkpoint", delay_days=14).awaitTermination()
    return read_latest(spark, f"{folder}/latest", EVENT)


# --- integrity ---


def _unmerged(spark: SparkSession, sf: str) -> DataFrame:
    """Histories of two batches put together without a merge, which breaks the constraints."""
    batches = (given.ord_batch1(spark, sf), given.ord_batch2(spark, sf))
    first, second = (history.versions(batch, SPEC) for batch in batches)
    return first.unionByName(second)


@query
def chk_one_current(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.several_current(_unmerged(spark, sf))


@query
def chk_pk_unique(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.repeated(given.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def chk_fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Facts whose version is missing from the dimension as it stood at the cut."""
    known = given.customer_versions(spark, sf).filter(F.col("start_date") < ntz(ORDER_CUT))
    return integrity.orphans(fact_sales(spark, sf), known, "customer_sk")


@query
def chk_not_null(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.null_counts(given.cdc_bronze(spark, sf), ["event_id", "customer_id", "event_time", "country"])


@query
def chk_scd2_contiguous(spark: SparkSession, sf: str) -> DataFrame:
    return integrity.broken_borders(_unmerged(spark, sf))


@query
def gold_future_check(spark: SparkSession, sf: str) -> DataFrame:
    """History built without the future-time rule."""
    known = given.cdc_silver(spark, sf).filter(F.col("customer_id").isNotNull())
    dim = history.versions(known, SPEC, counts_from=given.cdc_bronze(spark, sf))
    return integrity.starting_after(dim, ntz(AS_OF))


# --- monitoring ---


@query
def mon_throughput(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.throughput(given.run_log(spark, sf))


@query
def mon_sla_status(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.sla_latest(given.sla_log(spark, sf))


@query
def mon_sla_breaches(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.sla_breaches(given.sla_log(spark, sf))


@query
def mon_dq_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.errors_by_reason(dq_single_pass(spark, sf))


@query
def recent_failed_records(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.recent_failures(dq_single_pass(spark, sf), 50)


@query
def mon_reliability(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.reliability(given.run_log(spark, sf))


@query
def mon_breach_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.breach_episodes(given.sla_log(spark, sf))


@query
def mon_dq_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return monitoring.failures_by_reason_and_day(dq_single_pass(spark, sf))


@query
def mon_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks merged from the sketches of daily runs, held against exact counts and ranks of all rows."""
    rows = given.run_delays(spark, sf)
    stored = settle(monitoring.run_sketches(rows, "run_day", "customer", "delay_seconds"))
    week = F.date_trunc("week", "run_day").cast("timestamp_ntz")
    merged = settle(monitoring.merged_sketches(stored, week))
    exact = rows.join(merged.drop("rows"), week == F.col("period")).groupBy("period").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("customer").alias("exact_customers"),
        F.any_value("customers").alias("customers"),
        *[(F.count_if(F.col("delay_seconds") <= F.col(f"delay_p{q}")) / F.count(F.lit(1))).alias(f"p{q}") for q in (50, 95)],
    )
    error = F.abs(F.col("customers") - F.col("exact_customers"))
    return exact.select(
        "period",
        "rows",
        "exact_customers",
        (error <= 1 + 0.08 * F.col("exact_customers")).alias("customers_close"),
        *[(F.abs(F.col(f"p{q}") - q / 100) <= 0.05).alias(f"p{q}_close") for q in (50, 95)],
    )
