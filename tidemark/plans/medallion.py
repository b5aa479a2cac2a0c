"""Bronze, silver and gold loads over a warehouse folder, published run by run."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.hashing import with_hash
from tidemark.functions.keys import version_key
from tidemark.functions.times import FIRST_MARK, LOOKBACK_DAYS, ntz
from tidemark.operators import history, quality, star, state as runs
from tidemark.operators.dedup import latest_per_key, merge_latest
from tidemark.operators.intervals import join_valid
from tidemark.operators.skew import join_lookup, settle
from tidemark.sources.key_log import KeyLog, same_keys
from tidemark.sources.warehouse import PART, Conflict, State, Warehouse

BRONZE = "bronze_customer_events"
SILVER = "silver_customer_events"
CUSTOMERS = "dim_customer"
PRODUCTS = "dim_product"
DATES = "dim_date"
FACTS = "fact_sales"
FACT_BASIS = "fact_sales_basis"
SILVER_IDS = "silver_event_ids"
DEAD = "dq_failed_events"
DEAD_IDS = "dq_failed_event_ids"
DEAD_PRODUCTS = "dq_failed_products"
DEAD_ORDERS = "dq_failed_orders"
NULL_PRODUCT = "NULL_PRODUCT_ID"
NULL_DATE = "NULL_ORDER_DATE"
METRICS = "pipeline_metrics"
SLA = "pipeline_sla_monitor"
DISTURBED = "disturbed_history"
NO_DATE = "none"
# Times a run is tried when others publish in between.
ATTEMPTS = 5


CHOICES = {"mark_over": ("valid", "all"), "rebuild_from": ("valid", "silver"), "empty_batch": ("report", "skip")}


@dataclass(frozen=True)
class Layout:
    """Feed columns, what the dimension tracks, and how it is bucketed.

    Every run rewrites the buckets its batch touches, so `buckets` should grow with the dimension. `id_buckets`
    are those of the logs that find an event's date or its dead letters by id; they are for good.

    `mark_over`: the mark follows the newest `valid` event, or that of `all` rows after the lookback border.
    `rebuild_from`: a late customer's history is redone from `valid` events, or (whole, so only without `collapse`)
    from all of `silver` that has a key and a time. `empty_batch`: a run without rows after the border writes its `report`, or is left out by `skip`.
    """

    feed: T.StructType = field(default_factory=lambda: schemas.CUSTOMER_FEED)
    spec: history.History = field(default_factory=history.History)
    buckets: int = 64
    id_buckets: int = 64
    lookback_days: int = LOOKBACK_DAYS
    collapse: bool = True
    null_id: str = "judge"
    mark_over: str = "valid"
    rebuild_from: str = "valid"
    empty_batch: str = "report"

    def __post_init__(self) -> None:
        for name, choices in CHOICES.items():
            if getattr(self, name) not in choices:
                raise ValueError(f"{name} is one of {', '.join(choices)}, not {getattr(self, name)!r}")
        if self.collapse and self.rebuild_from == "silver":
            raise ValueError("rebuild_from='silver' redoes whole histories and needs collapse=False")

    @property
    def events(self) -> T.StructType:
        """Feed columns plus arrival time."""
        arrival = T.StructField("arrival_ts", T.TimestampNTZType())
        return T.StructType([f for f in self.feed.fields if f.name != "arrival_ts"] + [arrival])

    @property
    def dimension(self) -> T.StructType:
        kinds = {f.name: f.dataType for f in self.feed.fields}
        spec = self.spec
        fields = [("customer_sk", T.StringType())]
        fields += [(name, kinds[name]) for name in (spec.key, *spec.tracked)]
        fields += [("start_date", T.TimestampNTZType()), ("end_date", T.TimestampNTZType())]
        fields += [("is_current", T.BooleanType()), ("hash_diff", T.StringType())]
        fields += [("source_event_id", kinds[spec.event_id]), ("created_at", T.TimestampNTZType())]
        return T.StructType([T.StructField(name, kind) for name, kind in fields])

    @property
    def disturbance(self) -> T.StructType:
        key = T.StructField(self.spec.key, self.feed[self.spec.key].dataType)
        return T.StructType([key, T.StructField("since", T.TimestampNTZType())])

    def ids(self, wh: Warehouse, table: str) -> KeyLog:
        return KeyLog(wh.path(table), self.spec.event_id, self.id_buckets)

    def id_kind(self, other: str) -> T.StructType:
        key = T.StructField(self.spec.event_id, self.feed[self.spec.event_id].dataType)
        return T.StructType([key, T.StructField(other, T.StringType())])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.spec.key)), F.lit(self.buckets)).cast("string")


def _date_part(time: str) -> Column:
    """Date as text that sorts like the date; later years share the last day of 9999."""
    date = F.least(F.to_date(F.col(time)), F.lit("9999-12-31").cast("date"))
    return F.when(F.col(time).isNull(), NO_DATE).otherwise(date.cast("string"))


def _values(df: DataFrame, column: str) -> set[str]:
    """Distinct part names; dates and buckets, so a bounded set."""
    return {row[0] for row in df.select(column).distinct().collect()}


def ingest_bronze(
    wh: Warehouse, state: State, feed: DataFrame, layout: Layout, as_of: datetime, run_id: str
) -> tuple[DataFrame, Observation]:
    """Append the feed under its run; gives the rows just appended, and how many of them came too late."""
    rows = schemas.select_to_schema(feed, layout.events, {"arrival_ts": ntz(as_of)})
    mark = state.marks.get(runs.PIPELINE, FIRST_MARK)
    rows, missed = runs.counting_late(rows, ntz(mark), layout.spec.time, layout.lookback_days)
    wh.append(rows, BRONZE, run_id)
    return wh.log(BRONZE, layout.events).filter(F.col("run_id") == run_id).drop("run_id"), missed


def refresh_silver(wh: Warehouse, state: State, arrived: DataFrame, layout: Layout, run_id: str) -> State:
    """Newest copy per event id, rewriting only the dates whose rows can change.

    Those are the dates of the arrived rows and of stored copies of the same ids (rows without
    an id count as one group). The result equals deduplicating all of bronze. Arrived and stored
    copies are kept as staged tables for `disturbances`.
    """
    spec = layout.spec
    newest = [spec.time, "arrival_ts"]
    fresh = latest_per_key(arrived, [spec.event_id], newest)
    fresh = wh.stage(fresh.withColumn(PART, _date_part(spec.time)), "fresh", run_id)
    index = layout.ids(wh, SILVER_IDS)
    dates, touched = fresh.agg(F.collect_set(PART), F.collect_set(index.bucket())).first()
    known = _indexed(wh, state, fresh, touched, layout, run_id)
    again = wh.stage(stored_copies(wh, state, fresh, known, layout), "again", run_id)
    taken = {*dates, *_values(again, PART)}
    # Dates an id had before stay listed: they are opened in vain, never missed.
    index.append(same_keys(fresh.select(spec.event_id, PART), known, [spec.event_id, PART], "left_anti"), run_id)
    after = merge_latest(wh.read(state, SILVER, layout.events, taken), fresh, [spec.event_id], newest)
    return state.replaced(SILVER, taken, wh.write_parts(after, SILVER, run_id), run_id)


def _indexed(
    wh: Warehouse, state: State, fresh: DataFrame, touched: Sequence[int], layout: Layout, run_id: str
) -> DataFrame:
    """Staged (id, date) of the index for ids of `fresh`: reads the touched buckets only.

    A silver table that has no index yet gets it first.
    """
    spec, kind = layout.spec, layout.id_kind(PART)
    index = layout.ids(wh, SILVER_IDS)
    found = index.read(wh.spark, kind, touched) if touched and state.parts(SILVER) else None
    if found is None and state.parts(SILVER) and not index.exists(wh.spark, kind):
        index.append(wh.read(state, SILVER, layout.events).select(*kind.names), f"{run_id}-index")
        found = index.read(wh.spark, kind, touched)
    if found is None:
        return wh.spark.createDataFrame([], kind)
    mine = same_keys(found.select(*kind.names), fresh, [spec.event_id], "left_semi")
    return wh.stage(mine, "dated", run_id)


def stored_copies(wh: Warehouse, state: State, fresh: DataFrame, known: DataFrame, layout: Layout) -> DataFrame:
    """Stored rows with an id of `fresh`, from the dates that `known` names for them."""
    dates = _values(known, PART) & state.parts(SILVER)
    return same_keys(wh.read(state, SILVER, layout.events, dates), fresh, [layout.spec.event_id], "left_semi")


def unseen_letters(wh: Warehouse, letters: DataFrame, layout: Layout, run_id: str) -> DataFrame:
    """Dead letters that no other run has stored; told by (id, reason) in the touched buckets, not from the log."""
    index, kind = layout.ids(wh, DEAD_IDS), layout.id_kind(quality.REASON)
    event_id = F.col(layout.spec.event_id)
    touched = letters.filter(event_id.isNotNull()).agg(F.collect_set(index.bucket())).first()[0]
    if not touched:
        return letters
    found = index.read(wh.spark, kind, touched)
    if found is None and not index.exists(wh.spark, kind):
        stored = wh.log(DEAD, letters.schema).filter(event_id.isNotNull() & (F.col("run_id") != run_id))
        index.append(stored.select(*kind.names), f"{run_id}-index")
        found = index.read(wh.spark, kind, touched)
    if found is None:
        return letters
    return quality.unseen_dead_letters(letters, found.filter(F.col("run_id") != run_id), layout.spec.event_id)


def store_letters(wh: Warehouse, letters: DataFrame, layout: Layout, run_id: str) -> None:
    """Append a run's new dead letters, if any, then their ids: a run that dies in between finds its own letters again."""
    if letters.isEmpty():
        return
    wh.append(unseen_letters(wh, letters, layout, run_id), DEAD, run_id)
    mine = wh.log(DEAD, letters.schema).filter((F.col("run_id") == run_id) & F.col(layout.spec.event_id).isNotNull())
    layout.ids(wh, DEAD_IDS).append(mine.select(layout.spec.event_id, quality.REASON), run_id)


def disturbances(wh: Warehouse, layout: Layout, mark: datetime, run_id: str) -> DataFrame:
    """Keys whose stored history may no longer be what their events give, and since when.

    An arrived event that is new or changed and too late for the lookback disturbs its key; a
    stored copy that an arrived one differs from disturbs the key it belonged to.
    """
    spec = layout.spec
    seen = [spec.event_id, spec.key, spec.time, "hash_diff"]
    fresh, again = (
        with_hash(wh.staged(name, layout.events, run_id), spec.tracked, spec.null_safe_hash).select(*seen)
        for name in ("fresh", "again")
    )
    content = [name for name in seen if name != spec.event_id]
    old = again.select(spec.event_id, *[F.col(name).alias(f"_old_{name}") for name in content])
    differs = F.lit(False)
    for name in content:
        differs = differs | ~F.col(name).eqNullSafe(F.col(f"_old_{name}"))
    compared = fresh.join(old, spec.event_id, "full").filter(differs)
    late = runs.too_late(compared, ntz(mark), spec.time, layout.lookback_days)
    columns = [F.col(spec.key), F.col(spec.time).alias("since")]
    replaced = [F.col(f"_old_{spec.key}").alias(spec.key), F.col(f"_old_{spec.time}").alias("since")]
    found = late.select(*columns).unionByName(compared.select(*replaced))
    return found.filter(F.col(spec.key).isNotNull() & F.col("since").isNotNull())


def overwrite_silver(wh: Warehouse, state: State, layout: Layout, run_id: str) -> State:
    """Silver recomputed from all of bronze."""
    spec = layout.spec
    bronze = wh.log(BRONZE, layout.events).drop("run_id")
    rows = latest_per_key(bronze, [spec.event_id], [spec.time, "arrival_ts"])
    written = wh.write_parts(rows.withColumn(PART, _date_part(spec.time)), SILVER, run_id)
    state = state.replaced(SILVER, state.parts(SILVER), written, run_id)
    layout.ids(wh, SILVER_IDS).append(wh.read(state, SILVER, layout.events).select(spec.event_id, PART), run_id)
    return state


def silver_since(wh: Warehouse, state: State, layout: Layout, moment: datetime) -> DataFrame:
    """Silver rows from the date folders that can hold events of `moment` or later."""
    parts = {p for p in state.parts(SILVER) if p != NO_DATE and p >= moment.date().isoformat()}
    return wh.read(state, SILVER, layout.events, parts).drop(PART)


def load_customers(
    wh: Warehouse, state: State, arrived: DataFrame, missed: Observation, layout: Layout, as_of: datetime, run_id: str
) -> State:
    """Quality split, dead letters, history merge, mark, metrics and freshness of one run.

    Follows `ingest_bronze`, which observed `missed`, and `refresh_silver` of the same run. The run's
    metrics are observed on writes that happen anyway.
    """
    spec = layout.spec
    now = ntz(as_of)
    mark = state.marks.get(runs.PIPELINE, FIRST_MARK)
    rules = quality.standard_rules(now, spec.key, spec.time)

    border = mark - timedelta(days=layout.lookback_days)
    recent = silver_since(wh, state, layout, border)
    batch = runs.since_mark(recent, ntz(mark), spec.time, layout.lookback_days)
    # Silver has one row per id, so DUPLICATE_EVENT cannot occur and the check needs no shuffle.
    judged = quality.flag(batch, rules, spec.event_id, layout.null_id, unique_ids=True)
    # Rows without a time are in no lookback: they fail on arrival.
    untimed = [quality.untimed_rule(spec.time), *rules[:1]]
    lost = quality.flag(arrived.filter(F.col(spec.time).isNull()), untimed, spec.event_id, unique_ids=True)
    lost = lost.withColumn("rejected", F.lit(True))
    observed, counts = runs.counting_run(judged.unionByName(lost))
    flagged = wh.stage(observed, "flagged", run_id)
    letters = quality.dead_letters(flagged).withColumn("failed_at", now)
    store_letters(wh, letters, layout, run_id)

    valid = quality.valid_rows(flagged)
    if layout.null_id == "leak":
        valid = valid.filter(F.col(spec.key).isNotNull())
    disturbed = wh.read(state, DISTURBED, layout.disturbance).drop(PART)
    disturbed = disturbed.unionByName(disturbances(wh, layout, mark, run_id))
    disturbed = wh.stage(disturbed, "disturbed", run_id)
    touched, newest = valid.agg(F.collect_set(layout.bucket()), F.max(spec.time)).first()
    if layout.mark_over == "all":
        newest = flagged.agg(F.max(spec.time)).first()[0]
    if newest is not None:
        state = state.marked(runs.PIPELINE, max(mark, newest))
    if touched:
        stored = wh.read(state, CUSTOMERS, layout.dimension, touched).drop(PART, "customer_sk")

        def valid_since(moment: datetime) -> DataFrame:
            events = silver_since(wh, state, layout, moment)
            if layout.rebuild_from == "valid":
                return events.filter(~quality.any_broken(rules))
            return events.filter(F.col(spec.key).isNotNull() & F.col(spec.time).isNotNull())

        if layout.collapse:
            done = history.merge_recent(stored, valid, valid_since, disturbed, spec)
            merged, disturbed = done.dim, done.disturbed
        else:
            merged = history.merge(stored, valid, valid_since(datetime.min), spec, collapse=False)
        keyed = merged.withColumn("customer_sk", version_key(spec.key))
        rows = schemas.select_to_schema(keyed, layout.dimension, {"created_at": now})
        written = wh.write_parts(rows.withColumn(PART, layout.bucket()), CUSTOMERS, run_id)
        state = state.replaced(CUSTOMERS, touched, written, run_id)

    if layout.collapse:
        kept = disturbed.groupBy(spec.key).agg(F.min("since").alias("since")).withColumn(PART, layout.bucket())
        written = wh.write_parts(kept, DISTURBED, run_id)
        state = state.replaced(DISTURBED, state.parts(DISTURBED), written, run_id)

    if layout.empty_batch == "skip" and not counts.get["records_processed"]:
        return state
    wh.append(runs.observed_metrics(wh.spark, counts, missed, as_of), METRICS, run_id)
    dim = wh.read(state, CUSTOMERS, layout.dimension)
    wh.append(runs.freshness(dim, as_of), SLA, run_id)
    return state


def _until_published(run: Callable[[], State]) -> State:
    """Redo a run whose state was overtaken by another publication; what it wrote it writes again."""
    for _ in range(ATTEMPTS - 1):
        try:
            return run()
        except Conflict:
            continue
    return run()


def run_batch(wh: Warehouse, feed: DataFrame, as_of: datetime, run_id: str, layout: Layout | None = None) -> State:
    """One feed through bronze, silver and gold; a run that is already published does nothing."""
    return _until_published(lambda: _run_batch(wh, feed, as_of, run_id, layout or Layout()))


def _run_batch(wh: Warehouse, feed: DataFrame, as_of: datetime, run_id: str, layout: Layout) -> State:
    state = wh.state(run_id)
    if state.repeated:
        return state
    arrived, missed = ingest_bronze(wh, state, feed, layout, as_of, run_id)
    state = rebucketed(wh, state, layout, run_id)
    state = refresh_silver(wh, state, arrived, layout, run_id)
    state = load_customers(wh, state, arrived, missed, layout, as_of, run_id)
    state = wh.publish(state, run_id)
    wh.drop_staged(run_id)
    return state


def rebucketed(wh: Warehouse, state: State, layout: Layout, run_id: str) -> State:
    """The state with the dimension in the layout's buckets; rewritten if they were others."""
    if state.buckets.get(CUSTOMERS, layout.buckets) != layout.buckets:
        dim, own = wh.read(state, CUSTOMERS, layout.dimension), f"{run_id}-rebucket"
        written = wh.write_parts(dim.withColumn(PART, layout.bucket()), CUSTOMERS, own)
        state = state.replaced(CUSTOMERS, state.parts(CUSTOMERS), written, own)
    return state.bucketed(CUSTOMERS, layout.buckets)


def _append_part(wh: Warehouse, state: State, df: DataFrame, table: str, run_id: str) -> State:
    part = f"run-{run_id}"
    written = wh.write_parts(df.withColumn(PART, F.lit(part)), table, run_id)
    return state.replaced(table, [part], written, run_id)


def load_star(
    wh: Warehouse,
    orders: DataFrame,
    products: DataFrame,
    as_of: datetime,
    run_id: str,
    layout: Layout | None = None,
    grain: Sequence[str] = ("order_id",),
    how: str = "auto",
) -> State:
    """Add new products and dates, rebuild the facts, publish all three together.

    Readers see the former facts until the publication, so the table is never empty in between.
    """
    layout = layout or Layout()
    return _until_published(lambda: _load_star(wh, orders, products, as_of, run_id, layout, grain, how))


def _load_star(
    wh: Warehouse,
    orders: DataFrame,
    products: DataFrame,
    as_of: datetime,
    run_id: str,
    layout: Layout,
    grain: Sequence[str],
    how: str,
) -> State:
    state = wh.state(run_id)
    if state.repeated:
        return state
    now = ntz(as_of)
    for feed, key, reason, dead in (
        (products, "product_id", NULL_PRODUCT, DEAD_PRODUCTS),
        (orders, "order_date", NULL_DATE, DEAD_ORDERS),
    ):
        wh.append(star.keyless(feed, key, reason).withColumn("failed_at", now), dead, run_id)

    stored = wh.read(state, PRODUCTS, schemas.DIM_PRODUCT).drop(PART)
    fresh = star.unseen(star.product_rows(products), stored, "product_id")
    fresh = schemas.select_to_schema(fresh, schemas.DIM_PRODUCT, {"created_at": now})
    state = _append_part(wh, state, fresh, PRODUCTS, run_id)

    stored = wh.read(state, DATES, schemas.DIM_DATE).drop(PART)
    fresh = star.unseen(star.date_rows(star.order_dates(orders)), stored, "full_date")
    state = _append_part(wh, state, schemas.select_to_schema(fresh, schemas.DIM_DATE), DATES, run_id)

    rows = _fact_rows(wh, state, orders, layout, grain, how, now, run_id)
    written = wh.write_parts(rows.withColumn(PART, _month()), FACTS, run_id, gathered=True)
    state = state.replaced(FACTS, state.parts(FACTS), written, run_id)
    state = wh.publish(_based(wh, state, run_id), run_id)
    wh.drop_staged(run_id)
    return state


# Which run's part of the customer dimension facts were made from.
BASIS = schemas.table(bucket="string", run="string")


def _month() -> Column:
    """Facts lie in parts by month."""
    return F.coalesce(F.expr("date_sk div 100").cast("string"), F.lit(NO_DATE))


def _fact_rows(
    wh: Warehouse,
    state: State,
    orders: DataFrame,
    layout: Layout,
    grain: Sequence[str],
    how: str,
    now: Column,
    run_id: str,
    after: int = 0,
) -> DataFrame:
    """Facts of the orders with keys that follow on `after`, lying together by date."""
    # In the types they are stored in, amounts take less room on their way.
    kinds = {f.name: f.dataType for f in schemas.FACT_SALES if f.name in ("quantity", "total_amount")}
    facts = star.numbered_facts(
        orders.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()}),
        wh.read(state, CUSTOMERS, layout.dimension),
        wh.read(state, PRODUCTS, schemas.DIM_PRODUCT),
        wh.read(state, DATES, schemas.DIM_DATE),
        tuple(grain),
        how,
        lambda rows: wh.stage(rows, "joined", run_id, "zstd"),
    )
    facts = facts.withColumn("sales_sk", F.col("sales_sk") + after)
    return schemas.select_to_schema(facts, schemas.FACT_SALES, {"created_at": now})


def _based(wh: Warehouse, state: State, run_id: str) -> State:
    """The state with a note of which runs' customer buckets its facts were made from: one row for each bucket."""
    runs_of = [(part, run) for (table, part), run in state.live.items() if table == CUSTOMERS]
    note = wh.spark.createDataFrame(runs_of, BASIS).withColumn(PART, F.lit("all"))
    return state.replaced(FACT_BASIS, ["all"], wh.write_parts(note, FACT_BASIS, run_id), run_id)


def stale_months(wh: Warehouse, state: State, orders: DataFrame, layout: Layout) -> set[str]:
    """Months with orders whose customer version may have changed since the facts were made.

    Only customer buckets that were written since are compared, old with new; an order counts if its time
    lies in a window that differs. The months are few, so the driver may have them.
    """
    basis = {row["bucket"]: row["run"] for row in wh.read(state, FACT_BASIS, BASIS).collect()}
    live = {part: run for (table, part), run in state.live.items() if table == CUSTOMERS}
    differ = {part for part in basis.keys() | live.keys() if basis.get(part) != live.get(part)}
    before = State(live={(CUSTOMERS, part): run for part, run in basis.items()})
    old, new = (wh.read(one, CUSTOMERS, layout.dimension, differ) for one in (before, state))
    key = layout.spec.key
    windows = settle(history.changed_windows(old, new, layout.spec, "customer_sk"))
    placed = orders.select(key, "order_date")
    near = settle(join_lookup(placed, windows.select(key).distinct(), key, "left_semi"))
    hit = join_valid(near, windows, key, "order_date", ["start_date"]).filter("start_date IS NOT NULL")
    return _values(hit.select(F.date_format("order_date", "yyyyMM").alias(PART)), PART)


def refresh_facts(
    wh: Warehouse,
    orders: DataFrame,
    as_of: datetime,
    run_id: str,
    layout: Layout | None = None,
    grain: Sequence[str] = ("order_id",),
    how: str = "auto",
) -> State:
    """Bring facts up to date with the customer history: as `load_star` would, rewriting only months that can differ.

    `orders` are those the facts were made from. New orders, products and dates come with `load_star`.
    Other months keep their files. New keys follow on the greatest stored one.
    """
    layout = layout or Layout()
    return _until_published(lambda: _refresh_facts(wh, orders, as_of, run_id, layout, grain, how))


def _refresh_facts(
    wh: Warehouse, orders: DataFrame, as_of: datetime, run_id: str, layout: Layout, grain: Sequence[str], how: str
) -> State:
    state = wh.state(run_id)
    if state.repeated:
        return state
    months = stale_months(wh, state, orders, layout)
    if months:
        number = F.col("sales_sk").cast("long")
        after = wh.read(state, FACTS, schemas.FACT_SALES).agg(F.max(number)).first()[0] or 0
        first, last = (datetime.strptime(month, "%Y%m") for month in (min(months), max(months)))
        # The range reaches the scan of the orders; the months then pick from it.
        near = orders.filter((F.col("order_date") >= ntz(first)) & (F.col("order_date") < ntz(last + timedelta(days=31))))
        mine = near.filter(F.date_format("order_date", "yyyyMM").isin(sorted(months)))
        rows = _fact_rows(wh, state, mine, layout, grain, how, ntz(as_of), run_id, after)
        written = wh.write_parts(rows.withColumn(PART, _month()), FACTS, run_id, gathered=True)
        state = state.replaced(FACTS, months, written, run_id)
    state = wh.publish(_based(wh, state, run_id), run_id)
    wh.drop_staged(run_id)
    return state
