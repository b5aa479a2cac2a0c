"""The id index of silver and the dead-letter index: what they find, and what they open."""

import random
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import history, quality
from tidemark.operators.dedup import latest_per_key
from tidemark.plans import medallion
from tidemark.sources.key_log import KeyLog
from tidemark.sources.warehouse import PART, State, Warehouse

DAY = datetime(2024, 1, 1)
FEED = schemas.table(event_id="string", customer_id="string", city="string", event_time="timestamp_ntz", arrival_ts="timestamp_ntz")
LAYOUT = medallion.Layout(feed=FEED, spec=history.History(tracked=("city",)), buckets=4, id_buckets=8)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def event(n, day, city="x", arrived=0):
    return (f"id-{n}", f"c{n % 7}", city, DAY + timedelta(days=day), DAY + timedelta(days=day, minutes=arrived))


def refreshed(wh, state, rows, run):
    frame = wh.spark.createDataFrame(rows, FEED)
    return wh.publish(medallion.refresh_silver(wh, state, frame, LAYOUT, run), run)


def opened(df):
    return {tuple(x for x in file.split("/") if "=" in x and not x.startswith("run_id")) for file in df.inputFiles()}


def test_one_old_id_opens_one_bucket_and_one_date(spark, wh):
    state = refreshed(wh, State(), [event(n, n % 30) for n in range(300)], "r1")
    old = spark.createDataFrame([event(17, 29, "moved", 5)], FEED).withColumn(PART, F.lit("2024-01-30"))
    index = LAYOUT.ids(wh, medallion.SILVER_IDS)
    (bucket,) = [r[0] for r in old.select(index.bucket()).collect()]
    assert opened(index.read(spark, LAYOUT.id_kind(PART), [bucket])) == {(f"bucket={bucket}",)}
    known = medallion._indexed(wh, state, old, [bucket], LAYOUT, "r2")
    assert [r[PART] for r in known.collect()] == ["2024-01-18"]
    again = medallion.stored_copies(wh, state, old, known, LAYOUT)
    assert opened(again) == {("part=2024-01-18",)} and [r["event_id"] for r in again.collect()] == ["id-17"]


def test_silver_by_index_like_dedup_of_all(spark, wh):
    """Random deliveries: moved, repeated and NULL ids, ids that change their date twice, NULL times."""
    rng, state, bronze = random.Random(4), State(), []
    for run in range(4):
        rows = [event(rng.randrange(60), rng.randrange(20), rng.choice("abc"), 100 * run + rng.randrange(99)) for _ in range(50)]
        rows += [(None, "c1", "n", DAY + timedelta(days=run), DAY + timedelta(days=run)), (f"id-{run}", "c2", "u", None, DAY)]
        bronze += rows
        state = refreshed(wh, state, rows, f"r{run}")
        kept = latest_per_key(spark.createDataFrame(bronze, FEED), ["event_id"], ["event_time", "arrival_ts"])
        found = wh.read(state, medallion.SILVER, LAYOUT.events).drop(PART)
        assert Counter(found.collect()) == Counter(kept.collect())


def test_silver_without_an_index_gets_one(spark, wh):
    rows = [event(n, n % 5) for n in range(40)]
    placed = spark.createDataFrame(rows, FEED).withColumn(PART, F.to_date("event_time").cast("string"))
    state = State().replaced(medallion.SILVER, [], wh.write_parts(placed, medallion.SILVER, "r0"), "r0")
    state = refreshed(wh, wh.publish(state, "r0"), [event(3, 9, "moved", 1)], "r1")
    found = wh.read(state, medallion.SILVER, LAYOUT.events)
    assert found.count() == 40 and [r["city"] for r in found.filter("event_id = 'id-3'").collect()] == ["moved"]


def test_dead_letters_are_told_from_touched_buckets(spark, wh):
    rules = quality.standard_rules(F.lit("2024-02-01").cast("timestamp_ntz"))
    bad = [(f"id-{n}", None, "x", DAY, DAY) for n in range(50)] + [(None, None, "x", DAY, DAY)]

    def letters(rows):
        flagged = quality.flag(spark.createDataFrame(rows, FEED), rules, unique_ids=True)
        return wh.stage(quality.dead_letters(flagged).withColumn("failed_at", F.lit(DAY).cast("timestamp_ntz")), "letters", f"l{len(rows)}")

    medallion.store_letters(wh, letters(bad), LAYOUT, "r1")
    medallion.store_letters(wh, letters(bad), LAYOUT, "r1")
    again = letters([bad[5], ("id-5", "c", "x", DAY + timedelta(days=99), DAY), ("new", None, "x", DAY, DAY)])
    unseen = medallion.unseen_letters(wh, again, LAYOUT, "r2")
    index = LAYOUT.ids(wh, medallion.DEAD_IDS)
    touched = {(f"bucket={r[0]}",) for r in again.select(index.bucket()).collect()}
    files = [f for f in unseen.inputFiles() if "_staged" not in f]
    assert files and all("/" + medallion.DEAD_IDS + "/" in f for f in files)
    assert {tuple(x for x in f.split("/") if x.startswith("bucket=")) for f in files} <= touched and len(touched) < 4
    assert {(r["event_id"], r[quality.REASON]) for r in unseen.collect()} == {("id-5", quality.FUTURE), ("new", quality.NULL_KEY)}
    medallion.store_letters(wh, again, LAYOUT, "r2")
    medallion.store_letters(wh, again, LAYOUT, "r3")
    assert wh.log(medallion.DEAD, again.schema).count() == 53


def test_key_log_replaces_a_run_and_reads_nothing_before_it(spark, tmp_path):
    log = KeyLog(str(tmp_path / "log"), "event_id", 4)
    kind = LAYOUT.id_kind(PART)
    assert log.read(spark, kind, [0, 1]) is None and not log.exists(spark, kind)
    rows = spark.createDataFrame([(f"id-{n}", "d") for n in range(30)], kind)
    log.append(rows, "a/1")
    log.append(rows, "a/1")
    log.append(rows.limit(3), "b")
    assert log.read(spark, kind, range(4)).groupBy("run_id").count().collect().__len__() == 2
    assert log.read(spark, kind, range(4)).count() == 33
    assert replace(log, buckets=4).exists(spark, kind)


def test_bucketed_merge_reads_the_dimension_once_and_does_not_shuffle_it(spark):
    from tidemark.plans import inputs as given
    from conftest import TESTDATA

    dim = given.ord_dim1_bucketed(spark, TESTDATA, 8)
    plans, settle = [], history.settle

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return settle(df)

    history.settle = seen
    try:
        history.merge_bucketed(dim, given.ord_batch2(spark, TESTDATA), given.ord_cdc(spark, TESTDATA), given.SPEC, 8)
    finally:
        history.settle = settle
    (plan,) = plans
    above = plan[: plan.index("Bucketed: true")].splitlines()[-1]
    assert plan.count("Bucketed: true") == 1 and "Exchange" not in plan[: plan.index("Bucketed: true")], above
    assert plan.count("Window") >= 1 and plan.count("Exchange") == 1


@pytest.mark.parametrize("seed", range(3))
def test_bucketed_merge_like_merge(spark, seed):
    """Late, new, unchanged and untouched customers, ties at the current start, versions that cover no time."""
    from tidemark.sources.bucketed import bucketed_table

    rng, spec = random.Random(seed), LAYOUT.spec
    rows = [event(n, rng.randrange(20), rng.choice("ab"), rng.randrange(9)) for n in range(90)]
    rows = [(i, f"c{rng.randrange(14)}", *rest) for i, _, *rest in rows]
    events = spark.createDataFrame(rows, FEED)
    before, batch = events.filter("event_time < '2024-01-15'"), events.filter("event_time >= '2024-01-12' AND length(event_id) > 4")
    built = history.versions(before.filter("customer_id < 'c5'"), spec)
    dim = bucketed_table(built, "customer_id", ["start_date"], 4)
    for collapse in (True, False):
        found = history.merge_bucketed(dim, batch, events, spec, 4, collapse)
        assert Counter(found.collect()) == Counter(history.merge(dim, batch, events, spec, collapse).collect())


def test_refreshed_facts_keep_the_files_of_other_months(spark, wh):
    from conftest import TESTDATA
    from tidemark.plans import catalog, inputs as given

    late = (F.col("o_custkey") % 20 == 0) & F.col("o_orderdate").between(*map(F.lit, catalog.LATE_MONTHS))
    catalog._publish_customers(wh, given.customer_versions(spark, TESTDATA, ~late), "r0")
    orders, products = catalog._star_feeds(spark, TESTDATA)
    layout = catalog.SALES_LAYOUT
    before = medallion.load_star(wh, orders, products, DAY, "r1", layout)
    catalog._publish_customers(wh, given.customer_versions(spark, TESTDATA), "r2")
    after = medallion.refresh_facts(wh, orders, DAY, "r3", layout)
    rewritten = {part for (name, part), run in after.live.items() if name == medallion.FACTS and run == "r3"}
    assert rewritten and len(rewritten) < len(after.parts(medallion.FACTS)) / 2 and after.parts(medallion.FACTS) == before.parts(medallion.FACTS)
    kept = [f for f in wh.read(after, medallion.FACTS, schemas.FACT_SALES).inputFiles() if "run_id=r1" in f]
    assert len({f.split("part=")[1][:6] for f in kept}) == len(after.parts(medallion.FACTS)) - len(rewritten)
    keys = wh.read(after, medallion.FACTS, schemas.FACT_SALES).select("sales_sk")
    assert keys.distinct().count() == keys.count()
    whole = medallion.load_star(wh, orders, products, DAY, "r4", layout)
    found, rebuilt = (Counter(wh.read(s, medallion.FACTS, schemas.FACT_SALES).drop("sales_sk", PART).collect()) for s in (after, whole))
    assert found == rebuilt
    same = medallion.refresh_facts(wh, orders, DAY, "r5", layout)
    assert not any(run == "r5" for (name, _), run in same.live.items() if name == medallion.FACTS)
