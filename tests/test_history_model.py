"""Random event histories against a row-by-row model of the same rules."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.operators import history, integrity
from tidemark.plans import medallion
from tidemark.schemas import table
from tidemark.sources.warehouse import Warehouse

SPEC = history.History(tracked=("city",))
EVENTS = table(event_id="long", customer_id="string", city="string", event_time="timestamp_ntz", arrived="integer")
START = datetime(2024, 1, 1)


def random_events(seed, customers=120, most=9, ties=False):
    """Events that arrive in two batches; some late, with distinct times unless `ties`."""
    rng = random.Random(seed)
    rows, number = [], 0
    for customer in range(customers):
        count = rng.randint(1, most) if customer else 200
        hours = [rng.randint(0, 12) for _ in range(count)] if ties else rng.sample(range(400), count)
        for hour in hours:
            number += 1
            time = START + timedelta(hours=hour)
            rows.append((number, f"C{customer}", rng.choice("abc"), time, rng.choice((1, 1, 2))))
    return rows


def model_timeline(rows, collapse=True):
    kept = []
    for row in sorted(rows, key=lambda r: (r[3], r[0])):
        if not (collapse and kept and kept[-1][2] == row[2]):
            kept.append(row)
    ends = [row[3] for row in kept[1:]] + [None]
    return [(row[1], row[2], row[3], end, end is None, row[0]) for row, end in zip(kept, ends)]


def model_merge(dim, batch, everything, collapse):
    """One customer: a late batch rebuilds from all events, else rows are applied in time order."""
    open_row = next((v for v in dim if v[4]), None)
    ordered = sorted(batch, key=lambda r: (r[3], r[0]))
    if open_row and ordered[0][3] < open_row[2]:
        return model_timeline(everything, collapse)
    result = list(dim)
    for row in ordered:
        if open_row and open_row[1] == row[2]:
            continue
        if open_row:
            result.remove(open_row)
            result.append((*open_row[:3], row[3], False, open_row[5]))
        open_row = (row[1], row[2], row[3], None, True, row[0])
        result.append(open_row)
    return result


def rows_of(df):
    columns = ("customer_id", "city", "start_date", "end_date", "is_current", "source_event_id")
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


@pytest.mark.parametrize(
    "seed, collapse, split", [(0, True, False), (1, True, True), (1, False, False), (0, False, True)]
)
def test_merge_equals_the_row_loop(spark, seed, collapse, split):
    rows = random_events(seed, ties=seed == 1)
    if split:
        spark.conf.set("spark.tidemark.hotRows", "30")
        spark.conf.set("spark.tidemark.broadcastRows", "3")
    try:
        events = spark.createDataFrame(rows, EVENTS)
        first, second = events.filter("arrived = 1"), events.filter("arrived = 2")
        dim = history.versions(first, SPEC)
        merged = history.merge(dim, second, events, SPEC, collapse)
        expected, before = [], []
        for customer in {row[1] for row in rows}:
            mine = [row for row in rows if row[1] == customer]
            old = model_timeline([row for row in mine if row[4] == 1])
            late = [row for row in mine if row[4] == 2]
            before += old
            expected += model_merge(old, late, mine, collapse) if late else old
        assert rows_of(dim) == sorted(before, key=repr)
        assert rows_of(merged) == sorted(expected, key=repr)
        assert integrity.several_current(merged).isEmpty()
        assert integrity.broken_borders(merged).isEmpty()
    finally:
        spark.conf.unset("spark.tidemark.hotRows")
        spark.conf.unset("spark.tidemark.broadcastRows")


def test_one_batch_equals_many_and_replay_changes_nothing(spark):
    rows = random_events(11)
    events = spark.createDataFrame(rows, EVENTS)
    first, second = events.filter("arrived = 1"), events.filter("arrived = 2")
    whole = rows_of(history.versions(events, SPEC))
    dim = history.merge(history.versions(first, SPEC), second, events, SPEC)
    again = history.merge(dim, events, events, SPEC)
    assert rows_of(again) == whole


FEED = table(event_id="long", customer_id="string", city="string", event_time="timestamp_ntz", arrival_ts="timestamp_ntz")


def random_deliveries(seed, runs=3, rows=120):
    """Batches with on-time, late and too-late events, ties, and ids delivered again, some changed."""
    rng = random.Random(seed)
    number, sent, batches = 0, [], []
    for run in range(runs):
        arrived = START + timedelta(days=6 * (run + 1))
        batch = []
        for _ in range(rows):
            number += 1
            days = 6 * run + rng.choice([0, 1, 2, 3, 4, 5, -1, -3, -6, -9, -14])
            time = START + timedelta(days=days, hours=rng.choice([0, 0, 6]))
            customer = f"C{rng.randint(0, 30)}" if rng.random() > 0.03 else None
            batch.append((number, customer, rng.choice("abc"), time, arrived))
        for number_, customer, city, time, _ in rng.sample(sent, min(len(sent), 25)):
            change = rng.choice(["time", "city", "customer", None, None])
            time += timedelta(days=rng.choice([1, 3, 8, -4])) if change == "time" else timedelta()
            city = rng.choice("abc") if change == "city" else city
            customer = f"C{rng.randint(0, 30)}" if change == "customer" else customer
            batch.append((number_, customer, city, time, arrived + timedelta(minutes=1)))
        sent += batch
        batches.append((batch, arrived))
    return batches


def test_partial_rebuilds_equal_whole_ones(spark, tmp_path, monkeypatch):
    def rebuild_all(dim, batch, events_since, disturbed, spec):
        return history.Merged(history.merge(dim, batch, events_since(datetime.min), spec), disturbed)

    layout = medallion.Layout(feed=FEED, spec=SPEC, buckets=3)
    results = []
    for way in (history.merge_recent, rebuild_all):
        monkeypatch.setattr(history, "merge_recent", way)
        wh = Warehouse(spark, str(tmp_path / way.__name__))
        states = []
        for n, (rows, as_of) in enumerate(random_deliveries(21)):
            state = medallion.run_batch(wh, spark.createDataFrame(rows, FEED), as_of, f"r{n}", layout)
            states.append(rows_of(wh.read(state, medallion.CUSTOMERS, layout.dimension)))
        silver = wh.read(state, medallion.SILVER, layout.events).drop("part")
        again = medallion.overwrite_silver(wh, state, layout, "whole")
        assert sorted(silver.collect(), key=repr) == sorted(wh.read(again, medallion.SILVER, layout.events).drop("part").collect(), key=repr)
        results.append(states)
    assert results[0] == results[1]
