"""The sample feeds, read from CSV files, with results worked out by hand."""

from datetime import datetime
from decimal import Decimal

import pytest

from tidemark import schemas
from tidemark.functions.keys import version_key
from tidemark.plans import medallion
from tidemark.plans.medallion import Layout, load_star, run_batch
from tidemark.sources.files import CORRUPT, read_csv_feed
from tidemark.sources.warehouse import Conflict, Warehouse
from tidemark.streaming.feed import stream_feed

# The sample feeds.
CUSTOMERS = """event_id,customer_id,first_name,last_name,email,city,country,event_time
1001,C001,Arun,Kumar,arun@example.com,Delhi,India,2024-03-01 08:00:00
1002,C001,Arun,Kumar,arun@example.com,Pune,India,2024-04-01 09:00:00
1003,C002,Priya,Sharma,priya@example.com,Bangalore,India,2024-01-05 12:00:00
1004,C001,Arun,Kumar,arun@example.com,Mumbai,India,2024-03-28 09:00:00
"""
ORDERS = """order_id,customer_id,product_id,order_date,quantity,total_amount
O001,C001,P001,2024-02-15 10:00:00,1,800
O002,C002,P002,2024-01-10 09:00:00,1,1800
O003,C001,P001,2024-03-10 08:00:00,1,800
"""
PRODUCTS = """product_id,product_name,category,price
P001,Smartphone,Electronics,800
P002,Laptop,Electronics,1800
"""

at = datetime.fromisoformat
AS_OF = at("2024-04-01 11:00:59")
DIMENSION = [
    ("C001", "Delhi", at("2024-03-01 08:00:00"), at("2024-03-28 09:00:00"), False, "d6273c5a54a73310bb073a6898ff5c91"),
    ("C001", "Mumbai", at("2024-03-28 09:00:00"), at("2024-04-01 09:00:00"), False, "3e4ef6f89dcbb87c0d0e66228cb1a386"),
    ("C001", "Pune", at("2024-04-01 09:00:00"), None, True, "68358e47a6bf1e6f0fed54816cdc93c1"),
    ("C002", "Bangalore", at("2024-01-05 12:00:00"), None, True, "c8487def9100dc910afbae5af12f08ce"),
]


def feed(spark, folder, text, schema, name="feed.csv"):
    path = folder / name
    path.write_text(text)
    return read_csv_feed(spark, str(path), schema)


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def dimension(wh):
    df = wh.read(wh.state(), medallion.CUSTOMERS, Layout().dimension)
    rows = df.select("customer_id", "city", "start_date", "end_date", "is_current", "hash_diff").collect()
    return sorted(map(tuple, rows), key=lambda row: (row[0], row[2]))


def metrics(wh, run):
    rows = wh.log(medallion.METRICS, schemas.RUN_METRICS).filter(f"run_id = '{run}'").collect()
    assert len(rows) == 1
    return tuple(rows[0])[2:6]


def customers(spark, tmp_path, text=CUSTOMERS):
    return feed(spark, tmp_path, text, schemas.CUSTOMER_FEED)


@pytest.mark.parametrize("collapse", [True, False])
def test_two_runs_of_the_same_feed(spark, wh, tmp_path, collapse):
    layout = Layout(collapse=collapse)
    for run in ("r1", "r2"):
        run_batch(wh, customers(spark, tmp_path), AS_OF, run, layout)
        assert dimension(wh) == DIMENSION
        assert wh.state().marks == {"customer_pipeline": at("2024-04-01 09:00:00")}
    assert metrics(wh, "r1") == (4, 0, 4, 0)
    assert metrics(wh, "r2")[:3] == (2, 0, 2)


def test_published_run_is_not_repeated(spark, wh, tmp_path):
    first = run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    again = run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    assert (first.seq, first.live, first.marks) == (again.seq, again.live, again.marks)


def test_run_that_died_before_publishing_leaves_the_old_state(spark, wh, tmp_path, monkeypatch):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    moved = "event_id,customer_id,first_name,last_name,email,city,country,event_time\n" \
        "1005,C002,Priya,Sharma,priya@example.com,Goa,India,2024-03-31 10:00:00\n"
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run_batch(wh, feed(spark, tmp_path, moved, schemas.CUSTOMER_FEED, "b.csv"), AS_OF, "r2")
    assert dimension(wh) == DIMENSION
    run_batch(wh, feed(spark, tmp_path, moved, schemas.CUSTOMER_FEED, "b.csv"), AS_OF, "r2")
    assert [row[1] for row in dimension(wh)] == ["Delhi", "Mumbai", "Pune", "Bangalore", "Goa"]
    assert wh.log(medallion.BRONZE, Layout().events).count() == 5


def test_facts(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    orders = feed(spark, tmp_path, ORDERS, schemas.ORDER_FEED, "orders.csv")
    products = feed(spark, tmp_path, PRODUCTS, schemas.PRODUCT_FEED, "products.csv")
    results = []
    for run in ("s1", "s2"):
        state = load_star(wh, orders, products, at("2024-04-02 00:00:00"), run)
        facts = wh.read(state, medallion.FACTS, schemas.FACT_SALES)
        dim = wh.read(state, medallion.CUSTOMERS, Layout().dimension)
        versions = {row["customer_sk"]: (row["customer_id"], row["city"]) for row in dim.collect()}
        names = {r["product_sk"]: r["product_id"] for r in wh.read(state, medallion.PRODUCTS, schemas.DIM_PRODUCT).collect()}
        assert sorted(names.values()) == ["P001", "P002"]
        days = {r["date_sk"]: tuple(r)[1:6] for r in wh.read(state, medallion.DATES, schemas.DIM_DATE).collect()}
        results.append(
            sorted(
                (r["order_id"], versions.get(r["customer_sk"]), names[r["product_sk"]], days[r["date_sk"]][0].isoformat(),
                 r["quantity"], r["total_amount"])
                for r in facts.collect()
            )
        )
        assert {v[1:] for v in days.values()} == {(2024, 1, 2, 15), (2024, 1, 1, 10), (2024, 1, 3, 10)}
    assert results[0] == results[1] == [
        ("O001", None, "P001", "2024-02-15", 1, Decimal("800.00")),
        ("O002", ("C002", "Bangalore"), "P002", "2024-01-10", 1, Decimal("1800.00")),
        ("O003", ("C001", "Delhi"), "P001", "2024-03-10", 1, Decimal("800.00")),
    ]


@pytest.mark.parametrize(
    "moment, minutes, status",
    [("2024-04-01 11:00:59", 120, "OK"), ("2024-04-01 11:01:00", 121, "SLA_BREACH"), ("2024-04-01 08:00:00", 0, "OK")],
)
def test_freshness(spark, tmp_path, moment, minutes, status):
    from tidemark.operators import history, state

    dim = history.versions(customers(spark, tmp_path), history.History())
    row = state.freshness(dim, at(moment)).first()
    assert (row["freshness_minutes"], row["status"]) == (minutes, status)
    empty = state.freshness(dim.filter("false"), at(moment)).first()
    assert (empty["freshness_minutes"], empty["status"]) == (None, "NO_DATA")


def test_bad_rows_reach_the_dead_letters_and_not_the_mark(spark, wh, tmp_path):
    bad = CUSTOMERS + (
        "1005,,A,B,c@example.com,X,India,2024-03-30 09:00:00\n"
        "1006,C003,A,B,c@example.com,X,India,2024-05-01 09:00:00\n"
        "1007,,A,B,c@example.com,X,India,2024-06-01 09:00:00\n"
        ",C004,A,B,c@example.com,Y,India,2024-03-30 09:00:00\n"
    )
    state = run_batch(wh, customers(spark, tmp_path, bad), AS_OF, "r1")
    dead = wh.log(medallion.DEAD, Layout().events.add("dq_error_reason", "string").add("failed_at", "timestamp_ntz"))
    found = sorted((r["event_id"], r["dq_error_reason"]) for r in dead.collect())
    assert found == [
        (1005, "NULL_CUSTOMER_ID"), (1006, "FUTURE_TIMESTAMP"), (1007, "FUTURE_TIMESTAMP"), (1007, "NULL_CUSTOMER_ID"),
    ]
    assert state.marks == {"customer_pipeline": at("2024-04-01 09:00:00")}
    assert metrics(wh, "r1") == (8, 4, 5, 0)
    assert [row for row in dimension(wh) if row[0] != "C004"] == DIMENSION


def test_lookback_border_and_too_late_events(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    header = CUSTOMERS.splitlines()[0] + "\n"
    late = header + (
        "1008,C002,Priya,Sharma,priya@example.com,Agra,India,2024-03-25 09:00:00\n"
        "1009,C002,Priya,Sharma,priya@example.com,Kochi,India,2024-03-25 09:00:01\n"
    )
    run_batch(wh, feed(spark, tmp_path, late, schemas.CUSTOMER_FEED, "late.csv"), AS_OF, "r2")
    assert [row[1] for row in dimension(wh) if row[0] == "C002"] == ["Bangalore", "Kochi"]
    assert metrics(wh, "r2") == (3, 0, 3, 1)


def test_empty_batch_still_reports(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    nothing = spark.createDataFrame([], schemas.CUSTOMER_FEED)
    layout = Layout(lookback_days=0)
    run_batch(wh, nothing, at("2024-04-03 00:00:00"), "r2", layout)
    assert metrics(wh, "r2") == (0, 0, 0, 0)
    assert wh.log(medallion.SLA, schemas.SLA_LOG).filter("run_id = 'r2'").first()["status"] == "SLA_BREACH"
    assert dimension(wh) == DIMENSION


def test_empty_batch_may_be_skipped(spark, wh, tmp_path):
    skip = Layout(lookback_days=0, empty_batch="skip")
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1", skip)
    state = run_batch(wh, spark.createDataFrame([], schemas.CUSTOMER_FEED), at("2024-04-03 00:00:00"), "r2", skip)
    assert metrics(wh, "r1") == (4, 0, 4, 0)
    for log, kind in ((medallion.METRICS, schemas.RUN_METRICS), (medallion.SLA, schemas.SLA_LOG)):
        assert wh.log(log, kind).filter("run_id = 'r2'").isEmpty()
    assert dimension(wh) == DIMENSION and state.marks == {"customer_pipeline": at("2024-04-01 09:00:00")}


FUTURE = "1006,C003,A,B,c@example.com,X,India,2024-05-01 09:00:00\n"


@pytest.mark.parametrize("over, mark", [("valid", "2024-04-01 09:00:00"), ("all", "2024-05-01 09:00:00")])
def test_mark_over_valid_or_all_rows(spark, wh, tmp_path, over, mark):
    state = run_batch(wh, customers(spark, tmp_path, CUSTOMERS + FUTURE), AS_OF, "r1", Layout(mark_over=over))
    assert state.marks == {"customer_pipeline": at(mark)}
    assert dimension(wh) == DIMENSION


@pytest.mark.parametrize("source, cities", [("valid", ["Goa", "Bangalore"]), ("silver", ["Goa", "Bangalore", "X"])])
def test_late_customer_from_valid_events_or_silver(spark, wh, tmp_path, source, cities):
    layout = Layout(rebuild_from=source, collapse=False, lookback_days=3650)
    future = FUTURE.replace("C003", "C002")
    run_batch(wh, customers(spark, tmp_path, CUSTOMERS + future), AS_OF, "r1", layout)
    late = CUSTOMERS.splitlines()[0] + "\n1012,C002,Priya,Sharma,priya@example.com,Goa,India,2024-01-01 12:00:00\n"
    run_batch(wh, feed(spark, tmp_path, late, schemas.CUSTOMER_FEED, "late.csv"), AS_OF, "r2", layout)
    assert [row[1] for row in dimension(wh) if row[0] == "C002"] == cities


def test_switches_are_checked():
    with pytest.raises(ValueError, match="mark_over"):
        Layout(mark_over="every")
    with pytest.raises(ValueError, match="collapse"):
        Layout(rebuild_from="silver")


def test_same_time_events(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    header = CUSTOMERS.splitlines()[0] + "\n"
    same = header + (
        "1010,C002,Priya,Sharma,priya@example.com,Bangalore,India,2024-01-05 12:00:00\n"
        "1011,C001,Arun,Kumar,arun@example.com,Goa,India,2024-04-01 09:00:00\n"
    )
    state = run_batch(wh, feed(spark, tmp_path, same, schemas.CUSTOMER_FEED, "same.csv"), AS_OF, "r2")
    moment = at("2024-04-01 09:00:00")
    at_once = {row[1]: row[3:5] for row in dimension(wh) if row[2] == moment}
    assert at_once == {"Pune": (moment, False), "Goa": (None, True)}
    assert len([row for row in dimension(wh) if row[0] == "C002"]) == 1
    keys = wh.read(state, medallion.CUSTOMERS, Layout().dimension).select("customer_sk").collect()
    assert len(set(keys)) == len(keys)


def test_rebuild_keeps_surrogate_keys(spark, wh, tmp_path):
    def keys():
        df = wh.read(wh.state(), medallion.CUSTOMERS, Layout().dimension)
        assert df.filter(version_key("customer_id") != df.customer_sk).isEmpty()
        return {(r["customer_id"], r["start_date"]): r["customer_sk"] for r in df.collect()}

    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    before = keys()
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r2")
    assert keys() == before


def test_stream_picks_up_new_files_once(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    lines = CUSTOMERS.splitlines(keepends=True)
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    for name, rows in (("a.csv", lines[1::2]), ("b.csv", lines[2::2]), (None, None)):
        if name:
            (folder / name).write_text(lines[0] + "".join(rows))
        query = stream_feed(wh, str(folder), str(tmp_path / "offsets"), "customers", as_of=lambda: AS_OF)
        query.awaitTermination()
    assert dimension(wh) == DIMENSION
    assert wh.state().seq == 2


def test_second_publisher_of_a_state_starts_again(spark, wh, tmp_path, monkeypatch):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    stale = wh.state()
    wh.publish(stale, "other")
    with pytest.raises(Conflict):
        wh.publish(stale, "late")
    moved = CUSTOMERS.splitlines()[0] + "\n1005,C002,Priya,Sharma,priya@example.com,Goa,India,2024-03-31 10:00:00\n"
    read, states = Warehouse.state, [stale]
    monkeypatch.setattr(Warehouse, "state", lambda self, run=None: states.pop() if states else read(self, run))
    state = run_batch(wh, feed(spark, tmp_path, moved, schemas.CUSTOMER_FEED, "b.csv"), AS_OF, "r2")
    assert not states and state.seq == 3
    assert [row[1] for row in dimension(wh)] == ["Delhi", "Mumbai", "Pune", "Bangalore", "Goa"]


def test_a_run_is_known_after_later_ones_and_old_folders_go(spark, wh, tmp_path):
    for run in ("r1", "r2", "r3"):
        state = run_batch(wh, customers(spark, tmp_path), AS_OF, run)
    assert wh.state("r1").repeated and wh.state("r3").repeated and not wh.state("r4").repeated
    before = dimension(wh)
    gone = wh.vacuum(state)
    assert f"{medallion.SILVER}/run_id=r1" in gone and dimension(wh) == before
    assert wh.vacuum(state) == []


def test_changed_buckets_keep_one_current_version(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1", Layout(buckets=4))
    moved = CUSTOMERS.splitlines()[0] + "\n1005,C002,Priya,Sharma,priya@example.com,Goa,India,2024-03-31 10:00:00\n"
    run_batch(wh, feed(spark, tmp_path, moved, schemas.CUSTOMER_FEED, "b.csv"), AS_OF, "r2", Layout(buckets=8))
    assert [(row[0], row[1]) for row in dimension(wh) if row[4]] == [("C001", "Pune"), ("C002", "Goa")]


def test_missing_keys_stay_out_of_the_dimensions(spark, wh, tmp_path):
    run_batch(wh, customers(spark, tmp_path), AS_OF, "r1")
    orders = feed(spark, tmp_path, ORDERS + "O001,C001,P009,,2,10\nO001,C001,,2024-03-11 08:00:00,2,10\n", schemas.ORDER_FEED, "o.csv")
    products = feed(spark, tmp_path, PRODUCTS + ",Desk,Office,5\n", schemas.PRODUCT_FEED, "p.csv")
    counts = []
    for run in ("s1", "s2", "s3"):
        state = load_star(wh, orders, products, at("2024-04-02 00:00:00"), run)
        tables = ((medallion.PRODUCTS, schemas.DIM_PRODUCT), (medallion.DATES, schemas.DIM_DATE), (medallion.FACTS, schemas.FACT_SALES))
        counts.append([wh.read(state, name, schema).count() for name, schema in tables])
        keys = [r["sales_sk"] for r in wh.read(state, medallion.FACTS, schemas.FACT_SALES).collect()]
        assert len(set(keys)) == 5
    assert counts == [[2, 4, 5]] * 3
    dead = wh.log(medallion.DEAD_ORDERS, schemas.table(order_id="string", dq_error_reason="string")).filter("run_id = 's1'")
    assert [tuple(r)[:2] for r in dead.collect()] == [("O001", medallion.NULL_DATE)]


def test_rows_without_a_time_are_counted(spark, wh, tmp_path):
    bad = CUSTOMERS + "1005,C003,A,B,c@example.com,X,India,soon\n1006,C003,A,B,c@example.com,X,India,\n"
    run_batch(wh, customers(spark, tmp_path, bad), AS_OF, "r1")
    assert metrics(wh, "r1") == (6, 2, 4, 0)
    assert dimension(wh) == DIMENSION


def test_columns_are_found_by_name(spark, tmp_path):
    text = "price,extra,product_id\n5.50,x,P1\n"
    row = feed(spark, tmp_path, text, schemas.PRODUCT_FEED).first()
    assert tuple(row) == ("P1", None, None, Decimal("5.50"))


def test_new_checkpoint_loads_new_files(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    lines = CUSTOMERS.splitlines(keepends=True)
    wh = Warehouse(spark, str(tmp_path / "warehouse"))
    for n in (1, 2):
        (folder / f"{n}.csv").write_text(lines[0] + "".join(lines[n::2]))
        stream_feed(wh, str(folder), str(tmp_path / f"offsets{n}"), "customers", as_of=lambda: AS_OF).awaitTermination()
    assert dimension(wh) == DIMENSION


def test_corrupt_lines_are_kept_as_text(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(PRODUCTS + "P003,Desk,Office,cheap\n")
    rows = read_csv_feed(spark, str(path), schemas.PRODUCT_FEED, keep_corrupt=True).orderBy("product_id").collect()
    assert [row[CORRUPT] for row in rows] == [None, None, "P003,Desk,Office,cheap"]
    assert rows[2]["price"] is None
