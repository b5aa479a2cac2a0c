"""Facts take no more disk than a step needs: shuffle files go, keys move as bytes, rows are counted where they lie."""

import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.keys import moved, packed, unpacked, with_grouped_key
from tidemark.operators import history, star
from tidemark.operators.skew import settle
from tidemark.plans import medallion
from tidemark.sources.warehouse import PART, Warehouse

DAY = datetime(2024, 1, 1)
LAYOUT = medallion.Layout(
    feed=schemas.table(event_id="long", customer_id="long", city="string", event_time="timestamp_ntz"),
    spec=history.History(tracked=("city",)),
    buckets=3,
)


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for n in range(files.size()) if (name := files.apply(n).getName()).startswith("shuffle_")}


def gone(spark, before):
    """Whether all shuffle files that are not among `before` go within a while; Spark removes them beside the run."""
    for _ in range(40):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.25)
    return False


def dimension(spark, rows):
    dim = spark.createDataFrame(rows, "customer_id long, start_date timestamp_ntz, end_date timestamp_ntz, customer_sk string")
    return schemas.select_to_schema(dim, LAYOUT.dimension)


def publish(wh, dim, run):
    state = wh.state()
    written = wh.write_parts(dim.withColumn(PART, LAYOUT.bucket()), medallion.CUSTOMERS, run)
    return wh.publish(state.replaced(medallion.CUSTOMERS, state.parts(medallion.CUSTOMERS), written, run), run)


def sales(spark, n=300):
    rows = [
        (f"o{i % 250}", i % 13 if i % 29 else None, i % 17 if i % 31 else None, DAY + timedelta(days=i % 90) if i % 37 else None, i % 5 + 0.4, i + 0.126)
        for i in range(n)
    ]
    return rows, spark.createDataFrame(
        rows, "order_id string, customer_id long, product_id long, order_date timestamp_ntz, quantity double, total_amount double"
    )


def test_written_steps_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    df = spark.range(5000).select("id", F.md5(F.col("id").cast("string")).alias("m"))
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(setting)
    written = settle(df.repartition(5, "m"))
    wh = Warehouse(spark, str(tmp_path))
    wh.write_parts(df.withColumn(PART, (F.col("id") % 3).cast("string")), "t", "r1")
    wh.stage(df.repartition(3, "id"), "step", "r1")
    wh.append(df.repartition(3, "m"), "log", "r1")
    assert gone(spark, before) and spark.conf.get(setting) == kept and written.count() == 5000


def test_loaded_facts_are_whole_and_leave_no_steps(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    rows, orders = sales(spark)
    spans = [(c, DAY + timedelta(days=d), DAY + timedelta(days=d + 30), f"{c}-{d}") for c in range(11) for d in (5, 35)]
    publish(wh, dimension(spark, spans), "r0")
    products = spark.createDataFrame([(f"{n}", "p", "c", None) for n in range(15)], schemas.PRODUCT_FEED)
    state = medallion.load_star(wh, orders, products, DAY, "r1", LAYOUT, how="running")
    assert not wh._names("_staged")
    found = wh.read(state, medallion.FACTS, schemas.FACT_SALES).collect()
    version = lambda c, at: next((v[3] for v in spans if v[0] == c and at and v[1] <= at < v[2]), None)
    product = {row["product_id"]: row["product_sk"] for row in wh.read(state, medallion.PRODUCTS, schemas.DIM_PRODUCT).collect()}
    key = lambda at: at and at.year * 10000 + at.month * 100 + at.day
    expected = Counter((o, version(c, at), product.get(str(p)), key(at), int(q), f"{round(t, 2):.2f}") for o, c, p, at, q, t in rows)
    assert Counter((r[1], r[2], r[3], r[4], r[5], f"{r[6]:.2f}") for r in found) == expected
    assert sorted(int(r["sales_sk"]) for r in found) == list(range(1, len(rows) + 1))


ODD = ["", "a", "0123456789abcdef", "0" * 32, "F" * 32, "f" * 31 + "g", "f" * 32, "f" * 32 + "\n", "é" * 8, "0" * 33, "\0" * 17, None]


def test_packed_keys_come_back(spark):
    df = spark.createDataFrame([(k,) for k in ODD], "k string")
    found = df.select("k", packed("k").alias("p")).select("k", "p", unpacked("p").alias("back")).collect()
    assert all(r["k"] == r["back"] for r in found) and len({r["p"] and bytes(r["p"]) for r in found}) == len(ODD)
    assert {len(r["p"]) for r in found if r["k"] in ("0" * 32, "f" * 32)} == {16}
    assert moved(spark.createDataFrame([(1,)], "k long"), "k").dtypes == [("k", "bigint")]


@pytest.mark.parametrize("keys", ["string", "long"])
def test_joined_facts_move_keys_as_bytes(spark, keys):
    """Keys that are text are bytes where the facts are written, and text again in the facts; other keys stay."""
    rows, orders = sales(spark, 60)
    customers = spark.createDataFrame([(c, DAY, None, c + 100) for c in range(9)], "customer_id long, start_date timestamp_ntz, end_date timestamp_ntz, customer_sk long")
    customers = customers.withColumn("customer_sk", F.col("customer_sk").cast(keys))
    products = star.product_rows(spark.createDataFrame([(n, "p") for n in range(15)], "product_id long, product_name string"))
    dates = star.date_rows(star.order_dates(orders))
    written = []
    facts = star.numbered_facts(
        orders, customers, products, dates, ("order_id",), "running", lambda df: (written.append(dict(df.dtypes)), settle(df))[1]
    )
    assert written[0]["customer_sk"] == ("binary" if keys == "string" else "bigint") and written[0]["product_sk"] == "binary"
    plain = star.sales_facts(orders, customers, products, dates, ("order_id",), "range")
    assert dict(plain.dtypes)["customer_sk"] == ("string" if keys == "string" else "bigint")
    assert Counter(facts.drop("sales_sk").collect()) == Counter(plain.collect())
    assert sorted(r["sales_sk"] for r in facts.select("sales_sk").collect()) == list(range(1, 61))


def test_numbers_of_days_with_very_many_rows(tight):
    """A day, or no day, with more rows than hotRows is numbered in slices; equal rows get numbers of their own."""
    rows = [(None if n % 3 == 0 else 20240101 if n % 3 == 1 else 20240102 + n % 50, n % 40) for n in range(600)]
    written = settle(tight.createDataFrame(rows, "date_sk int, v int"))
    numbered = with_grouped_key(written, ["date_sk", "v"], "n")
    found = numbered.orderBy("n").collect()
    assert [r["n"] for r in found] == list(range(1, 601)) and Counter((r["date_sk"], r["v"]) for r in found) == Counter(rows)
    days = [r["date_sk"] or 0 for r in found]
    assert days == sorted(days)


def test_changed_windows_compare_keys_of_any_kind(spark):
    spec = history.History(tracked=("city",))
    old = [(1, DAY, None, k) for k in ODD]
    schema = "customer_id long, start_date timestamp_ntz, end_date timestamp_ntz, customer_sk string"
    new = [*old[:-2], (2, DAY, None, "f" * 32)]
    found = history.changed_windows(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema), spec, "customer_sk")
    assert {r["customer_id"] for r in found.collect()} == {1, 2}
