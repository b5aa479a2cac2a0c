"""Single operators on small frames, with brute-force answers."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions.hashing import hash_diff
from tidemark.functions.keys import with_dense_key
from tidemark.functions.times import FIRST_MARK, ntz
from tidemark.operators import quality, star, state
from tidemark.operators.dedup import latest_per_key, latest_per_key_by_max
from tidemark.operators.intervals import Buckets, choose_buckets, join_valid
from tidemark.operators.skew import Ordered, hot_keys, join_lookup
from tidemark.operators.temporal import join_as_of
from tidemark.schemas import select_to_schema, table
from tidemark.session import shared_root
from tidemark.sources import jdbc

DAY = datetime(2024, 1, 1)


@pytest.fixture
def limits(spark):
    spark.conf.set("spark.tidemark.hotRows", "50")
    spark.conf.set("spark.tidemark.broadcastRows", "3")
    yield spark
    spark.conf.unset("spark.tidemark.hotRows")
    spark.conf.unset("spark.tidemark.broadcastRows")


def skewed(n=900, seed=5):
    """A third of the rows under key 0, and a third without a key."""
    rng = random.Random(seed)
    return [(i, rng.choice([0, None, rng.randint(1, 40)]), rng.randint(0, 20)) for i in range(n)]


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_lookup_with_a_hot_key_and_missing_keys(limits, how):
    big = limits.createDataFrame(skewed(), "id int, k int, v int")
    lookup = limits.createDataFrame([(k, f"n{k}") for k in range(0, 40, 3)], "k int, name string")
    assert [row.k for row in hot_keys(big, "k").keys.collect()] == [0]
    limits.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    split = join_lookup(big, lookup, "k", how)
    plain = big.join(lookup, "k", how)
    assert split.columns == plain.columns or set(split.columns) == set(plain.columns)
    limits.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    order = sorted(plain.columns)
    assert sorted(split.select(order).collect(), key=repr) == sorted(plain.select(order).collect(), key=repr)


def test_ordered_pass_over_split_keys(limits):
    rng = random.Random(3)
    rows = [(i, 0 if i % 3 else i % 7, rng.randint(0, 30), rng.choice([None, i])) for i in range(600)]
    df = limits.createDataFrame(rows, "id int, k int, t int, v int")
    done = Ordered.by(df, "k", ("t", "id")).previous("id", "before").following("id", "after").latest("v", "held")
    assert done.split
    found = {r["id"]: (r["before"], r["after"], r["held"]) for r in done.frame().collect()}
    expected = {}
    for key in {row[1] for row in rows}:
        line = sorted((row for row in rows if row[1] == key), key=lambda r: (r[2], r[0]))
        held = None
        for i, row in enumerate(line):
            held = row[3] if row[3] is not None else held
            expected[row[0]] = (
                line[i - 1][0] if i else None, line[i + 1][0] if i + 1 < len(line) else None, held,
            )
    assert found == expected


def test_join_as_of_with_one_hot_moment(limits):
    """A hot key whose facts are all equal: they are cut into several segments."""
    at = lambda day: DAY + timedelta(days=day)
    versions = [("a", at(n), at(n + 1) if n < 3 else None, n) for n in range(4)] + [("b", at(0), None, 9)]
    facts = [("a", at(2))] * 400 + [("a", at(-1)), ("b", at(5)), (None, at(1))]
    found = join_as_of(
        limits.createDataFrame(facts, "k string, t timestamp_ntz"),
        limits.createDataFrame(versions, "k string, start_date timestamp_ntz, end_date timestamp_ntz, n int"),
        "k", "t", ["n"], "running",
    )
    counts = {(row["k"], row["n"]): row["count"] for row in found.groupBy("k", "n").count().collect()}
    assert counts == {("a", 2): 400, ("a", None): 1, ("b", 9): 1, (None, None): 1}
    split = Ordered.by(limits.createDataFrame(facts, "k string, t timestamp_ntz"), "k", ("t",))
    sizes = split.rows.filter("_segment > 0").groupBy("_segment").count().collect()
    assert len(sizes) > 5 and max(row["count"] for row in sizes) < 200


@pytest.mark.parametrize("limit", ["3", "200000"])
@pytest.mark.parametrize("how", ["auto", "range", "running", "buckets"])
def test_join_as_of_with_overlaps(spark, how, limit):
    rng, at = random.Random(9), lambda day: DAY + timedelta(days=day)
    versions = [(rng.choice("abcd"), rng.choice([at(rng.randint(0, 9)), None]), rng.choice([at(rng.randint(0, 12)), None]), n) for n in range(40)]
    versions += [("e", at(n), at(n + 1), 100 + n) for n in range(5)] + [(None, at(0), None, 200)]
    facts = [(n, rng.choice(["a", "b", "c", "d", "e", "f", None]), rng.choice([at(rng.randint(0, 13)), None])) for n in range(300)]
    spark.conf.set("spark.tidemark.broadcastRows", limit)
    try:
        found = join_as_of(
            spark.createDataFrame(facts, "n int, k string, t timestamp_ntz"),
            spark.createDataFrame(versions, "k string, start_date timestamp_ntz, end_date timestamp_ntz, v int"),
            "k", "t", ["v"], how,
        ).collect()
    finally:
        spark.conf.unset("spark.tidemark.broadcastRows")
    expected = []
    for n, k, t in facts:
        valid = [v for key, a, b, v in versions if key == k and k and t and a and a <= t and (b is None or t < b)]
        expected += [(n, v) for v in valid or [None]]
    assert sorted(((r["n"], r["v"]) for r in found), key=repr) == sorted(expected, key=repr)


def overlapping_case(spark, hot):
    """Windows of 1 to 60 days, some without end, of one hot key and 20 others."""
    rng, at = random.Random(3), lambda day: DAY + timedelta(days=day)
    windows = [(rng.choice([0, k]), at(d), rng.choice([at(d + rng.randint(1, 60)), None]), n) for n, (k, d) in enumerate((rng.randrange(20), rng.randrange(700)) for _ in range(400))]
    facts = [(0 if n % 3 < hot else rng.randrange(25), at(rng.randint(-30, 800))) for n in range(3000)]
    return (
        spark.createDataFrame(facts, "k int, t timestamp_ntz"),
        spark.createDataFrame(windows, "k int, start_date timestamp_ntz, end_date timestamp_ntz, v int"),
    )


@pytest.mark.parametrize("width", [1, 24, 24 * 10_000])
def test_time_buckets_of_any_width(spark, width):
    facts, windows = overlapping_case(spark, 1)
    chosen = choose_buckets(facts, windows, "k", "t")
    hour = 3_600_000_000
    found = join_valid(facts, windows, "k", "t", ["v", "end_date"], Buckets(chosen.first, chosen.last, width * hour))
    usual = join_valid(facts, windows, "k", "t", ["v", "end_date"])
    held = (F.col("start_date") <= F.col("t")) & (F.col("end_date").isNull() | (F.col("t") < F.col("end_date")))
    plain = facts.alias("f").join(windows.alias("w"), (F.col("f.k") == F.col("w.k")) & held, "left").select("f.k", "t", "v", "end_date")
    assert Counter(found.collect()) == Counter(usual.collect()) == Counter(plain.collect())


def test_time_buckets_split_a_hot_key(spark):
    """The join is on key and bucket, never on the key alone, and a hot key has many buckets."""
    facts, windows = overlapping_case(spark, 2)
    chosen = choose_buckets(facts, windows, "k", "t")
    assert (chosen.last - chosen.first) // chosen.width >= 10
    plan = join_valid(facts, windows, "k", "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "SortMergeJoin [k" in joins[0] and "_bucket" in joins[0]


def test_time_buckets_without_times(spark):
    facts = spark.createDataFrame([(1, None), (None, DAY)], "k int, t timestamp_ntz")
    windows = spark.createDataFrame([(1, DAY, None, 5)], "k int, start_date timestamp_ntz, end_date timestamp_ntz, v int")
    assert sorted(map(tuple, join_valid(facts, windows, "k", "t", ["v"]).collect()), key=repr) == [(1, None, None), (None, DAY, None)]
    assert join_valid(facts.limit(0), windows, "k", "t", ["v"]).count() == 0


def test_neighbours_may_be_null(limits):
    rows = [(0, t, None if t % 3 else t) for t in range(200)]
    df = limits.createDataFrame(rows, "k int, t int, v int")
    done = Ordered.by(df, "k", ("t",), unique=True).previous("v", "before").following("v", "after")
    assert done.split
    value = lambda t: t if 0 <= t < 200 and t % 3 == 0 else None
    assert all((r["before"], r["after"]) == (value(r["t"] - 1), value(r["t"] + 1)) for r in done.frame().collect())


@pytest.mark.parametrize("how", ["auto", "range", "running", "buckets"])
def test_join_as_of(spark, how):
    at = lambda hour: DAY + timedelta(hours=hour)
    versions = [
        ("a", at(1), at(3), "a1"), ("a", at(3), at(3), "zero"), ("a", at(3), at(6), "a3"), ("a", at(6), None, "a6"),
        ("b", at(2), at(4), "b2"),
    ]
    facts = [(n, key, hour) for n, (key, hour) in enumerate(
        [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("a", 6), ("a", 9), ("b", 3), ("b", 4), ("c", 3), (None, 3), ("a", None)]
    )]
    facts = [(n, key, None if hour is None else at(hour)) for n, key, hour in facts]
    found = join_as_of(
        spark.createDataFrame(facts, "n int, k string, t timestamp_ntz"),
        spark.createDataFrame(versions, "k string, start_date timestamp_ntz, end_date timestamp_ntz, name string"),
        "k", "t", ["name"], how,
    )
    names = [row["name"] for row in found.orderBy("n").collect()]
    assert names == [None, "a1", "a1", "a3", "a6", "a6", "b2", None, None, None, None]


@pytest.mark.parametrize("pick", [latest_per_key, latest_per_key_by_max])
def test_latest_per_key_with_missing_values(spark, pick):
    rows = [(1, 5, "x"), (1, 7, "y"), (1, None, "z"), (2, None, "p"), (None, 1, "n"), (None, 2, "m"), (3, 4, "a"), (3, 4, "b")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    assert sorted(map(tuple, pick(df, ["k"], ["t"]).collect()), key=repr) == sorted(
        [(1, 7, "y"), (2, None, "p"), (None, 2, "m"), (3, 4, "b")], key=repr
    )


def quality_case(spark):
    rows = [
        (1, "a", DAY), (2, None, DAY), (3, "a", DAY + timedelta(days=9)), (4, None, DAY + timedelta(days=9)),
        (5, "a", DAY), (5, "b", DAY), (6, "a", DAY), (6, None, DAY), (None, "a", DAY), (None, None, DAY), (7, "a", None),
    ]
    df = spark.createDataFrame(rows, "event_id int, customer_id string, event_time timestamp_ntz")
    return df, quality.standard_rules(ntz(DAY + timedelta(days=1)))


def test_flagging_equals_the_rule_by_rule_form(spark):
    df, rules = quality_case(spark)
    flagged = quality.flag(df, rules)
    key = lambda row: repr(sorted(row.asDict().items(), key=str))
    one_pass = quality.dead_letters(flagged).collect()
    assert sorted(map(key, one_pass)) == sorted(map(key, quality.violations(df, rules).collect()))
    assert len(one_pass) == 10
    valid = quality.valid_rows(flagged).select("event_id", "customer_id").collect()
    assert sorted(map(tuple, valid), key=repr) == sorted([(1, "a"), (None, "a"), (7, "a")], key=repr)
    leaking = quality.valid_rows(quality.flag(df, rules, null_id="leak"))
    assert leaking.count() == 4


def test_hash_of_missing_values(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    plain = df.select(hash_diff(["x", "y", "z"])).distinct().count()
    safe = df.select(hash_diff(["x", "y", "z"], null_safe=True)).distinct().count()
    assert (plain, safe) == (1, 2)


def test_dense_key(spark):
    values = random.Random(1).sample(range(10_000), 700)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    numbered = with_dense_key(df, ["v"], "n", partitions=9)
    assert [row["n"] for row in numbered.orderBy("v").collect()] == list(range(1, 701))


def test_marks(spark):
    marks = spark.createDataFrame([("p", DAY)], "pipeline_name string, last_processed_ts timestamp_ntz")
    assert state.read_mark(marks, "p") == DAY
    assert state.read_mark(marks, "other") == FIRST_MARK
    older = spark.createDataFrame([(DAY - timedelta(days=3),)], "event_time timestamp_ntz")
    assert state.read_mark(state.advanced_marks(marks, older, "p"), "p") == DAY


def test_select_to_schema_fills_defaults(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("1", None), ("2", False)], "n string, is_current boolean")
    schema = table(n="long", is_current="boolean", created_at="timestamp_ntz", note="string")
    done = select_to_schema(df, schema, {"is_current": F.lit(True), "created_at": ntz(DAY)})
    assert [tuple(row) for row in done.collect()] == [(1, True, DAY, None), (2, False, DAY, None)]
    assert done.schema.fieldNames() == schema.fieldNames()


class FakeReader:
    """Stands in for a JDBC source: records the calls and answers the bounds query."""

    def __init__(self, spark, bounds):
        self.spark, self.bounds, self.calls = spark, bounds, []
        self.read = self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        if "bounds" in table:
            return self.spark.createDataFrame([self.bounds], "low int, high int")
        return self.spark.createDataFrame([(1, DAY)], "id int, at timestamp")


def test_jdbc_scan_is_split_by_the_range_of_its_column(spark):
    source = FakeReader(spark, (5, 90))
    df = jdbc.read_table(source, "jdbc:x", "t", {"user": "u"}, "id", 8)
    options = source.calls[1][1]
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("5", "90", 8)
    assert dict(df.dtypes)["at"] == "timestamp_ntz"
    empty = FakeReader(spark, (None, None))
    jdbc.read_table(empty, "jdbc:x", "t", {}, "id", 8)
    assert "numPartitions" not in empty.calls[1][1]


def test_shared_root_is_the_configured_folder(spark):
    assert shared_root(spark) == shared_root(spark)


def test_facts_are_numbered_by_date(spark):
    """Months lie together in the numbered rows, whose writer need not gather them again."""
    rows = [(f"o{n % 97}", 20240000 + 100 * (n % 5 + 1) + n % 3 if n % 11 else None, n % 2) for n in range(400)]
    facts = spark.createDataFrame(rows, "order_id string, date_sk int, quantity int")
    found = star.with_fact_key(facts).orderBy("sales_sk").collect()
    assert [r["sales_sk"] for r in found] == list(range(1, 401))
    dates = [r["date_sk"] or 0 for r in found]
    assert dates == sorted(dates) and Counter((r["order_id"], r["date_sk"], r["quantity"]) for r in found) == Counter(rows)


@pytest.mark.parametrize("key, time", [("int", "timestamp_ntz"), ("long", "date"), ("int", "date")])
def test_running_join_keeps_columns_and_types(spark, key, time):
    """Key and time come back in their place and type, whether versions have the same type or not."""
    rows = [(n, n % 3 if n % 7 else None, DAY + timedelta(days=n) if n % 5 else None) for n in range(30)]
    facts = spark.createDataFrame(rows, "n int, k int, at timestamp_ntz")
    facts = facts.select("n", F.col("k").cast(key).alias("k"), F.col("at").cast(time).alias("at"))
    spans = [(k, DAY + timedelta(days=d), DAY + timedelta(days=d + 6), f"{k}-{d}") for k in range(3) for d in range(0, 24, 6)]
    versions = spark.createDataFrame(spans, "k int, start_date timestamp_ntz, end_date timestamp_ntz, name string")
    found = join_as_of(facts, versions, "k", "at", ["name"], "running")
    assert found.schema.names == [*facts.columns, "name"]
    assert [f.dataType for f in found.schema][:3] == [f.dataType for f in facts.schema]
    name = lambda k, at: next((v[3] for v in spans if v[0] == k and at is not None and v[1] <= at < v[2]), None)
    assert {(r["n"], r["name"]) for r in found.collect()} == {(n, name(k, at)) for n, k, at in rows}
    assert sorted(map(str, found.drop("name").collect())) == sorted(map(str, facts.collect()))
