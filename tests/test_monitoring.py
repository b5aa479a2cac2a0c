"""Prefix sums, sweep line, breach episodes, sketches and observed counts on small frames."""

import random
from collections import Counter
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.functions.times import ntz
from tidemark.operators import history, monitoring, quality, state
from tidemark.operators.skew import prefix_sum
from tidemark.streaming.latest import late_rows, read_latest, state_rows, stream_latest

DAY = datetime(2024, 1, 1)


def test_prefix_sum_over_several_ranges(spark):
    rng = random.Random(1)
    rows = [(n, rng.randint(-5, 9)) for n in rng.sample(range(10_000), 2_000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = {r["n"]: r["total"] for r in prefix_sum(spark.createDataFrame(rows, "n int, v int"), ["n"], "v", "total").collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    total, expected = 0, {}
    for n, v in sorted(rows):
        expected[n] = total = total + v
    assert found == expected


def test_versions_of_each_day(spark):
    rng = random.Random(2)
    at = lambda: DAY + timedelta(hours=rng.randrange(24 * 40))
    rows = [(at(), rng.choice([None, at()])) for _ in range(200)]
    rows = [(a, b) for a, b in rows if b is None or a <= b] + [(DAY, DAY), (None, DAY)]
    dim = spark.createDataFrame(rows, "start_date timestamp_ntz, end_date timestamp_ntz")
    found = {r["day"]: r["versions"] for r in history.valid_per_day(dim).collect()}
    for day, n in found.items():
        moment = datetime(day.year, day.month, day.day)
        assert n == sum(a is not None and a <= moment and (b is None or moment < b) for a, b in rows)
    assert len(found) == (max(found) - min(found)).days + 1 >= 35
    assert history.valid_per_day(dim.limit(0)).count() == 0


def test_breach_episodes(spark):
    checks = [("a", n, s, m) for n, (s, m) in enumerate([("SLA_BREACH", 5), ("SLA_BREACH", 9), ("OK", 1), ("NO_DATA", None), ("SLA_BREACH", 7)])]
    checks += [("b", 0, "OK", 1), ("b", 1, "SLA_BREACH", 3), ("b", 2, "OK", 1)]
    rows = [(p, DAY + timedelta(days=n), s, m) for p, n, s, m in checks]
    df = spark.createDataFrame(rows, "pipeline_name string, check_time timestamp_ntz, status string, freshness_minutes long")
    found = monitoring.breach_episodes(df).drop("first_breach").orderBy("pipeline_name", "episode").collect()
    day = lambda n: DAY + timedelta(days=n)
    assert [tuple(r) for r in found] == [("a", 1, day(1), 2, 9, False), ("a", 2, day(4), 1, 7, True), ("b", 1, day(1), 1, 3, False)]


def test_merged_sketches_like_whole_ones(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 10).cast("int").alias("run"), (F.xxhash64("id") % 4_000).cast("string").alias("customer"), (F.col("id") % 1_000).alias("delay")
    )
    parts = monitoring.merged_sketches(monitoring.run_sketches(rows, "run", "customer", "delay"), F.lit("all")).first()
    whole = monitoring.merged_sketches(monitoring.run_sketches(rows.withColumn("run", F.lit(0)), "run", "customer", "delay"), F.lit("all")).first()
    exact = rows.select("customer").distinct().count()
    assert parts["rows"] == whole["rows"] == 30_000
    assert abs(parts["customers"] - exact) < 0.05 * exact and abs(parts["customers"] - whole["customers"]) < 0.05 * exact
    assert all(abs(r["delay_p50"] - 500) < 40 and abs(r["delay_p95"] - 950) < 40 for r in (parts, whole))


def test_cube_of_failures(spark):
    rows = [("r1", DAY), ("r1", DAY + timedelta(hours=3)), ("r2", DAY + timedelta(days=1)), ("r2", None)]
    dead = spark.createDataFrame(rows, f"{quality.REASON} string, event_time timestamp_ntz")
    found = Counter((r["level"], r[quality.REASON], r["failures"]) for r in monitoring.failures_by_reason_and_day(dead).collect())
    assert found == Counter({(3, None, 4): 1, (1, "r1", 2): 1, (1, "r2", 2): 1, (0, "r1", 2): 1, (0, "r2", 1): 2, (2, None, 2): 1, (2, None, 1): 2})


def test_observed_counts_like_counted_ones(spark, tmp_path):
    rows = [(n, None if n % 5 == 0 else f"c{n % 3}", None if n % 11 == 0 else DAY + timedelta(days=n % 30)) for n in range(200)]
    df = spark.createDataFrame(rows, "event_id int, customer_id string, event_time timestamp_ntz").repartition(7)
    rules = quality.standard_rules(ntz(DAY + timedelta(days=20)))
    mark = ntz(DAY + timedelta(days=15))
    flagged = quality.flag(df, rules, unique_ids=True)
    expected = state.run_metrics(flagged, state.too_late(df, mark), DAY).first()
    counted, counts = state.counting_run(flagged)
    late, missed = state.counting_late(df, mark)
    counted.write.parquet(str(tmp_path / "a"))
    late.write.parquet(str(tmp_path / "b"))
    assert state.observed_metrics(spark, counts, missed, DAY).first() == expected


def test_stateful_stream_drops_counts_and_forgets(spark, tmp_path):
    """Ten days, a day at a time, with a delay of two days: late rows are counted, old days leave the state."""
    kind = "event_id string, city string, event_time timestamp_ntz, arrival_ts timestamp_ntz"
    days = [[(f"{d}-{n}", "x", DAY + timedelta(days=d, hours=n % 20), DAY + timedelta(days=d)) for n in range(30)] for d in range(10)]
    days[9] += [(f"late-{n}", "x", DAY + timedelta(hours=n), DAY + timedelta(days=9)) for n in range(4)]
    days[5] += [("5-1", "moved", DAY + timedelta(days=5, hours=1), DAY + timedelta(days=6)), (None, "a", DAY + timedelta(days=5), DAY)]
    late, last = 0, 0
    for rows in days:
        spark.createDataFrame(rows, kind).write.mode("append").parquet(str(tmp_path / "feed"))
        feed = spark.readStream.schema(kind).parquet(str(tmp_path / "feed"))
        query = stream_latest(feed, str(tmp_path / "out"), str(tmp_path / "checkpoint"), delay_days=2)
        query.awaitTermination()
        late, last = late + late_rows(query), state_rows(query)
    found = read_latest(spark, str(tmp_path / "out"), ["event_id", "city", "event_time", "arrival_ts"]).collect()
    # Rows dropped are counted after they are combined in their task, so no more than there were.
    assert 0 < late <= 4 and len(found) == 301 and 30 <= last <= 4 * 30
    assert {r["event_id"]: r["city"] for r in found}["5-1"] == "moved" and not any((r["event_id"] or "").startswith("late") for r in found)
