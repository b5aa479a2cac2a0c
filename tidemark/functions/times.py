"""Timestamp arithmetic shared by the loaders."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

LOOKBACK_DAYS = 7
MICROS_PER_MINUTE = 60_000_000
FIRST_MARK = datetime(1900, 1, 1)


def ntz(moment: datetime) -> Column:
    """Zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(moment: Column, days: int = LOOKBACK_DAYS) -> Column:
    return moment - F.make_dt_interval(days=F.lit(days))


def micros(moment: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, whatever the session zone."""
    seconds = (moment - F.expr("timestamp_ntz'1970-01-01 00:00:00'")).cast("interval second")
    return (seconds.cast("decimal(20,6)") * 1_000_000).cast("bigint")


def day_start(moment: Column) -> Column:
    return F.to_date(moment).cast("timestamp_ntz")


def stale_minutes(latest: Column, now: Column) -> Column:
    """Whole minutes from `latest` to `now`, never negative."""
    passed = F.greatest(micros(now) - micros(latest), F.lit(0))
    return F.floor(F.when(latest.isNotNull(), passed) / MICROS_PER_MINUTE)


def calendar(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
    }
