"""Calendar helpers: day strings, partition names, date spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The naming scheme of day partitions, for writing and for recognising.
PARTITION_NAME_FORMAT = "'trip_events_y'yyyy'_m'MM'_d'dd"
PARTITION_NAME_PATTERN = r"^trip_events_y(\d{4})_m(\d{2})_d(\d{2})\z"


def parse_day(text: str) -> dt.date:
    """Strict ``YYYY-MM-DD``."""
    day = dt.datetime.strptime(text, "%Y-%m-%d").date()
    if day.isoformat() != text:
        raise ValueError(f"not a YYYY-MM-DD day: {text!r}")
    return day


def yesterday_utc(now: dt.datetime | None = None) -> dt.date:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.astimezone(dt.timezone.utc).date() - dt.timedelta(days=1)


def run_days(
    day: str | None = None, start: str | None = None, end: str | None = None, now: dt.datetime | None = None
) -> list[dt.date]:
    """Days of a run: one day, an inclusive range, or yesterday (UTC) when nothing is given."""
    if (start is None) != (end is None):
        raise ValueError("a range needs both its start and its end")
    if day is not None and start is not None:
        raise ValueError("give one day or a range, not both")
    if start is not None:
        first, last = parse_day(start), parse_day(end)
        if last < first:
            raise ValueError(f"the range ends ({end}) before it starts ({start})")
        return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    return [parse_day(day) if day is not None else yesterday_utc(now)]


def date_spine(spark: SparkSession, first: dt.date, last: dt.date, name: str = "event_date") -> DataFrame:
    """Every day from ``first`` to ``last``, both included."""
    days = (last - first).days + 1
    return spark.range(max(days, 0)).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias(name)
    )


def partition_name(day: Column) -> Column:
    return F.date_format(day, PARTITION_NAME_FORMAT)


def partition_date(name: Column) -> Column:
    """Day of a partition name; NULL for any other name, the catch-all and impossible days included."""
    digits = [F.regexp_extract(name, PARTITION_NAME_PATTERN, i) for i in (1, 2, 3)]
    return F.when(
        name.rlike(PARTITION_NAME_PATTERN), F.try_to_date(F.concat_ws("-", *digits), "yyyy-MM-dd")
    )


def days_since_epoch(day: Column) -> Column:
    return F.unix_date(day)
