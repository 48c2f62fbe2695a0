"""Named queries over the given tables and, where one exists, the same question in ANSI SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.plans.jobs import backfill, curate_days
from daybook.schemas import TRIP_EVENTS, TRIP_EVENTS_CURATED
from daybook.sources.events import FrameSource
from daybook.sources.given import view, view_sql
from daybook.tables.daytable import DayTable
from daybook.tables.storage import scratch_folder

TODAY = dt.date(2024, 1, 31)
AS_OF = dt.datetime(2024, 1, 31)
SINCE = dt.date(2024, 1, 15)
DAY = dt.date(2024, 1, 15)
NOW = dt.datetime(2024, 1, 31, 3, 0, tzinfo=dt.timezone.utc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query; ``views`` names the mapped tables its SQL reads."""

    def register(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_views(sql, *views.split())
        return run

    return register


def with_views(sql: str, *names: str) -> str:
    if not names:
        return sql
    ctes = ", ".join(f"{n} AS ({view_sql(n)})" for n in names)
    return f"WITH {ctes} {sql}"


def trips(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "trip_events")


def day_range(rows: DataFrame) -> list[dt.date]:
    """Every day from the first to the last that has rows."""
    first, last = rows.agg(F.min("event_date"), F.max("event_date")).first()
    return [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]


class SampleLake:
    """A lake in its own scratch folder."""

    def __init__(self, spark: SparkSession, label: str = "lake"):
        self.spark = spark
        self.root = scratch_folder(spark, label)
        self.raw = DayTable(spark, f"{self.root}/raw/trip_events", TRIP_EVENTS)
        self.curated = DayTable(spark, f"{self.root}/curated/trip_events_curated", TRIP_EVENTS_CURATED)

    def load_raw(self, rows: DataFrame) -> SampleLake:
        """Put rows into raw as one commit."""
        self.raw.create(NOW)
        self.raw.replace_days(rows, day_range(rows), now=NOW)
        return self

    def backfill(self, rows: DataFrame) -> SampleLake:
        backfill(self.spark, FrameSource(rows, TRIP_EVENTS), self.raw, self.root, day_range(rows), now=NOW)
        return self

    def curate(self) -> SampleLake:
        curate_days(self.spark, self.raw, self.curated, self.root, sorted(self.raw.days()), now=NOW)
        return self


_shared: dict[tuple[str, str], SampleLake] = {}


def loaded(spark: SparkSession, sf: str) -> SampleLake:
    """Fresh lake with all trips in raw, for queries that change it."""
    return SampleLake(spark).load_raw(trips(spark, sf))


def exported(spark: SparkSession, sf: str) -> SampleLake:
    """Lake with all trips exported and curated; queries that only read it share one."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _shared:
        _shared[key] = SampleLake(spark).backfill(trips(spark, sf)).curate()
    return _shared[key]


def frequent_vehicle(rows: DataFrame) -> DataFrame:
    """The vehicle with most trips, as a one-row key table."""
    counts = rows.groupBy("vehicle_id_hash").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "vehicle_id_hash").limit(1).select("vehicle_id_hash")


FREQUENT_SQL = (
    "(SELECT vehicle_id_hash FROM trip_events GROUP BY vehicle_id_hash "
    "ORDER BY count(*) DESC, vehicle_id_hash LIMIT 1)"
)
