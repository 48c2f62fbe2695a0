"""Where the tables of a lake live: ``<lake>/<zone>/<table>``."""

from __future__ import annotations

from pyspark.sql import SparkSession

from daybook import schemas
from daybook.schemas import TableSpec
from daybook.tables.daytable import DayTable

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        schemas.TRIP_EVENTS,
        schemas.TRIP_EVENTS_CURATED,
        schemas.ANPR_CAMERA_EVENTS,
        schemas.REWARD_LEDGER,
        schemas.ACCOUNT_SNAPSHOTS,
        schemas.REFERENCE_FEED_CACHE,
    )
}


ZONES = ("raw", "curated", "hot")


def personal_tables(spark: SparkSession, lake: str) -> list[tuple[str, DayTable]]:
    """Zone and table of everything in the lake that holds an identifier; raw and curated trips always count."""
    every = [(z, day_table(spark, lake, z, n)) for z in ZONES for n, spec in TABLES.items() if spec.identifier]
    always = {("raw", schemas.TRIP_EVENTS.name), ("curated", schemas.TRIP_EVENTS_CURATED.name)}
    return [(z, t) for z, t in every if (z, t.spec.name) in always or t.exists()]


def day_table(spark: SparkSession, lake: str, zone: str, name: str) -> DayTable:
    """A table of a zone; the zone is ``raw``, ``curated`` or ``hot``."""
    return DayTable(spark, f"{lake.rstrip('/')}/{zone}/{name}", TABLES[name])
