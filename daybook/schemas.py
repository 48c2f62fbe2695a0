"""Declared tables: one ``StructType``, key and partition columns each. Schemas are never inferred."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import types as T


def _schema(**columns: str) -> T.StructType:
    schema = T.StructType()
    for name, kind in columns.items():
        schema = schema.add(name, kind)
    return schema


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: str
    partition_columns: tuple[str, ...] = ("event_date", "city_code")
    identifier: str | None = None

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def date_column(self) -> str:
        return self.partition_columns[0]

    def renamed(self, name: str) -> TableSpec:
        return TableSpec(name, self.schema, self.primary_key, self.partition_columns, self.identifier)

    def with_fields(self, fields: Iterable[T.StructField]) -> TableSpec:
        """The same table with more columns behind its own."""
        return replace(self, schema=T.StructType([*self.schema.fields, *fields]))


TRIP_EVENTS = TableSpec(
    "trip_events",
    _schema(
        trip_id="long",
        vehicle_id_hash="string",
        city_code="string",
        event_date="date",
        distance_km="double",
        fare_amount="double",
        created_at="timestamp_ntz",
    ),
    "trip_id",
    identifier="vehicle_id_hash",
)

TRIP_EVENTS_CURATED = TRIP_EVENTS.renamed("trip_events_curated")

ANPR_CAMERA_EVENTS = TableSpec(
    "anpr_camera_events",
    _schema(
        event_id="long",
        vehicle_id_hash="string",
        camera_id="string",
        city_code="string",
        event_date="date",
        captured_at="timestamp_ntz",
    ),
    "event_id",
    identifier="vehicle_id_hash",
)

REWARD_LEDGER = TableSpec(
    "reward_ledger",
    _schema(
        ledger_id="long",
        account_id="long",
        city_code="string",
        ledger_type="string",
        amount="decimal(10,2)",
        event_date="date",
        created_at="timestamp_ntz",
    ),
    "ledger_id",
    identifier="account_id",
)

# A sparse table goes by month: directories that hold a handful of rows each cost more than they prune.
REWARD_LEDGER_MONTHLY = TableSpec(
    "reward_ledger",
    T.StructType([*REWARD_LEDGER.schema.fields, T.StructField("event_month", T.DateType())]),
    "ledger_id",
    partition_columns=("event_month",),
    identifier="account_id",
)

# Taken whole once a night, so its day is the snapshot date rather than an event date.
ACCOUNT_SNAPSHOTS = TableSpec(
    "account_snapshots",
    _schema(
        account_id="long",
        email_hash="string",
        city_code="string",
        status="string",
        snapshot_date="date",
    ),
    "account_id",
    partition_columns=("snapshot_date", "city_code"),
    identifier="account_id",
)

ACCOUNTS = TableSpec(
    "accounts",
    _schema(account_id="long", email_hash="string", city_code="string", status="string"),
    "account_id",
    identifier="email_hash",
)

ZONE_OCCUPANCY_HOURLY = TableSpec(
    "zone_occupancy_hourly",
    _schema(
        occupancy_id="long",
        city_code="string",
        zone_id="string",
        hour_ts="timestamp_ntz",
        occupancy_pct="double",
    ),
    "occupancy_id",
)

REFERENCE_FEED_CACHE = TableSpec(
    "reference_feed_cache",
    _schema(
        cache_id="long",
        provider="string",
        city_code="string",
        payload_summary="string",
        fetched_date="date",
    ),
    "cache_id",
    partition_columns=("fetched_date", "city_code"),
)
