"""Workload queries, filters, lookups, counts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.catalog.registry import AS_OF, DAY, FREQUENT_SQL, NOW, SINCE, TODAY, SampleLake, exported, frequent_vehicle, query, trips
from daybook.functions.days import date_spine
from daybook.operators import partitions
from daybook.operators.erasure import count_by_identifier
from daybook.operators.reconcile import (
    count_checksum,
    count_checksum_by_day,
    mismatch_text,
    reconcile,
    with_empty_days,
)
from daybook.plans import workload
from daybook.plans.jobs import curate_days, export_days, high_watermark
from daybook.schemas import TRIP_EVENTS
from daybook.sources.events import FrameSource
from daybook.sources.given import view
from daybook.tables.keys import matching

TRIP_COLUMNS = ", ".join(TRIP_EVENTS.columns)
EXACT_FARE = "cast(sum(cast(fare_amount AS decimal(18,4))) AS double)"


@query(
    "q1_trips_with_cameras",
    """SELECT t.city_code, count(*) AS trips, count(DISTINCT t.vehicle_id_hash) AS vehicles
    FROM trip_events t JOIN anpr_camera_events a
      ON a.vehicle_id_hash = t.vehicle_id_hash AND a.city_code = t.city_code
    WHERE t.event_date >= DATE '2024-01-15' GROUP BY t.city_code""",
    "trip_events anpr_camera_events",
)
def q1(spark, sf):
    return workload.trips_with_cameras(trips(spark, sf), view(spark, sf, "anpr_camera_events"), SINCE)


@query(
    "q2_zone_occupancy_7d",
    """SELECT city_code, zone_id,
      cast(sum(cast(occupancy_pct AS decimal(18,4))) AS double) / count(occupancy_pct) AS avg_occupancy
    FROM zone_occupancy_hourly WHERE hour_ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS
    GROUP BY city_code, zone_id""",
    "zone_occupancy_hourly",
)
def q2(spark, sf):
    return workload.zone_occupancy(view(spark, sf, "zone_occupancy_hourly"), AS_OF)


@query(
    "q3_city_since",
    f"""SELECT city_code, count(*) AS trips, {EXACT_FARE} / count(fare_amount) AS avg_fare,
      cast(sum(cast(distance_km AS decimal(18,4))) AS double) AS total_km
    FROM trip_events WHERE event_date >= DATE '2024-01-15' GROUP BY city_code""",
    "trip_events",
)
def q3(spark, sf):
    return workload.city_since(trips(spark, sf), SINCE)


@query(
    "q4_ledger_by_city_type",
    """SELECT a.city_code, r.ledger_type, count(*) AS entries, cast(sum(r.amount) AS decimal(20,2)) AS amount
    FROM reward_ledger r JOIN accounts a ON a.account_id = r.account_id GROUP BY a.city_code, r.ledger_type""",
    "reward_ledger accounts",
)
def q4(spark, sf):
    return workload.ledger_by_city(view(spark, sf, "reward_ledger"), view(spark, sf, "accounts"))


@query(
    "q7_city_day",
    f"""SELECT city_code, count(*) AS trips, {EXACT_FARE} / count(fare_amount) AS avg_fare
    FROM trip_events WHERE event_date = DATE '2024-01-15' GROUP BY city_code""",
    "trip_events",
)
def q7(spark, sf):
    lake = SampleLake(spark)
    export_days(spark, FrameSource(trips(spark, sf), TRIP_EVENTS), lake.raw, lake.root, [DAY], now=NOW).raise_if_failed()
    curate_days(spark, lake.raw, lake.curated, lake.root, [DAY], now=NOW).raise_if_failed()
    return workload.city_day(lake.curated.read(days=[DAY]), DAY)


@query("lookup_trip", f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE trip_id = 42", "trip_events")
def lookup_trip(spark, sf):
    return workload.lookup(trips(spark, sf), "trip_id", 42)


@query("lookup_account", "SELECT * FROM accounts WHERE account_id = 42", "accounts")
def lookup_account(spark, sf):
    return workload.lookup(view(spark, sf, "accounts"), "account_id", 42)


@query("project_explicit", f"SELECT {TRIP_COLUMNS} FROM trip_events", "trip_events")
def project_explicit(spark, sf):
    return trips(spark, sf).select(*TRIP_EVENTS.columns)


@query("filter_date_eq", f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE event_date = DATE '2024-01-15'", "trip_events")
def filter_date_eq(spark, sf):
    return trips(spark, sf).filter(F.col("event_date") == F.lit(DAY))


@query(
    "filter_date_since", f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE event_date >= DATE '2024-01-15'", "trip_events"
)
def filter_date_since(spark, sf):
    return trips(spark, sf).filter(F.col("event_date") >= F.lit(SINCE))


@query(
    "filter_date_between",
    f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'",
    "trip_events",
)
def filter_date_between(spark, sf):
    return trips(spark, sf).filter(F.col("event_date").between(dt.date(2024, 1, 10), DAY))


@query(
    "filter_rolling_7d",
    "SELECT * FROM zone_occupancy_hourly WHERE hour_ts >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS",
    "zone_occupancy_hourly",
)
def filter_rolling_7d(spark, sf):
    start = F.lit(AS_OF - dt.timedelta(days=7)).cast("timestamp_ntz")
    return view(spark, sf, "zone_occupancy_hourly").filter(F.col("hour_ts") >= start)


@query(
    "filter_identifier",
    f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE vehicle_id_hash = {FREQUENT_SQL}",
    "trip_events",
)
def filter_identifier(spark, sf):
    rows = trips(spark, sf)
    return matching(rows, frequent_vehicle(rows), "vehicle_id_hash").select(*TRIP_EVENTS.columns)


@query("filter_false", f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE 1 = 0", "trip_events")
def filter_false(spark, sf):
    return trips(spark, sf).filter(F.lit(False))


@query(
    "count_checksum",
    """SELECT count(*) AS row_count, cast(coalesce(sum(trip_id), 0) AS bigint) AS checksum
    FROM trip_events WHERE event_date = DATE '2024-01-15'""",
    "trip_events",
)
def day_checksum(spark, sf):
    return count_checksum(exported(spark, sf).raw.read(days=[DAY]), "trip_id")


@query(
    "count_checksum_by_date",
    """SELECT d.event_date, count(trip_id) AS row_count, cast(coalesce(sum(trip_id), 0) AS bigint) AS checksum
    FROM (SELECT cast(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS date) AS event_date) d
    LEFT JOIN trip_events t ON t.event_date = d.event_date GROUP BY d.event_date""",
    "trip_events",
)
def checksum_by_date(spark, sf):
    calendar = date_spine(spark, dt.date(2023, 12, 30), dt.date(2024, 2, 2))
    return with_empty_days(count_checksum_by_day(exported(spark, sf).raw.read(), "trip_id"), calendar)


@query(
    "reconcile_dates",
    """, s AS (SELECT event_date, count(*) AS n, sum(trip_id) AS k FROM trip_events GROUP BY 1),
    l AS (SELECT event_date, count(*) AS n, sum(trip_id) AS k FROM trip_events
          WHERE event_date <> DATE '2024-01-20' AND NOT (city_code = 'HYD' AND event_date >= DATE '2024-01-25') GROUP BY 1)
    SELECT coalesce(s.event_date, l.event_date) AS event_date, coalesce(s.n, 0) AS source_count,
      cast(coalesce(s.k, 0) AS bigint) AS source_checksum, coalesce(l.n, 0) AS lake_count,
      cast(coalesce(l.k, 0) AS bigint) AS lake_checksum,
      coalesce(s.n, 0) = coalesce(l.n, 0) AND coalesce(s.k, 0) = coalesce(l.k, 0) AS matched
    FROM s FULL JOIN l ON s.event_date = l.event_date""",
    "trip_events",
)
def reconcile_dates(spark, sf):
    rows = trips(spark, sf)
    # The lake side lacks one day altogether, and one city on the last days.
    damaged = rows.filter("event_date <> DATE '2024-01-20' AND NOT (city_code = 'HYD' AND event_date >= DATE '2024-01-25')")
    return reconcile(count_checksum_by_day(rows, "trip_id"), count_checksum_by_day(damaged, "trip_id"))


@query(
    "reconcile_errors",
    """, s AS (SELECT event_date, count(*) AS n, sum(trip_id) AS k FROM trip_events GROUP BY 1),
    l AS (SELECT event_date, count(*) AS n, sum(trip_id) AS k FROM trip_events
          WHERE NOT (city_code = 'PUN' AND event_date >= DATE '2024-01-20') GROUP BY 1)
    SELECT s.event_date, CASE WHEN s.n <> coalesce(l.n, 0) OR s.k <> coalesce(l.k, 0) THEN
      concat('reconciliation mismatch: source has ', s.n, ' row(s) with checksum ', s.k, ', lake has ',
             coalesce(l.n, 0), ' row(s) with checksum ', coalesce(l.k, 0)) END AS error
    FROM s LEFT JOIN l ON s.event_date = l.event_date""",
    "trip_events",
)
def reconcile_errors(spark, sf):
    rows = trips(spark, sf)
    damaged = rows.filter("NOT (city_code = 'PUN' AND event_date >= DATE '2024-01-20')")
    both = reconcile(count_checksum_by_day(rows, "trip_id"), count_checksum_by_day(damaged, "trip_id"))
    return both.select("event_date", mismatch_text().alias("error"))


@query("count_distinct_vehicles", "SELECT count(DISTINCT vehicle_id_hash) AS vehicles FROM trip_events", "trip_events")
def count_distinct_vehicles(spark, sf):
    return workload.distinct_vehicles(trips(spark, sf))


@query("distinct_dates", "SELECT DISTINCT event_date FROM trip_events", "trip_events")
def distinct_dates(spark, sf):
    return trips(spark, sf).select("event_date").distinct().orderBy("event_date")


@query(
    "count_by_identifier",
    """SELECT t.vehicle_id_hash, count(*) AS rows FROM trip_events t
    WHERE EXISTS (SELECT 1 FROM anpr_camera_events a WHERE a.vehicle_id_hash = t.vehicle_id_hash)
    GROUP BY t.vehicle_id_hash""",
    "trip_events anpr_camera_events",
)
def by_identifier(spark, sf):
    return count_by_identifier(trips(spark, sf), view(spark, sf, "anpr_camera_events"), "vehicle_id_hash")


@query("high_watermark", "SELECT coalesce(max(trip_id), 1) AS high_watermark FROM trip_events", "trip_events")
def watermark(spark, sf):
    return high_watermark(trips(spark, sf), "trip_id")


@query(
    "ordered_day",
    f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE event_date = DATE '2024-01-15' ORDER BY trip_id",
    "trip_events",
)
def ordered_day(spark, sf):
    return FrameSource(trips(spark, sf), TRIP_EVENTS).rows(DAY, DAY).orderBy("trip_id")


@query(
    "spot_check",
    f"SELECT {TRIP_COLUMNS} FROM trip_events WHERE event_date = DATE '2024-01-15' ORDER BY trip_id LIMIT 5",
    "trip_events",
)
def spot_check(spark, sf):
    return exported(spark, sf).raw.read(days=[DAY]).orderBy("trip_id").limit(5)


@query(
    "filter_before_cutoff",
    "SELECT DISTINCT event_date FROM trip_events WHERE event_date < DATE '2024-01-31' - 16",
    "trip_events",
)
def filter_before_cutoff(spark, sf):
    return partitions.before_cutoff(trips(spark, sf).select("event_date").distinct(), TODAY, 16)
