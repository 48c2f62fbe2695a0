"""The jobs end to end, and the evidence they leave."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.catalog.analytics import TRIP_COLUMNS
from daybook.catalog.registry import DAY, FREQUENT_SQL, NOW, SampleLake, day_range, exported, frequent_vehicle, loaded, query, trips
from daybook.operators import evidence
from daybook.plans.erase import Target, erase
from daybook.plans.jobs import compact, curate_days, export_days, snapshot_accounts, trim
from daybook.schemas import ACCOUNT_SNAPSHOTS, ANPR_CAMERA_EVENTS, REWARD_LEDGER_MONTHLY, TRIP_EVENTS
from daybook.sources.events import FrameSource
from daybook.sources.given import view
from daybook.tables.daytable import DayTable

DAY_RESULT = """SELECT event_date, count(*) AS row_count, cast(sum(trip_id) AS bigint) AS checksum, true AS success
FROM trip_events"""


def _results(report, spark):
    return report.frame(spark).select("event_date", "row_count", "checksum", "success")


@query("job_export_day", f"{DAY_RESULT} WHERE event_date = DATE '2024-01-15' GROUP BY event_date", "trip_events")
def job_export_day(spark, sf):
    lake = SampleLake(spark)
    source = FrameSource(trips(spark, sf), TRIP_EVENTS)
    export_days(spark, source, lake.raw, lake.root, [DAY], now=NOW)
    again = export_days(spark, source, lake.raw, lake.root, [DAY], now=NOW)
    return _results(again, spark)


@query("job_backfill", f"SELECT {TRIP_COLUMNS} FROM trip_events", "trip_events")
def job_backfill(spark, sf):
    return SampleLake(spark).backfill(trips(spark, sf)).raw.read()


@query("job_curate_day", f"{DAY_RESULT} WHERE event_date = DATE '2024-01-15' GROUP BY event_date", "trip_events")
def job_curate_day(spark, sf):
    lake = loaded(spark, sf)
    return _results(curate_days(spark, lake.raw, lake.curated, lake.root, [DAY], now=NOW), spark)


@query(
    "job_compact",
    # The replaced day's files go, and nothing of the curated table.
    """SELECT table_name, CASE WHEN (SELECT count(*) FROM trip_events) > 0 THEN expired END AS snapshots_expired,
      removed * (SELECT cast(count(DISTINCT event_date) AS integer) FROM trip_events WHERE event_date = DATE '2024-01-15') AS paths_removed
    FROM (VALUES ('trip_events', 3, 1), ('trip_events_curated', 1, 0)) v(table_name, expired, removed)""",
    "trip_events",
)
def job_compact(spark, sf):
    lake = loaded(spark, sf)
    curate_days(spark, lake.raw, lake.curated, lake.root, sorted(lake.raw.days()), now=NOW)
    lake.raw.drop_days([DAY], now=NOW)
    lake.raw.replace_days(trips(spark, sf).filter(F.col("event_date") == F.lit(DAY)), [DAY], now=NOW)
    done = compact(spark, [lake.raw, lake.curated], lake.root, now=NOW + dt.timedelta(days=30))
    return done.select("table_name", "snapshots_expired", "paths_removed")


def _trimmed(spark, sf):
    """Hot store holding every trip; days whose number ends in 3 were never exported."""
    lake = SampleLake(spark)
    rows = trips(spark, sf)
    hot = DayTable(spark, f"{lake.root}/hot/trip_events", TRIP_EVENTS).create(NOW)
    days = day_range(rows)
    hot.replace_days(rows, days, now=NOW)
    kept = [d for d in days if d.day % 10 != 3]
    export_days(spark, FrameSource(rows, TRIP_EVENTS), lake.raw, lake.root, kept, now=NOW)
    report = trim(spark, hot, lake.root, dt.date(2024, 1, 25), retention_days=10, lookahead_days=14, now=NOW)
    return lake, report


@query(
    "job_trim",
    """, d AS (SELECT event_date, count(*) AS n FROM trip_events GROUP BY event_date)
    SELECT event_date, NULL AS name, CASE WHEN day(event_date) % 10 = 3 THEN 'skipped' ELSE 'dropped' END AS outcome,
      CASE WHEN day(event_date) % 10 <> 3 THEN n END AS row_count,
      CASE WHEN day(event_date) % 10 = 3 THEN 'no export manifest found' END AS reason,
      CASE WHEN day(event_date) % 10 <> 3 THEN cast(0 AS bigint) END AS late_rows
    FROM d WHERE event_date < DATE '2024-01-15'
    UNION ALL SELECT NULL, concat('trip_events_y', strftime(cast(s.day AS date), '%Y_m%m_d%d')), 'created', NULL, NULL, NULL
    FROM (SELECT unnest(generate_series(DATE '2024-01-25', DATE '2024-02-07', INTERVAL 1 DAY)) AS day) s
    WHERE cast(s.day AS date) NOT IN (SELECT event_date FROM d)""",
    "trip_events",
)
def job_trim(spark, sf):
    return _trimmed(spark, sf)[1].frame(spark)


@query(
    "write_trim_summary",
    """, d AS (SELECT event_date, count(*) AS n FROM trip_events WHERE event_date < DATE '2024-01-15' GROUP BY event_date)
    SELECT '2024-01-25' AS run_date, 10 AS retention_days, true AS success,
      strftime(event_date, '%Y-%m-%d') AS date, n AS row_count
    FROM d WHERE day(event_date) % 10 <> 3""",
    "trip_events",
)
def write_trim_summary(spark, sf):
    lake, _ = _trimmed(spark, sf)
    summary = spark.read.schema(evidence.TRIM_SCHEMA).json(
        f"{lake.root}/{evidence.trim_path('2024-01-25')}", multiLine=True
    )
    return summary.select("run_date", "retention_days", "success", F.explode("partitions_dropped").alias("p")).select(
        "run_date", "retention_days", "success", "p.date", "p.row_count"
    )


@query(
    "write_run_manifest",
    """SELECT 'trip_events' AS table_name, strftime(event_date, '%Y-%m-%d') AS run_date, count(*) AS row_count,
      cast(sum(trip_id) AS bigint) AS checksum, true AS success, cast(NULL AS varchar) AS error FROM trip_events GROUP BY event_date""",
    "trip_events",
)
def write_run_manifest(spark, sf):
    files = f"{exported(spark, sf).root}/{evidence.ROOT}/[0-9]*/trip_events.json"
    return spark.read.schema(evidence.RUN_SCHEMA).json(files, multiLine=True).select(
        F.col("table").alias("table_name"), "run_date", "row_count", "checksum", "success", "error"
    )


@query(
    "write_backfill_summary",
    """, d AS (SELECT event_date, count(*) AS n, sum(trip_id) AS k FROM trip_events GROUP BY event_date)
    SELECT strftime((SELECT min(event_date) FROM d), '%Y-%m-%d') AS start_date,
      strftime((SELECT max(event_date) FROM d), '%Y-%m-%d') AS end_date,
      cast((SELECT sum(n) FROM d) AS bigint) AS total_rows, cast((SELECT count(*) FROM d) AS integer) AS success_count,
      0 AS failure_count, strftime(event_date, '%Y-%m-%d') AS date, n AS row_count, cast(k AS bigint) AS checksum FROM d""",
    "trip_events",
)
def write_backfill_summary(spark, sf):
    files = f"{exported(spark, sf).root}/{evidence.ROOT}/backfill/*/summary.json"
    summary = spark.read.schema(evidence.BACKFILL_SCHEMA).json(files, multiLine=True)
    totals = ["start_date", "end_date", "total_rows", "success_count", "failure_count"]
    return summary.select(*totals, F.explode("dates").alias("d")).select(*totals, "d.date", "d.row_count", "d.checksum")


def _requests(spark, vehicles):
    """Two requests: the given vehicle, and one that nobody has."""
    unknown = spark.createDataFrame([("hash_veh_nobody",)], "vehicle_id_hash STRING")
    both = vehicles.withColumn("n", F.lit(1)).unionByName(unknown.withColumn("n", F.lit(2)))
    return both.select(
        F.col("vehicle_id_hash").alias("identifier"),
        F.concat(F.lit("REQ-2024-"), F.col("n").cast("string")).alias("request_ref"),
        F.lit("IN").alias("jurisdiction"),
    )


def _erased(spark, sf):
    """Raw holds every trip, curated only the first half of the month."""
    lake = loaded(spark, sf)
    early = sorted(d for d in lake.raw.days() if d <= DAY)
    curate_days(spark, lake.raw, lake.curated, lake.root, early, now=NOW)
    vehicle = spark.createDataFrame(frequent_vehicle(lake.raw.read()).collect(), "vehicle_id_hash STRING")
    targets = [Target("raw", lake.raw), Target("curated", lake.curated)]
    return lake, erase(spark, lake.root, _requests(spark, vehicle), targets, now=NOW)


_ERASED = f""", v AS (SELECT {FREQUENT_SQL} AS id),
    r AS (SELECT 'REQ-2024-1' AS request_ref, id AS identifier FROM v
          UNION ALL SELECT 'REQ-2024-2', 'hash_veh_nobody'),
    t AS (SELECT 'trip_events' AS table_name, vehicle_id_hash FROM trip_events
          UNION ALL SELECT 'trip_events_curated', vehicle_id_hash FROM trip_events WHERE event_date <= DATE '2024-01-15')
    SELECT r.request_ref, r.identifier, n.table_name, count(t.vehicle_id_hash) AS rows_before,
      cast(0 AS bigint) AS rows_after_delete, count(t.vehicle_id_hash) > 0 AS time_travel_blocked, true AS success
    FROM r CROSS JOIN (VALUES ('trip_events'), ('trip_events_curated')) n(table_name)
    LEFT JOIN t ON t.table_name = n.table_name AND t.vehicle_id_hash = r.identifier GROUP BY 1, 2, 3"""


@query("job_erasure", _ERASED, "trip_events")
def job_erasure(spark, sf):
    return _erased(spark, sf)[1].select(
        "request_ref", "identifier", "table_name", "rows_before", "rows_after_delete", "time_travel_blocked", "success"
    )


@query("write_erasure_manifest", _ERASED, "trip_events")
def write_erasure_manifest(spark, sf):
    lake, _ = _erased(spark, sf)
    files = f"{lake.root}/{evidence.ROOT}/erasure/*/*.json"
    record = spark.read.schema(evidence.ERASURE_SCHEMA).json(files, multiLine=True)
    return record.select("request_ref", "identifier", F.explode("tables").alias("t")).select(
        "request_ref",
        "identifier",
        F.col("t.table").alias("table_name"),
        "t.rows_before",
        "t.rows_after_delete",
        "t.time_travel_blocked",
        "t.success",
    )


@query(
    "erase_all_personal_tables",
    """SELECT table_name, rows_before, cast(0 AS bigint) AS rows_after_delete, true AS success FROM (
      SELECT 'trip_events' AS table_name, count(*) AS rows_before FROM trip_events WHERE vehicle_id_hash = 'hash_veh_000007'
      UNION ALL SELECT 'anpr_camera_events', count(*) FROM anpr_camera_events WHERE vehicle_id_hash = 'hash_veh_000007'
      UNION ALL SELECT 'reward_ledger', count(*) FROM reward_ledger WHERE account_id = 7
      UNION ALL SELECT 'account_snapshots', count(*) FROM accounts WHERE account_id = 7)""",
    "trip_events anpr_camera_events reward_ledger accounts",
)
def erase_all_personal_tables(spark, sf):
    lake = loaded(spark, sf)
    cameras = DayTable(spark, f"{lake.root}/raw/anpr_camera_events", ANPR_CAMERA_EVENTS).create(NOW)
    ledger = DayTable(spark, f"{lake.root}/raw/reward_ledger", REWARD_LEDGER_MONTHLY).create(NOW)
    seen = view(spark, sf, "anpr_camera_events")
    cameras.replace_days(seen, day_range(seen), now=NOW)
    entries = view(spark, sf, "reward_ledger").withColumn("event_month", F.trunc("event_date", "month"))
    ledger.replace_days(entries, [r[0] for r in entries.select("event_month").distinct().collect()], now=NOW)
    people = DayTable(spark, f"{lake.root}/raw/account_snapshots", ACCOUNT_SNAPSHOTS)
    snapshot_accounts(view(spark, sf, "accounts"), people, DAY, NOW)
    account = spark.createDataFrame([("hash_veh_000007", 7)], "identifier STRING, account_id BIGINT")
    request = spark.createDataFrame(
        [("hash_veh_000007", "REQ-ALL-7", "")], "identifier STRING, request_ref STRING, jurisdiction STRING"
    )
    targets = [Target("raw", lake.raw), Target("raw", cameras), Target("raw", ledger, account), Target("raw", people, account)]
    done = erase(spark, lake.root, request, targets, now=NOW)
    return done.select("table_name", "rows_before", "rows_after_delete", "success")
