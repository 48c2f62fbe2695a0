"""Table verbs: scans, writes, replace, delete, history, partitions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.catalog.analytics import TRIP_COLUMNS
from daybook.catalog.registry import (
    DAY,
    FREQUENT_SQL,
    NOW,
    SINCE,
    SampleLake,
    day_range,
    exported,
    frequent_vehicle,
    loaded,
    query,
    trips,
)
from daybook.functions.days import date_spine
from daybook.operators import partitions, reports
from daybook.operators.changes import new_rows, without_erased, without_synthetic
from daybook.operators.cities import CITIES_SCHEMA
from daybook.operators.evidence import successful_days, parse_run_manifests, scan_run_manifests
from daybook.plans import retention
from daybook.plans.jobs import (
    curatable_days,
    curate_days,
    day_frame,
    export_days,
    merge_small_files,
    migrate,
    snapshot_accounts,
)
from daybook.schemas import ACCOUNT_SNAPSHOTS, REFERENCE_FEED_CACHE, REWARD_LEDGER_MONTHLY, TRIP_EVENTS
from daybook.sources.events import FrameSource, ParquetSource
from daybook.sources.given import view
from daybook.sources.operations import scan_files
from daybook.tables.columns import evolved
from daybook.tables.daytable import DayTable, expirable

ALL_TRIPS = f"SELECT {TRIP_COLUMNS} FROM trip_events"


# ---- scans -----------------------------------------------------------------------------------------


@query("scan_source_day", f"{ALL_TRIPS} WHERE event_date = DATE '2024-01-15'", "trip_events")
def scan_source_day(spark, sf):
    return FrameSource(trips(spark, sf), TRIP_EVENTS).rows(DAY, DAY)


@query(
    "scan_source_range",
    f"{ALL_TRIPS} WHERE event_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-21'",
    "trip_events",
)
def scan_source_range(spark, sf):
    # A Parquet copy stands in for the source table, so the day filter can be seen to reach the scan.
    lake = SampleLake(spark)
    copy = f"{lake.root}/source/trip_events"
    trips(spark, sf).write.parquet(copy)
    return ParquetSource(spark, copy, TRIP_EVENTS).rows(DAY, dt.date(2024, 1, 21))


@query("scan_staged_parquet", ALL_TRIPS, "trip_events")
def scan_staged_parquet(spark, sf):
    raw = SampleLake(spark).raw.create(NOW)
    rows = trips(spark, sf)
    return raw.read_staged(raw.stage(rows, day_range(rows)))


@query("scan_lake_date", f"{ALL_TRIPS} WHERE event_date = DATE '2024-01-15'", "trip_events")
def scan_lake_date(spark, sf):
    return exported(spark, sf).raw.read(days=[DAY])


@query(
    "scan_lake_range",
    f"{ALL_TRIPS} WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'",
    "trip_events",
)
def scan_lake_range(spark, sf):
    return exported(spark, sf).raw.read_between(dt.date(2024, 1, 10), DAY)


@query("scan_version", ALL_TRIPS, "trip_events")
def scan_version(spark, sf):
    raw = loaded(spark, sf).raw
    before = raw.snapshot().snapshot_id
    raw.drop_days([DAY], now=NOW)
    raw.delete_keys(frequent_vehicle(raw.read()), "vehicle_id_hash", now=NOW)
    return raw.read(version=before)


@query(
    "scan_snapshots",
    """SELECT snapshot_id, parent_id, operation, CASE snapshot_id WHEN 1 THEN 0 ELSE
      cast((SELECT count(DISTINCT event_date) FROM trip_events) AS integer) - (snapshot_id - 2) END AS days
    FROM (VALUES (1, NULL, 'create'), (2, 1, 'replace'), (3, 2, 'drop_days')) v(snapshot_id, parent_id, operation)""",
    "trip_events",
)
def scan_snapshots(spark, sf):
    raw = loaded(spark, sf).raw
    raw.drop_days([DAY], now=NOW)
    return raw.snapshots().select(
        F.col("snapshot_id").cast("int").alias("snapshot_id"),
        F.col("parent_id").cast("int").alias("parent_id"),
        "operation",
        F.size("days").alias("days"),
    )


@query(
    "scan_manifests",
    """SELECT event_date AS run_date, 'trip_events' AS table_name, true AS parsed, true AS success,
      count(*) AS row_count, cast(sum(trip_id) AS bigint) AS checksum FROM trip_events GROUP BY event_date""",
    "trip_events",
)
def scan_manifests(spark, sf):
    found = scan_run_manifests(spark, exported(spark, sf).root, "trip_events")
    return found.select(
        "run_date", F.col("table").alias("table_name"), "parsed", "success", "row_count", "checksum"
    )


@query("scan_files", "SELECT DISTINCT event_date, city_code FROM trip_events", "trip_events")
def listed_files(spark, sf):
    files = scan_files(spark, exported(spark, sf).raw.data_root)
    return files.filter("bytes > 0").select(
        F.to_date(F.regexp_extract("path", "/event_date=([^/]+)/", 1)).alias("event_date"),
        F.regexp_extract("path", "/city_code=([^/]+)/", 1).alias("city_code"),
    ).distinct()


@query(
    "scan_partitions",
    """SELECT DISTINCT event_date, concat('trip_events_y', strftime(event_date, '%Y_m%m_d%d')) AS name
    FROM trip_events""",
    "trip_events",
)
def scan_partitions(spark, sf):
    return partitions.named(day_frame(spark, exported(spark, sf).raw.days()))


# ---- writes and changes ----------------------------------------------------------------------------


@query(
    "write_parquet_batch",
    "SELECT event_date, city_code, count(*) AS rows FROM trip_events GROUP BY event_date, city_code",
    "trip_events",
)
def write_parquet_batch(spark, sf):
    raw = SampleLake(spark).raw.create(NOW)
    rows = trips(spark, sf)
    staged = raw.stage(rows, day_range(rows))
    return raw.read_staged(staged).groupBy("event_date", "city_code").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "replace_dates",
    f"""{ALL_TRIPS} WHERE event_date NOT IN (DATE '2024-01-15', DATE '2024-01-16')
      OR (event_date = DATE '2024-01-15' AND city_code <> 'DEL')""",
    "trip_events",
)
def replace_dates(spark, sf):
    # The 15th comes again without one city, the 16th comes again empty: neither may keep old rows.
    raw = loaded(spark, sf).raw
    again = trips(spark, sf).filter((F.col("event_date") == F.lit(DAY)) & (F.col("city_code") != "DEL"))
    raw.replace_days(again, [DAY, dt.date(2024, 1, 16)], now=NOW)
    return raw.read()


@query(
    "ctas_empty",
    "SELECT count(*) AS source_rows, cast(0 AS bigint) AS table_rows, 7 AS columns FROM trip_events",
    "trip_events",
)
def ctas_empty(spark, sf):
    empty = SampleLake(spark).curated.create(NOW).read()
    sides = trips(spark, sf).select(F.lit(1).alias("source")).unionByName(
        empty.select(F.lit(0).alias("source"))
    )
    return sides.agg(
        F.count_if(F.col("source") == 1).alias("source_rows"),
        F.count_if(F.col("source") == 0).alias("table_rows"),
        F.lit(len(empty.columns)).alias("columns"),
    )


@query("delete_date", f"{ALL_TRIPS} WHERE event_date <> DATE '2024-01-15'", "trip_events")
def delete_date(spark, sf):
    raw = loaded(spark, sf).raw
    raw.drop_days([DAY], now=NOW)
    return raw.read()


@query("delete_identifier", f"{ALL_TRIPS} WHERE vehicle_id_hash <> {FREQUENT_SQL}", "trip_events")
def delete_identifier(spark, sf):
    raw = loaded(spark, sf).raw
    raw.delete_keys(frequent_vehicle(raw.read()), "vehicle_id_hash", now=NOW)
    return raw.read()


@query(
    "delete_many_identifiers",
    f"""{ALL_TRIPS} WHERE vehicle_id_hash NOT IN
      (SELECT vehicle_id_hash FROM anpr_camera_events WHERE camera_id = 'cam_007')""",
    "trip_events anpr_camera_events",
)
def delete_many_identifiers(spark, sf):
    raw = loaded(spark, sf).raw
    seen = view(spark, sf, "anpr_camera_events").filter("camera_id = 'cam_007'")
    raw.delete_keys(seen, "vehicle_id_hash", now=NOW)
    return raw.read()


@query("insert_select", ALL_TRIPS, "trip_events")
def insert_select(spark, sf):
    lake = loaded(spark, sf)
    lake.curated.create(NOW)
    lake.curated.replace_days(lake.raw.read(), lake.raw.days(), operation="insert", rebalance=False, now=NOW)
    return lake.curated.read()


@query("insert_ignore_conflicts", ALL_TRIPS, "trip_events")
def insert_ignore_conflicts(spark, sf):
    rows = trips(spark, sf)
    raw = SampleLake(spark).load_raw(rows.filter(F.col("event_date") <= F.lit(SINCE))).raw
    incoming = rows.unionByName(rows.filter("city_code = 'BLR'"))
    raw.append(new_rows(incoming, raw.read(), ["trip_id", "event_date"]), day_range(rows), now=NOW)
    return raw.read()


@query(
    "expire_snapshots",
    """SELECT snapshot_id FROM (SELECT event_id AS snapshot_id, ts,
      row_number() OVER (ORDER BY ts DESC, event_id DESC) AS rank FROM events)
    WHERE rank > 100 AND ts <= TIMESTAMP '2024-01-15'""",
)
def expire_snapshots(spark, sf):
    log = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").alias("snapshot_id"), F.col("ts").alias("committed_at")
    )
    return expirable(log, 100, dt.datetime(2024, 1, 15)).select("snapshot_id")


@query("remove_orphans", f"{ALL_TRIPS} WHERE vehicle_id_hash <> {FREQUENT_SQL}", "trip_events")
def remove_orphans(spark, sf):
    raw = loaded(spark, sf).raw
    raw.delete_keys(frequent_vehicle(raw.read()), "vehicle_id_hash", now=NOW)
    raw.forget_history(NOW)
    return raw.read()


@query("drop_staging", "SELECT DISTINCT event_date AS day FROM trip_events", "trip_events")
def drop_staging(spark, sf):
    # A batch that was written but never published leaves nothing behind.
    raw = loaded(spark, sf).raw
    abandoned = raw.stage(trips(spark, sf).withColumn("event_date", F.lit(dt.date(2023, 1, 1))), [dt.date(2023, 1, 1)])
    raw.remove_orphans(min_age=dt.timedelta(0))
    return raw.files().filter(F.col("commit") != abandoned.commit).select("day").distinct().unionByName(
        raw.files().filter(F.col("commit") == abandoned.commit).select("day").distinct()
    )


@query("orphan_files", "SELECT DISTINCT event_date AS day FROM trip_events WHERE event_date = DATE '2024-01-15'", "trip_events")
def orphan_files(spark, sf):
    raw = loaded(spark, sf).raw
    raw.drop_days([DAY], now=NOW)
    raw.expire(keep=1, now=NOW)
    return raw.orphan_files().select("day").distinct()


@query(
    "latest_snapshot",
    "SELECT event_id AS snapshot_id, ts AS committed_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 1",
)
def latest_snapshot(spark, sf):
    log = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").alias("snapshot_id"), F.col("ts").alias("committed_at")
    )
    return log.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(1)


# ---- partitions ------------------------------------------------------------------------------------


@query(
    "drop_partition_counted",
    "SELECT event_date, count(*) AS row_count FROM trip_events WHERE event_date < DATE '2024-01-11' GROUP BY event_date",
    "trip_events",
)
def drop_partition_counted(spark, sf):
    raw = loaded(spark, sf).raw
    old = [d for d in raw.days() if d < dt.date(2024, 1, 11)]
    counts = partitions.counted(day_frame(spark, old), raw.read(days=old))
    raw.drop_days(old, now=NOW)
    return counts


@query(
    "ensure_future_partitions",
    """SELECT cast(d.day AS date) AS event_date
    FROM (SELECT unnest(generate_series(DATE '2024-01-25', DATE '2024-02-07', INTERVAL 1 DAY)) AS day) d
    WHERE cast(d.day AS date) NOT IN (SELECT event_date FROM trip_events)""",
    "trip_events",
)
def ensure_future_partitions(spark, sf):
    raw = loaded(spark, sf).raw
    before = raw.days()
    created = partitions.missing_future(day_frame(spark, before), dt.date(2024, 1, 25), 14)
    raw.add_days([r.event_date for r in created.collect()], NOW)
    return day_frame(spark, raw.days() - before)


@query(
    "missing_partitions",
    """SELECT cast(d.day AS date) AS event_date
    FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-07', INTERVAL 1 DAY)) AS day) d
    WHERE cast(d.day AS date) NOT IN (SELECT event_date FROM trip_events)""",
    "trip_events",
)
def missing_partitions(spark, sf):
    calendar = date_spine(spark, dt.date(2023, 12, 25), dt.date(2024, 2, 7))
    return partitions.missing_partitions(calendar, partitions.stored_days(exported(spark, sf).raw))


@query(
    "exists_partition",
    """SELECT cast(d.day AS date) AS event_date
    FROM (SELECT unnest(generate_series(DATE '2023-12-25', DATE '2024-02-07', INTERVAL 1 DAY)) AS day) d
    WHERE cast(d.day AS date) IN (SELECT event_date FROM trip_events)""",
    "trip_events",
)
def exists_partition(spark, sf):
    calendar = date_spine(spark, dt.date(2023, 12, 25), dt.date(2024, 2, 7))
    return partitions.present_partitions(calendar, partitions.stored_days(exported(spark, sf).raw))


@query("default_partition_rows", f"{ALL_TRIPS} WHERE event_date >= DATE '2024-01-15'", "trip_events")
def default_partition_rows(spark, sf):
    calendar = date_spine(spark, dt.date(2024, 1, 1), dt.date(2024, 1, 14))
    return partitions.rows_without_partition(trips(spark, sf), calendar)


@query(
    "filter_partition_name",
    r"""SELECT name, event_date FROM (SELECT name,
      CASE WHEN regexp_full_match(name, 'trip_events_y\d{4}_m\d{2}_d\d{2}') THEN
      try_cast(concat(substr(name, 14, 4), '-', substr(name, 20, 2), '-', substr(name, 24, 2)) AS date) END AS event_date
    FROM partition_names) WHERE event_date IS NOT NULL""",
    "partition_names",
)
def filter_partition_name(spark, sf):
    return partitions.dated(view(spark, sf, "partition_names"))


@query("migrate_to_partitioned", ALL_TRIPS, "trip_events")
def migrate_to_partitioned(spark, sf):
    raw = SampleLake(spark).raw
    migrate(spark, trips(spark, sf), raw, now=NOW)
    return raw.read()


def _manifest_texts(spark, sf):
    """One manifest text per day, good or broken in a way that depends on the day; some days have none."""
    per_day = trips(spark, sf).groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))
    kind = F.dayofmonth("event_date") % 8
    head = F.concat(F.lit('{"table": "trip_events", "row_count": '), F.col("n").cast("string"))
    text = (
        F.when(kind == 1, F.concat(head, F.lit(', "success": tr')))
        .when(kind == 2, F.concat(head, F.lit(', "success": false}')))
        .when(kind == 3, F.concat(head, F.lit("}")))
        .when(kind == 4, F.concat(head, F.lit(', "success": "yes"}')))
        .when(kind == 5, F.concat(head, F.lit(', "success": true} trailing')))
        .when(kind != 6, F.concat(head, F.lit(', "success": true}')))
    )
    return per_day.filter(kind != 0).select(F.col("event_date").cast("string").alias("run_date"), text.alias("value"))


@query(
    "retention_plan",
    """, days AS (SELECT event_date, count(*) AS n, day(event_date) % 8 AS kind FROM trip_events GROUP BY event_date)
    SELECT event_date, CASE WHEN kind = 7 THEN 'drop' ELSE 'skip' END AS action,
      CASE WHEN kind = 0 THEN 'no export manifest found' WHEN kind IN (1, 4, 5, 6) THEN 'manifest parse error'
        WHEN kind IN (2, 3) THEN 'manifest reports success=false' END AS reason,
      CASE WHEN kind IN (2, 3, 7) THEN n END AS manifest_rows
    FROM days WHERE event_date < DATE '2024-01-28'""",
    "trip_events",
)
def retention_plan(spark, sf):
    days = trips(spark, sf).select("event_date").distinct()
    old = partitions.before_cutoff(days, dt.date(2024, 4, 27), 90)
    return partitions.retention_plan(old, parse_run_manifests(_manifest_texts(spark, sf)))


# ---- rules documented for the lake -----------------------------------------------------------------


@query("exclude_synthetic", f"{ALL_TRIPS} WHERE city_code <> 'CITY_ZZ'", "trip_events")
def exclude_synthetic(spark, sf):
    return without_synthetic(trips(spark, sf))


@query(
    "exclude_erased",
    f"""{ALL_TRIPS} WHERE vehicle_id_hash NOT IN
      (SELECT identifier FROM erasure_requests WHERE identifier LIKE 'hash_veh_%7' AND jurisdiction = 'IN')""",
    "trip_events erasure_requests",
)
def exclude_erased(spark, sf):
    register = view(spark, sf, "erasure_requests").filter("identifier LIKE 'hash_veh_%7' AND jurisdiction = 'IN'")
    register = register.select(F.col("identifier").alias("vehicle_id_hash"))
    return without_erased(trips(spark, sf), register, "vehicle_id_hash")


# A city that changes its jurisdiction, one that gains it, and three that always have it.
CITIES = (
    ("BLR", "IN", None, dt.date(2024, 1, 10)), ("BLR", "IN-KA", dt.date(2024, 1, 10), None),
    ("DEL", "IN", dt.date(2024, 1, 15), None), ("MUM", "IN", None, None), ("HYD", "IN", None, None), ("PUN", "IN", None, None),
)


@query(
    "jurisdiction_column",
    f"""SELECT {TRIP_COLUMNS}, CASE
      WHEN city_code = 'BLR' AND event_date < DATE '2024-01-10' THEN 'IN'
      WHEN city_code = 'BLR' THEN 'IN-KA'
      WHEN city_code = 'DEL' AND event_date < DATE '2024-01-15' THEN NULL
      WHEN city_code <> 'CITY_ZZ' THEN 'IN' END AS jurisdiction
    FROM trip_events""",
    "trip_events",
)
def jurisdiction_column(spark, sf):
    lake = loaded(spark, sf)
    cities = spark.createDataFrame(CITIES, CITIES_SCHEMA)
    curate_days(spark, lake.raw, lake.curated, lake.root, sorted(lake.raw.days()), now=NOW, cities=cities).raise_if_failed()
    return evolved(lake.curated).read()


@query("curated_dedup", ALL_TRIPS, "trip_events")
def curated_dedup(spark, sf):
    """Every seventh trip also has an older copy on the day before, which is curated in another run than the trip."""
    rows = trips(spark, sf)
    older = rows.filter("trip_id % 7 = 0").withColumns(
        {
            "event_date": F.date_sub("event_date", 1), "created_at": F.expr("created_at - INTERVAL 1 HOUR"),
            "fare_amount": F.col("fare_amount") + 1,
        }
    )
    lake = SampleLake(spark).load_raw(rows.unionByName(older))
    days = sorted(lake.raw.days())
    for part in (days[::2], days[1::2]):
        curate_days(spark, lake.raw, lake.curated, lake.root, part, now=NOW, dedup_by="created_at").raise_if_failed()
    return lake.curated.read()


@query("compact_small_files", ALL_TRIPS, "trip_events")
def compact_small_files(spark, sf):
    rows = trips(spark, sf)
    raw = SampleLake(spark).load_raw(rows.filter("hour(created_at) < 12")).raw
    raw.append(rows.filter("hour(created_at) >= 12"), day_range(rows), now=NOW)
    merge_small_files(raw, now=NOW)
    return raw.read()


@query(
    "file_counts_by_partition",
    # A city of a day is one file, as long as it is below the size at which writes are split.
    """SELECT event_date, count(DISTINCT city_code) AS files, true AS has_bytes FROM trip_events GROUP BY event_date""",
    "trip_events",
)
def file_counts_by_partition(spark, sf):
    counts = reports.file_counts(exported(spark, sf).raw.files())
    return counts.select("event_date", "files", (F.col("bytes") > 0).alias("has_bytes"))


@query(
    "merge_schema",
    """SELECT trip_id, vehicle_id_hash, city_code, event_date, distance_km, fare_amount, created_at,
      cast(NULL AS double) AS surge FROM trip_events WHERE event_date < DATE '2024-01-15' UNION ALL
    SELECT trip_id, vehicle_id_hash, city_code, event_date, distance_km, NULL, created_at, distance_km * 2 FROM trip_events
    WHERE event_date >= DATE '2024-01-15'""",
    "trip_events",
)
def merge_schema(spark, sf):
    """Newer rows come with a column the table does not declare and without one that it does; curated has both."""
    rows = trips(spark, sf)
    newer = rows.filter(F.col("event_date") >= F.lit(SINCE)).drop("fare_amount").withColumn("surge", F.col("distance_km") * 2)
    lake = SampleLake(spark)
    days = day_range(rows)
    for part, frame, added in (([d for d in days if d < SINCE], rows, False), ([d for d in days if d >= SINCE], newer, True)):
        source = FrameSource(frame, TRIP_EVENTS, keep_added=added)
        export_days(spark, source, lake.raw, lake.root, part, now=NOW).raise_if_failed()
    curate_days(spark, lake.raw, lake.curated, lake.root, days, now=NOW).raise_if_failed()
    return evolved(lake.curated).read()


RETENTION_DAY = dt.date(2005, 1, 31)


def _expired(name: str, table: str, key: str, day: str, kept: str) -> str:
    """SQL for the rows of a class that have expired; ``kept`` is the first day that stays."""
    return f"""SELECT '{name}' AS data_class, {key} AS row_id, {day} AS event_date,
    CASE WHEN city_code = 'CITY_ZZ' THEN NULL ELSE 'IN' END AS jurisdiction FROM {table} WHERE {day} < {kept}"""


# The periods are written out here once more, so that the policy of the library is tested by it.
_EXPIRED = " UNION ALL ".join(
    (
        _expired("ledger", "reward_ledger", "ledger_id", "event_date", "DATE '1998-01-31'"),
        _expired("camera", "anpr_camera_events", "event_id", "event_date", "DATE '2004-01-31'"),
        _expired("trip", "trip_events", "trip_id", "event_date", "DATE '2004-11-02'"),
        _expired("reference", "reference_feed_cache", "cache_id", "fetched_date", "DATE '2002-01-31'"),
        _expired("derived", "zone_occupancy_hourly", "occupancy_id", "cast(hour_ts AS date)", "DATE '2004-01-31'"),
    )
)
_CLASS_VIEWS = "reward_ledger anpr_camera_events trip_events reference_feed_cache zone_occupancy_hourly"


@query("retention_by_class", _EXPIRED, _CLASS_VIEWS)
def retention_by_class(spark, sf):
    known = F.when(F.col("city_code") != "CITY_ZZ", F.lit("IN")).alias("jurisdiction")
    out = None
    for c in retention.CLASSES:
        if c.table in _CLASS_VIEWS.split():
            rows = view(spark, sf, c.table).withColumn("event_date", F.expr(c.day))
            old = retention.expired(rows, "event_date", retention.cutoffs(retention.POLICY, c.name, RETENTION_DAY), None)
            part = old.select(F.lit(c.name).alias("data_class"), F.col(c.key).alias("row_id"), "event_date", known)
            out = part if out is None else out.unionByName(part)
    return out


@query(
    "job_retention",
    """SELECT 'ledger' AS data_class, ledger_id AS row_id, event_date FROM reward_ledger WHERE event_date >= DATE '1998-01-31'
    UNION ALL SELECT 'reference', cache_id, fetched_date FROM reference_feed_cache
    WHERE city_code = 'BLR' OR fetched_date >= CASE city_code WHEN 'DEL' THEN DATE '2004-01-31' ELSE DATE '2002-01-31' END""",
    "reward_ledger reference_feed_cache",
)
def job_retention(spark, sf):
    """Ledger by month, with one mixed month; feeds by day, where two jurisdictions have periods of their own."""
    lake = SampleLake(spark)
    ledger = DayTable(spark, f"{lake.root}/raw/reward_ledger", REWARD_LEDGER_MONTHLY).create(NOW)
    entries = view(spark, sf, "reward_ledger").withColumn("event_month", F.trunc("event_date", "month"))
    ledger.replace_days(entries, [r[0] for r in entries.select("event_month").distinct().collect()], now=NOW)
    feeds = DayTable(spark, f"{lake.root}/raw/reference_feed_cache", REFERENCE_FEED_CACHE).create(NOW)
    cached = view(spark, sf, "reference_feed_cache")
    feeds.replace_days(cached, [r[0] for r in cached.select("fetched_date").distinct().collect()], now=NOW)
    cities = spark.createDataFrame([("DEL", "IN-DL", None, None), ("BLR", "IN-KA", None, None)], CITIES_SCHEMA)
    own = (retention.Rule("reference", "IN-DL", months=12), retention.Rule("reference", "IN-KA"))
    for name, table in (("ledger", ledger), ("reference", feeds)):
        retention.apply_retention(spark, table, name, RETENTION_DAY, retention.POLICY + own, cities, NOW)
    return ledger.read().select(F.lit("ledger").alias("data_class"), F.col("ledger_id").alias("row_id"), "event_date").unionByName(
        feeds.read().select(F.lit("reference").alias("data_class"), F.col("cache_id").alias("row_id"), F.col("fetched_date").alias("event_date"))
    )


@query(
    "account_snapshot",
    """SELECT account_id, email_hash, city_code, status, DATE '2024-01-31' AS snapshot_date FROM accounts""",
    "accounts",
)
def account_snapshot(spark, sf):
    table = DayTable(spark, f"{SampleLake(spark).root}/raw/accounts", ACCOUNT_SNAPSHOTS).create(NOW)
    day = dt.date(2024, 1, 31)
    accounts = view(spark, sf, "accounts")
    snapshot_accounts(accounts.filter("status = 'active'"), table, day, NOW)
    snapshot_accounts(accounts, table, day, NOW)
    return table.read()


@query("curate_after_manifest", "SELECT DISTINCT event_date FROM trip_events", "trip_events")
def curate_after_manifest(spark, sf):
    calendar = date_spine(spark, dt.date(2023, 12, 25), dt.date(2024, 2, 7))
    return curatable_days(spark, exported(spark, sf).root, "trip_events", calendar)


@query(
    "successful_manifest_days",
    "SELECT DISTINCT event_date FROM trip_events WHERE day(event_date) % 8 = 7",
    "trip_events",
)
def successful_manifest_days(spark, sf):
    return successful_days(parse_run_manifests(_manifest_texts(spark, sf)))
