"""Operational reports and screening."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.catalog.registry import SampleLake, exported, query, trips
from daybook.operators import erasure, evidence, reports
from daybook.schemas import (
    ACCOUNTS,
    ANPR_CAMERA_EVENTS,
    REFERENCE_FEED_CACHE,
    REWARD_LEDGER,
    TRIP_EVENTS,
    ZONE_OCCUPANCY_HOURLY,
)
from daybook.sources.given import given, view
from daybook.sources.operations import scan_query_stats, scan_run_log
from daybook.tables.storage import Storage, write_texts


@query("scan_run_log", "SELECT ts, message FROM run_log", "run_log")
def run_log(spark, sf):
    lines = f"{SampleLake(spark, 'log').root}/lines"
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    view(spark, sf, "run_log").select(F.concat(stamp, F.lit(" "), "message")).write.text(lines)
    return scan_run_log(spark, lines)


@query(
    "scan_query_stats",
    """SELECT query, calls, total_exec_time, total_exec_time / calls AS mean_exec_time, calls * 3 AS rows
    FROM query_stats""",
    "query_stats",
)
def query_stats(spark, sf):
    path = f"{SampleLake(spark, 'stats').root}/stats"
    stats = view(spark, sf, "query_stats").select(
        "query",
        "calls",
        "total_exec_time",
        (F.col("total_exec_time") / F.col("calls")).alias("mean_exec_time"),
        (F.col("calls") * 3).alias("rows"),
    )
    stats.write.json(path)
    return scan_query_stats(spark, path)


def _listed_texts(spark, sf) -> str:
    """A lake folder with one object per document, whose bytes are those of its text; some under no known prefix."""
    root = SampleLake(spark, "objects").root
    prefix = (
        F.when(F.col("doc_id") % 5 == 0, "raw/").when(F.col("doc_id") % 5 == 1, "curated/")
        .when(F.col("doc_id") % 5 == 2, "export-manifests/").when(F.col("doc_id") % 5 == 3, "athena-results/export/")
        .otherwise("elsewhere/")
    )
    texts = given(spark, sf, "documents").filter("doc_id IS NOT NULL").select(
        F.concat(prefix, (F.col("doc_id") % 7).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        F.coalesce("text", F.lit("")).alias("body"),
    )
    write_texts(texts, root)
    return root


_STORED = """SELECT v.prefix, cast(coalesce(sum(strlen(d.text)), 0) AS bigint) AS bytes
    FROM (VALUES ('raw', 0), ('curated', 1), ('export-manifests', 2), ('athena-results/export', 3)) v(prefix, part)
    LEFT JOIN documents d ON d.doc_id % 5 = v.part GROUP BY v.prefix"""


@query("write_storage_metrics", _STORED)
def storage_metrics(spark, sf):
    lake, metrics = _listed_texts(spark, sf), f"{SampleLake(spark, 'metrics').root}/storage"
    reports.publish_storage(spark, lake, dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc), metrics)
    return reports.storage_metrics(spark, lake, metrics).select("prefix", "bytes")


@query("storage_by_prefix", _STORED)
def storage_by_prefix(spark, sf):
    return reports.storage_bytes(spark, _listed_texts(spark, sf))


@query(
    "bytes_by_prefix",
    """SELECT v.prefix, cast(coalesce(sum(l.bytes), 0) AS bigint) AS bytes
    FROM (VALUES ('raw'), ('curated'), ('athena-results/export'), ('export-manifests')) v(prefix)
    LEFT JOIN listing l ON starts_with(l.path, concat(v.prefix, '/')) GROUP BY v.prefix""",
    "listing",
)
def bytes_by_prefix(spark, sf):
    return reports.sum_by_prefix(view(spark, sf, "listing"))


@query(
    "bytes_by_prefix_daily_max",
    "SELECT cast(ts AS date) AS day, prefix, max(bytes) AS bytes FROM storage_metrics GROUP BY 1, 2",
    "storage_metrics",
)
def daily_max(spark, sf):
    return reports.daily_max_by_prefix(view(spark, sf, "storage_metrics"))


@query(
    "scan_bytes_by_consumer_daily",
    "SELECT cast(ts AS date) AS day, workgroup, cast(sum(bytes) AS bigint) AS bytes FROM usage GROUP BY 1, 2",
    "usage",
)
def daily_scan(spark, sf):
    return reports.daily_scan_by_consumer(view(spark, sf, "usage"))


@query(
    "over_scan_limit",
    """SELECT u.query_id, u.workgroup, u.ts, u.bytes, l.scan_limit FROM usage u
    JOIN (VALUES ('analytics', 5368709120), ('forecasting', 5368709120), ('audit', 10737418240))
      l(workgroup, scan_limit) ON u.workgroup = l.workgroup WHERE u.bytes > l.scan_limit""",
    "usage",
)
def over_limit(spark, sf):
    return reports.over_scan_limit(view(spark, sf, "usage"))


@query(
    "monthly_cost_vs_budget",
    """, cost AS (SELECT workgroup, cast(date_trunc('month', ts) AS date) AS month,
      cast(sum(greatest(bytes, 10485760)) AS bigint) AS billed_bytes FROM usage GROUP BY 1, 2)
    SELECT c.workgroup, c.month, c.billed_bytes, cast(b.budget_usd AS bigint) AS budget_usd,
      cast(c.billed_bytes AS double) / cast(1099511627776 AS double) * cast(5 AS double) AS cost_usd,
      cast(c.billed_bytes AS double) / cast(1099511627776 AS double) * cast(5 AS double) > b.budget_usd AS over_budget
    FROM cost c JOIN (VALUES ('analytics', 50), ('forecasting', 50), ('audit', 25)) b(workgroup, budget_usd)
      ON b.workgroup = c.workgroup""",
    "usage",
)
def monthly_cost(spark, sf):
    return reports.monthly_cost(view(spark, sf, "usage"))


@query(
    "run_seconds_by_day",
    r"""SELECT cast(ts AS date) AS day,
      cast(sum(cast(regexp_extract(message, 'duration=([0-9.]+)s', 1) AS decimal(18,4))) AS double) AS total_seconds,
      count(*) AS run_count
    FROM run_log WHERE regexp_extract(message, 'duration=([0-9.]+)s', 1) <> '' GROUP BY 1""",
    "run_log",
)
def seconds_by_day(spark, sf):
    return reports.seconds_by_day(view(spark, sf, "run_log"))


@query(
    "recent_runs_per_job",
    """SELECT job, rank, name, last_event FROM (SELECT split_part(name, '/', 1) AS job, name, last_event,
      cast(row_number() OVER (PARTITION BY split_part(name, '/', 1) ORDER BY last_event DESC, name) AS integer) AS rank
      FROM job_runs) WHERE rank <= 5 AND job IN ('export', 'curate', 'compact', 'erasure', 'trim')""",
    "job_runs",
)
def recent_runs(spark, sf):
    return reports.recent_runs(view(spark, sf, "job_runs"))


@query(
    "failed_task_events",
    """SELECT task_id, stop_code FROM task_events WHERE last_status = 'STOPPED'
      AND stop_code IN ('TaskFailedToStart', 'EssentialContainerExited', 'ResourceInitializationError')
      AND (exit_code_a IS NULL OR exit_code_a <> 0 OR exit_code_b IS NULL OR exit_code_b <> 0)""",
    "task_events",
)
def failed_task_events(spark, sf):
    containers = F.array(*(F.struct(F.col(c).alias("exit_code")) for c in ("exit_code_a", "exit_code_b")))
    events = view(spark, sf, "task_events").withColumn("containers", containers)
    return reports.failed_tasks(events).select("task_id", "stop_code")


@query(
    "top20_queries",
    """SELECT query, query_class, calls, total_exec_time FROM query_stats
    ORDER BY total_exec_time DESC, query LIMIT 20""",
    "query_stats",
)
def top20(spark, sf):
    return reports.top_queries(view(spark, sf, "query_stats"))


@query(
    "exec_time_share",
    """, t AS (SELECT query_class, cast(sum(cast(total_exec_time AS decimal(18,4))) AS double) AS seconds
      FROM query_stats GROUP BY query_class)
    SELECT query_class, seconds,
      seconds / ((SELECT seconds FROM t WHERE query_class = 'analytical')
               + (SELECT seconds FROM t WHERE query_class = 'transactional')) AS share FROM t""",
    "query_stats",
)
def time_share(spark, sf):
    return reports.exec_time_share(view(spark, sf, "query_stats"))


# The six tables of the inventory, with the given table that each is stored in.
INVENTORIED = (
    (TRIP_EVENTS, "events"), (ANPR_CAMERA_EVENTS, "events"), (ZONE_OCCUPANCY_HOURLY, "events"), (REWARD_LEDGER, "orders"),
    (REFERENCE_FEED_CACHE, "documents"), (ACCOUNTS, "customer"),
)
_VIEWS = " ".join(spec.name for spec, _ in INVENTORIED)


def _inventory(spark, sf, sized: bool):
    storage = Storage(spark)
    return reports.table_inventory(
        [
            reports.Inventoried(spec, view(spark, sf, spec.name), storage.usage(f"{sf}/{base}.parquet")[0] if sized else 0)
            for spec, base in INVENTORIED
        ]
    )


def _inventory_sql(spec) -> str:
    has_day = spec.date_column in spec.columns
    days = f"count(DISTINCT {spec.date_column})" if has_day else "cast(NULL AS bigint)"
    return f"""SELECT '{spec.name}' AS table_name, count(*) AS row_count, {days} AS days,
    count(*) / {days} AS rows_per_day, '{spec.primary_key}' AS primary_key,
    {f"'{spec.date_column}'" if has_day else "cast(NULL AS varchar)"} AS partition_column,
    {str(spec.identifier is not None).lower()} AS personal_data FROM {spec.name}"""


@query("table_inventory", " UNION ALL ".join(_inventory_sql(spec) for spec, _ in INVENTORIED), _VIEWS)
def table_inventory(spark, sf):
    return _inventory(spark, sf, sized=False).drop("size_bytes")


@query(
    "tables_by_rows",
    " UNION ALL ".join(f"SELECT '{s.name}' AS table_name, count(*) AS row_count FROM {s.name}" for s, _ in INVENTORIED),
    _VIEWS,
)
def tables_by_rows(spark, sf):
    return reports.by_rows(_inventory(spark, sf, sized=False)).select("table_name", "row_count")


@query("tables_by_size")
def tables_by_size(spark, sf):
    return reports.by_size(_inventory(spark, sf, sized=True)).select("table_name", "size_bytes")


@query(
    "manifest_object_count",
    """SELECT 'export-manifests/' AS prefix, cast(2 * count(DISTINCT event_date) + 1 AS bigint) AS objects FROM trip_events
    UNION ALL SELECT 'export-manifests/trim/', 0""",
    "trip_events",
)
def manifest_object_count(spark, sf):
    return reports.object_count(
        spark, exported(spark, sf).root, ["export-manifests/", "export-manifests/trim/"]
    )


@query(
    "screen_erasure_requests",
    r"""SELECT identifier, request_ref, jurisdiction, reason, reason IS NULL AS accepted FROM (SELECT *,
      CASE WHEN identifier = '' OR request_ref = '' THEN 'both required'
        WHEN NOT regexp_full_match(identifier, '[A-Za-z0-9_]{1,128}') THEN 'identifier'
        WHEN NOT regexp_full_match(request_ref, '[A-Za-z0-9._-]{3,64}') THEN 'request_ref'
        WHEN jurisdiction <> '' AND NOT regexp_full_match(jurisdiction, '[A-Z]{2}') THEN 'jurisdiction' END AS reason
      FROM erasure_requests)""",
    "erasure_requests",
)
def screen(spark, sf):
    return erasure.screen(view(spark, sf, "erasure_requests"))


@query(
    "backfill_totals",
    """, r AS (SELECT count(*) AS n, day(event_date) % 5 <> 0 AS ok FROM trip_events GROUP BY event_date)
    SELECT cast(sum(n) AS bigint) AS total_rows, cast(sum(n * 0.5) AS double) AS total_duration_seconds,
      cast(count(*) FILTER (WHERE ok) AS integer) AS success_count,
      cast(count(*) FILTER (WHERE NOT ok) AS integer) AS failure_count FROM r""",
    "trip_events",
)
def totals(spark, sf):
    results = trips(spark, sf).groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count",
        (F.col("row_count") * 0.5).cast("double").alias("duration_seconds"),
        (F.dayofmonth("event_date") % 5 != 0).alias("success"),
    )
    return evidence.backfill_totals(results)


@query(
    "all_succeeded",
    """SELECT vehicle_id_hash AS request_ref, bool_and(ok) AS success FROM (
      SELECT vehicle_id_hash, count(*) % 2 = 0 AS ok FROM trip_events GROUP BY 1
      UNION ALL SELECT vehicle_id_hash, count(*) % 3 <> 0 FROM anpr_camera_events GROUP BY 1) GROUP BY 1""",
    "trip_events anpr_camera_events",
)
def every_table(spark, sf):
    def results(table: str, ok):
        counts = view(spark, sf, table).groupBy("vehicle_id_hash").agg(F.count(F.lit(1)).alias("n"))
        return counts.select(F.col("vehicle_id_hash").alias("request_ref"), ok.alias("success"))

    n = F.col("n")
    return erasure.all_succeeded(
        results("trip_events", n % 2 == 0).unionByName(results("anpr_camera_events", n % 3 != 0))
    )
