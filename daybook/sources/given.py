"""The lake's tables as views over the given Parquet tables, for Spark and, as SQL text, for other engines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class View:
    base: str
    columns: dict[str, str]
    where: str | None = None

    def sql(self, string_type: str) -> str:
        items = ", ".join(f"{expr} AS {name}" for name, expr in self.columns.items())
        text = f"SELECT {items} FROM {self.base}" + (f" WHERE {self.where}" if self.where else "")
        return text.replace("{STR}", string_type)


def _city(i: str, u: str) -> str:
    return (
        f"CASE WHEN {i} % 20 = 0 THEN 'CITY_ZZ' WHEN {u} % 5 = 0 THEN 'BLR' WHEN {u} % 5 = 1 THEN 'MUM' "
        f"WHEN {u} % 5 = 2 THEN 'DEL' WHEN {u} % 5 = 3 THEN 'HYD' ELSE 'PUN' END"
    )


def _padded(expr: str, width: int) -> str:
    return f"lpad(cast({expr} AS {{STR}}), {width}, '0')"


_VEHICLE = f"concat('hash_veh_', {_padded('user_id', 6)})"
_JOB = (
    "CASE event_id % 6 WHEN 0 THEN 'export' WHEN 1 THEN 'curate' WHEN 2 THEN 'compact' "
    "WHEN 3 THEN 'erasure' WHEN 4 THEN 'trim' ELSE 'adhoc' END"
)

VIEWS: dict[str, View] = {
    "trip_events": View(
        "events",
        {
            "trip_id": "event_id",
            "vehicle_id_hash": _VEHICLE,
            "city_code": _city("event_id", "user_id"),
            "event_date": "cast(ts AS date)",
            "distance_km": "value / 10",
            "fare_amount": "value",
            "created_at": "ts",
        },
        "event_type <> 'view'",
    ),
    "anpr_camera_events": View(
        "events",
        {
            "event_id": "event_id",
            "vehicle_id_hash": _VEHICLE,
            "camera_id": f"concat('cam_', {_padded('event_id % 80', 3)})",
            "city_code": _city("event_id", "user_id"),
            "event_date": "cast(ts AS date)",
            "captured_at": "ts",
        },
        "event_type = 'view'",
    ),
    "accounts": View(
        "customer",
        {
            "account_id": "c_custkey",
            "email_hash": "md5(c_name)",
            "city_code": _city("c_custkey", "c_nationkey"),
            "status": "CASE WHEN c_custkey % 4 = 3 THEN 'suspended' ELSE 'active' END",
        },
    ),
    "reward_ledger": View(
        "orders",
        {
            "ledger_id": "o_orderkey",
            "account_id": "o_custkey",
            "city_code": _city("o_orderkey", "o_custkey"),
            "ledger_type": "CASE WHEN o_orderstatus = 'F' THEN 'penalty' ELSE 'reward' END",
            "amount": "cast(o_totalprice AS decimal(10,2))",
            "event_date": "cast(o_orderdate AS date)",
            "created_at": "o_orderdate",
        },
    ),
    "zone_occupancy_hourly": View(
        "events",
        {
            "occupancy_id": "event_id",
            "city_code": _city("event_id", "user_id"),
            "zone_id": f"concat('zone_', {_padded('event_id % 20', 2)})",
            "hour_ts": "cast(date_trunc('hour', ts) AS {NTZ})",
            "occupancy_pct": "value % 100",
        },
    ),
    "reference_feed_cache": View(
        "documents",
        {
            "cache_id": "doc_id",
            "provider": "source",
            "city_code": "CASE WHEN doc_id % 5 = 0 THEN 'BLR' WHEN doc_id % 5 = 1 THEN 'MUM' "
            "WHEN doc_id % 5 = 2 THEN 'DEL' WHEN doc_id % 5 = 3 THEN 'HYD' ELSE 'PUN' END",
            "payload_summary": "substr(text, 1, 40)",
            "fetched_date": "DATE '2001-01-01' + cast(doc_id % 149 AS int) * 10",
        },
    ),
    # Operational inputs, derived from the same tables so that they grow with them.
    "usage": View(
        "orders",
        {
            "query_id": "o_orderkey",
            "workgroup": "CASE o_custkey % 3 WHEN 0 THEN 'analytics' WHEN 1 THEN 'forecasting' ELSE 'audit' END",
            "ts": "o_orderdate",
            "bytes": "cast(cast(o_totalprice AS decimal(12,2)) * 30000 AS bigint)",
        },
    ),
    "run_log": View(
        "events",
        {
            "ts": "ts",
            "message": "CASE WHEN event_type = 'error' THEN concat('run ', cast(event_id AS {STR}), ' failed: no rows') "
            "ELSE concat('run ', cast(event_id AS {STR}), ' succeeded: ', cast(user_id AS {STR}), "
            "' row(s), checksum=', cast(event_id * 7 AS {STR}), ', duration=', "
            "cast(event_id % 90 AS {STR}), '.', " + _padded("user_id % 100", 2) + ", 's') END",
        },
    ),
    "job_runs": View(
        "events",
        {
            "name": f"concat({_JOB}, '/main/task-', cast(event_id AS {{STR}}))",
            "last_event": "ts",
        },
    ),
    "task_events": View(
        "events",
        {
            "task_id": "event_id",
            "last_status": "CASE WHEN event_type = 'view' THEN 'RUNNING' ELSE 'STOPPED' END",
            "stop_code": "CASE event_id % 5 WHEN 0 THEN 'TaskFailedToStart' WHEN 1 THEN 'EssentialContainerExited' "
            "WHEN 2 THEN 'ResourceInitializationError' WHEN 3 THEN 'UserInitiated' END",
            "exit_code_a": "CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 2 END",
            "exit_code_b": "CASE WHEN user_id % 7 = 0 THEN NULL ELSE user_id % 3 END",
        },
    ),
    "query_stats": View(
        "orders",
        {
            "query": "concat('query ', " + _padded("o_orderkey", 12) + ")",
            "query_class": "CASE WHEN o_orderstatus = 'F' THEN 'analytical' ELSE 'transactional' END",
            "calls": "o_custkey % 50 + 1",
            "total_exec_time": "o_totalprice",
        },
    ),
    "storage_metrics": View(
        "events",
        {
            "ts": "ts",
            "prefix": "CASE event_id % 4 WHEN 0 THEN 'raw' WHEN 1 THEN 'curated' WHEN 2 THEN 'athena-results/export' "
            "ELSE 'export-manifests' END",
            "bytes": "event_id * 1009 % 1000003",
        },
    ),
    "listing": View(
        "documents",
        {
            "path": "concat(CASE doc_id % 4 WHEN 0 THEN 'raw/' WHEN 1 THEN 'curated/' WHEN 2 THEN 'export-manifests/' "
            "ELSE 'athena-results/other/' END, cast(doc_id AS {STR}))",
            "bytes": "n_chars",
        },
    ),
    "erasure_requests": View(
        "events",
        {
            "identifier": f"CASE event_id % 11 WHEN 1 THEN '' WHEN 2 THEN concat('hash veh ', cast(user_id AS {{STR}})) "
            f"WHEN 3 THEN concat({_VEHICLE}, chr(10)) WHEN 4 THEN repeat('a', 120 + cast(user_id % 17 AS int)) "
            f"ELSE {_VEHICLE} END",
            "request_ref": "CASE event_id % 7 WHEN 1 THEN '' WHEN 2 THEN 'ab' "
            "WHEN 3 THEN repeat('r', 60 + cast(user_id % 9 AS int)) "
            "WHEN 4 THEN concat('REQ/', cast(event_id AS {STR})) ELSE concat('REQ-', cast(event_id AS {STR})) END",
            "jurisdiction": "CASE event_id % 5 WHEN 1 THEN 'IN' WHEN 2 THEN 'in' WHEN 3 THEN 'IND' ELSE '' END",
        },
    ),
    "partition_names": View(
        "events",
        {
            "name": "CASE event_id % 5 WHEN 0 THEN 'trip_events_default' "
            "WHEN 1 THEN concat('trip_events_y2024_m02_d', " + _padded("user_id % 40", 2) + ") "
            "ELSE concat('trip_events_y2024_m01_d', " + _padded("event_id % 31 + 1", 2) + ") END",
        },
    ),
}


def given(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A mapped table; filter and columns reach the Parquet scan."""
    v = VIEWS[name]
    rows = given(spark, folder, v.base)
    if v.where:
        rows = rows.filter(v.where)
    return rows.selectExpr(
        *(
            f"{expr.replace('{STR}', 'string').replace('{NTZ}', 'timestamp_ntz')} AS {column}"
            for column, expr in v.columns.items()
        )
    )


def view_sql(name: str) -> str:
    """The same view as ANSI SQL."""
    return VIEWS[name].sql("varchar").replace("{NTZ}", "timestamp")
