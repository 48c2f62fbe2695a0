"""Manifests: the JSON records that jobs leave as evidence, written and read back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.tables.storage import Storage, each, write_texts

ROOT = "export-manifests"

RUN_SCHEMA = (
    "`table` STRING, run_date STRING, run_id STRING, row_count BIGINT, checksum BIGINT, "
    "duration_seconds DOUBLE, generated_at TIMESTAMP, success BOOLEAN, error STRING"
)
DAY_RESULT = (
    "STRUCT<date: STRING, row_count: BIGINT, checksum: BIGINT, duration_seconds: DOUBLE, "
    "success: BOOLEAN, error: STRING>"
)
BACKFILL_SCHEMA = (
    f"start_date STRING, end_date STRING, run_id STRING, dates ARRAY<{DAY_RESULT}>, total_rows BIGINT, "
    "total_duration_seconds DOUBLE, success_count INT, failure_count INT, generated_at TIMESTAMP"
)
ERASURE_SCHEMA = (
    "request_ref STRING, identifier STRING, jurisdiction STRING, "
    "tables ARRAY<STRUCT<database: STRING, `table`: STRING, rows_before: BIGINT, rows_after_delete: BIGINT, "
    "pre_erasure_snapshot_id: STRING, time_travel_blocked: BOOLEAN, success: BOOLEAN, error: STRING>>, "
    "started_at TIMESTAMP, finished_at TIMESTAMP, duration_seconds DOUBLE, success BOOLEAN, error STRING"
)
PARTITION_RESULT = "STRUCT<date: STRING, row_count: BIGINT, reason: STRING>"
TRIM_SCHEMA = (
    "run_date STRING, run_id STRING, retention_days INT, partitions_created ARRAY<STRING>, "
    f"partitions_dropped ARRAY<{PARTITION_RESULT}>, partitions_skipped ARRAY<{PARTITION_RESULT}>, "
    "duration_seconds DOUBLE, generated_at TIMESTAMP, success BOOLEAN, error STRING"
)

# Why a day may not be dropped.
NO_MANIFEST = "no export manifest found"
PARSE_ERROR = "manifest parse error"
NOT_SUCCESSFUL = "manifest reports success=false"


def run_path(run_date: str, table: str) -> str:
    return f"{ROOT}/{run_date}/{table}.json"


def backfill_path(start: str, end: str) -> str:
    return f"{ROOT}/backfill/{start}_{end}/summary.json"


def erasure_path(start_day: str, request_ref: str | Column) -> str | Column:
    if isinstance(request_ref, Column):
        return F.concat(F.lit(f"{ROOT}/erasure/{start_day}/"), request_ref, F.lit(".json"))
    return f"{ROOT}/erasure/{start_day}/{request_ref}.json"


def trim_path(run_date: str) -> str:
    return f"{ROOT}/trim/{run_date}/summary.json"


def write(spark: SparkSession, lake: str, schema: str, records: Iterable[tuple[str, dict]]) -> int:
    """One file per (path, record); a re-run of the same key overwrites. Records are per day or request."""
    records = list(records)
    if not records:
        return 0
    fields = T.StructType.fromDDL(schema)
    numbered = T.StructType().add("position", T.IntegerType()).add("record", fields)
    frame = spark.createDataFrame([(i, record) for i, (_, record) in enumerate(records)], numbered)
    bodies = frame.select("position", F.to_json("record", {"pretty": "true"}).alias("body")).collect()
    storage = Storage(spark)
    each(lambda r: storage.write_text(f"{lake}/{records[r.position][0]}", r.body), bodies)
    return len(records)


def write_frame(lake: str, schema: str, records: DataFrame) -> int:
    """Like ``write`` for any number of records: rows of ``path`` and the record's columns, written by the tasks."""
    fields = (F.col(f.name).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(schema))
    return write_texts(records.select("path", F.to_json(F.struct(*fields), {"pretty": "true"}).alias("body")), lake)


def found_run_manifests(spark: SparkSession, lake: str, table: str) -> list:
    """Paths of a table's run manifests, one per run date."""
    return Storage(spark).glob(f"{lake}/{ROOT}/[0-9]*/{table}.json")


def scan_run_manifests(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """A table's run manifests: ``run_date`` from the path, ``parsed`` false where the text is not one.

    File names come from a listing because readers skip files of zero bytes, and such a file is
    broken evidence rather than missing evidence.
    """
    found = found_run_manifests(spark, lake, table)
    listing = spark.createDataFrame(
        [(e.path.rsplit("/", 2)[1], e.path) for e in found], "run_date STRING, path STRING"
    )
    filled = [e.path for e in found if e.bytes]
    if filled:
        texts = spark.read.text(filled, wholetext=True).select(
            F.element_at(F.split("_metadata.file_path", "/"), -2).alias("run_date"), "value"
        )
    else:
        texts = spark.createDataFrame([], "run_date STRING, value STRING")
    return parse_run_manifests(listing.join(texts, "run_date", "left"))


def parse_run_manifests(texts: DataFrame) -> DataFrame:
    """``run_date, value`` to typed columns. Text after the record, wrong types and non-objects do not parse."""
    schema = RUN_SCHEMA + ", corrupt STRING"
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"})
    alone = F.json_array_length(F.concat(F.lit("["), F.col("value"), F.lit("]"))) == 1
    parsed = texts.withColumn("m", record).withColumn(
        "parsed",
        F.coalesce(F.col("m").isNotNull() & F.col("m.corrupt").isNull() & alone, F.lit(False)),
    )
    keep = F.when(F.col("parsed"), F.col("m"))
    return parsed.select(
        F.try_to_date("run_date", "yyyy-MM-dd").alias("run_date"),
        "parsed",
        keep["table"].alias("table"),
        keep["run_id"].alias("run_id"),
        keep["row_count"].alias("row_count"),
        keep["checksum"].alias("checksum"),
        keep["duration_seconds"].alias("duration_seconds"),
        keep["generated_at"].alias("generated_at"),
        F.when(F.col("parsed"), F.coalesce(F.col("m.success"), F.lit(False))).alias("success"),
        keep["error"].alias("error"),
    )


def successful_days(manifests: DataFrame) -> DataFrame:
    return manifests.filter("parsed AND success").select(F.col("run_date").alias("event_date"))


def backfill_totals(results: DataFrame) -> DataFrame:
    """Totals over per-day results; a failed day still adds the rows the lake holds for it."""
    return results.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("total_rows"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0.0)).alias("total_duration_seconds"),
        F.count_if(F.col("success")).cast("int").alias("success_count"),
        F.count_if(~F.col("success")).cast("int").alias("failure_count"),
    )


def utc(now: dt.datetime | None = None) -> dt.datetime:
    return (now or dt.datetime.now(dt.timezone.utc)).astimezone(dt.timezone.utc)
