"""Day partitions: which exist, which are missing, which may be dropped and on what evidence."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.days import date_spine, partition_date, partition_name
from daybook.operators.evidence import NO_MANIFEST, NOT_SUCCESSFUL, PARSE_ERROR
from daybook.tables.daytable import DayTable
from daybook.tables.keys import without


def named(days: DataFrame) -> DataFrame:
    """Days with their partition names, ordered by name."""
    return days.select("event_date", partition_name(F.col("event_date")).alias("name")).orderBy("name")


def dated(names: DataFrame) -> DataFrame:
    """Day partitions among ``names``; the catch-all and foreign names drop out."""
    return names.withColumn("event_date", partition_date(F.col("name"))).filter("event_date IS NOT NULL")


def stored_days(table: DayTable) -> DataFrame:
    """Days of which a table has files, from the listing alone: Spark lists in parallel and opens no file."""
    return table.live_files().select(F.col("day").alias("event_date")).distinct()


def missing_partitions(days: DataFrame, existing: DataFrame) -> DataFrame:
    return days.join(existing.select("event_date"), "event_date", "left_anti")


def present_partitions(days: DataFrame, existing: DataFrame) -> DataFrame:
    return days.join(existing.select("event_date"), "event_date", "left_semi")


def missing_future(existing: DataFrame, today: dt.date, lookahead: int) -> DataFrame:
    """Days from ``today`` on, ``lookahead`` of them, that have no partition yet."""
    last = today + dt.timedelta(days=lookahead - 1)
    return missing_partitions(date_spine(existing.sparkSession, today, last), existing)


def before_cutoff(days: DataFrame, today: dt.date, retention_days: int) -> DataFrame:
    """Days strictly older than the retention window; the cutoff day itself stays."""
    return days.filter(F.col("event_date") < F.lit(today - dt.timedelta(days=retention_days)))


def rows_without_partition(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows that fall into the catch-all because their day has no partition."""
    return without(rows, days, "event_date")


def retention_plan(days: DataFrame, manifests: DataFrame) -> DataFrame:
    """Drop or skip for each old day. Only a readable manifest that reports success allows a drop."""
    evidence = manifests.select(
        F.col("run_date").alias("event_date"), "parsed", "success", F.col("row_count").alias("manifest_rows"),
        F.lit(True).alias("found"),
    )
    reason = (
        F.when(F.col("found").isNull(), NO_MANIFEST)
        .when(~F.col("parsed"), PARSE_ERROR)
        .when(~F.col("success"), NOT_SUCCESSFUL)
    )
    return (
        days.join(evidence, "event_date", "left")
        .withColumn("reason", reason)
        .select(
            "event_date",
            F.when(F.col("reason").isNull(), "drop").otherwise("skip").alias("action"),
            "reason",
            "manifest_rows",
        )
    )


def counted(days: DataFrame, rows: DataFrame) -> DataFrame:
    """Row count per listed day, zero for empty partitions."""
    counts = rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("row_count"))
    return days.join(counts, "event_date", "left").fillna(0, ["row_count"])


def oldest_kept(today: dt.date, keep_days: int = 0, keep_months: int = 0) -> dt.date:
    """First day that a retention period still covers."""
    day = today - dt.timedelta(days=keep_days)
    months = day.year * 12 + day.month - 1 - keep_months
    year, month = divmod(months, 12)
    return dt.date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))
