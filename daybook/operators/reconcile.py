"""Row counts and key checksums, and the comparison of two sides of a hop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.values import key_sum


def count_checksum(rows: DataFrame, key: str) -> DataFrame:
    """One row: number of rows and sum of keys, zero for no rows."""
    return rows.agg(F.count(F.lit(1)).alias("row_count"), key_sum(F.col(key)).alias("checksum"))


def count_checksum_by_day(rows: DataFrame, key: str, day: str = "event_date") -> DataFrame:
    return rows.groupBy(F.col(day).alias("event_date")).agg(
        F.count(F.lit(1)).alias("row_count"), key_sum(F.col(key)).alias("checksum")
    )


def with_empty_days(totals: DataFrame, calendar: DataFrame) -> DataFrame:
    """Totals for every day of the calendar, zeros where there were no rows."""
    return calendar.join(totals, "event_date", "left").select(
        "event_date",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.coalesce("checksum", F.lit(0)).alias("checksum"),
    )


def reconcile(source: DataFrame, lake: DataFrame) -> DataFrame:
    """Both sides per day. A day matches only when its count and its checksum are both equal."""
    s, k = source.alias("s"), lake.alias("k")
    joined = s.join(k, F.col("s.event_date").eqNullSafe(F.col("k.event_date")), "full_outer")

    def side(alias: str, name: str) -> Column:
        return F.coalesce(F.col(f"{alias}.{name}"), F.lit(0).cast("bigint"))

    both = joined.select(
        F.coalesce("s.event_date", "k.event_date").alias("event_date"),
        side("s", "row_count").alias("source_count"),
        side("s", "checksum").alias("source_checksum"),
        side("k", "row_count").alias("lake_count"),
        side("k", "checksum").alias("lake_checksum"),
    )
    return both.withColumn(
        "matched",
        (F.col("source_count") == F.col("lake_count")) & (F.col("source_checksum") == F.col("lake_checksum")),
    )


def mismatch_text() -> Column:
    """Error of an unmatched day, NULL for a matched one."""
    return F.when(
        ~F.col("matched"),
        F.format_string(
            "reconciliation mismatch: source has %d row(s) with checksum %d, lake has %d row(s) with checksum %d",
            "source_count", "source_checksum", "lake_count", "lake_checksum",
        ),
    )
