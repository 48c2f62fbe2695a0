"""Operational reports: storage, scan usage and cost, run times, query statistics, table inventory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.functions.values import exact_sum, run_seconds, without_trailing_slash
from daybook.schemas import TableSpec
from daybook.tables.storage import Storage, each

# Storage prefixes, scan limits in bytes, monthly budgets and prices in USD, job names,
# and the stop codes of a failed task.
STORAGE_PREFIXES = ("raw/", "curated/", "athena-results/export/", "export-manifests/")
SCAN_LIMITS = {"analytics": 5368709120, "forecasting": 5368709120, "audit": 10737418240}
MONTHLY_BUDGETS = {"analytics": 50, "forecasting": 50, "audit": 25}
USD_PER_TB = 5.0
BYTES_PER_TB = 1024**4
MIN_BILLED_BYTES = 10 * 1024**2
JOBS = ("export", "curate", "compact", "erasure", "trim")
FAILED_STOP_CODES = ("TaskFailedToStart", "EssentialContainerExited", "ResourceInitializationError")


def _day(ts: str) -> Column:
    return F.to_date(ts)


def sum_by_prefix(files: DataFrame, prefixes: Sequence[str] = STORAGE_PREFIXES) -> DataFrame:
    """Bytes under each prefix of a listing (``path, bytes``); a prefix without files reports zero."""
    spark = files.sparkSession
    prefix = F.lit(None)
    for p in prefixes:
        prefix = F.when(F.col("path").startswith(p), p).otherwise(prefix)
    totals = files.groupBy(prefix.alias("prefix")).agg(F.sum("bytes").alias("bytes"))
    named = spark.createDataFrame([(p,) for p in prefixes], "prefix STRING")
    return named.join(totals, "prefix", "left").select(
        without_trailing_slash(F.col("prefix")).alias("prefix"), F.coalesce("bytes", F.lit(0)).alias("bytes")
    )


def storage_bytes(spark: SparkSession, lake: str, prefixes: Sequence[str] = STORAGE_PREFIXES) -> DataFrame:
    """Bytes stored under each prefix of a lake, staged and hidden files included."""
    storage = Storage(spark)
    sizes = each(lambda p: storage.usage(f"{lake}/{p}")[0], prefixes)
    rows = spark.createDataFrame(list(zip(prefixes, sizes)), "prefix STRING, bytes BIGINT")
    return rows.select(without_trailing_slash(F.col("prefix")).alias("prefix"), "bytes")


def object_count(spark: SparkSession, lake: str, prefixes: Sequence[str]) -> DataFrame:
    storage = Storage(spark)
    counts = each(lambda p: storage.usage(f"{lake}/{p}")[1], prefixes)
    return spark.createDataFrame(list(zip(prefixes, counts)), "prefix STRING, objects BIGINT")


def publish_storage(spark: SparkSession, lake: str, at: dt.datetime, metrics: str | None = None) -> DataFrame:
    """Append the current storage bytes to the metrics table, by default the lake's own, and return them."""
    measured = storage_bytes(spark, lake).select(F.lit(at).alias("ts"), "prefix", "bytes")
    measured.write.mode("append").parquet(metrics or f"{lake}/metrics/storage")
    return measured


def storage_metrics(spark: SparkSession, lake: str, metrics: str | None = None) -> DataFrame:
    path = metrics or f"{lake}/metrics/storage"
    return spark.read.schema("ts TIMESTAMP, prefix STRING, bytes BIGINT").parquet(path)


def daily_max_by_prefix(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy(_day("ts").alias("day"), "prefix").agg(F.max("bytes").alias("bytes"))


def daily_scan_by_consumer(usage: DataFrame) -> DataFrame:
    return usage.groupBy(_day("ts").alias("day"), "workgroup").agg(F.sum("bytes").alias("bytes"))


def _per_consumer(values: Mapping[str, int]) -> Column:
    """The value of a row's consumer in one of the fixed tables above, null for any other."""
    found = F.lit(None).cast("bigint")
    for workgroup, value in values.items():
        found = F.when(F.col("workgroup") == workgroup, F.lit(value).cast("bigint")).otherwise(found)
    return found


def over_scan_limit(usage: DataFrame, limits: Mapping[str, int] = SCAN_LIMITS) -> DataFrame:
    """Queries that scanned more than their consumer may per query."""
    return usage.withColumn("scan_limit", _per_consumer(limits)).filter(F.col("bytes") > F.col("scan_limit"))


def monthly_cost(usage: DataFrame, budgets: Mapping[str, int] = MONTHLY_BUDGETS) -> DataFrame:
    """Scan cost per consumer and month against its budget."""
    billed = F.sum(F.greatest("bytes", F.lit(MIN_BILLED_BYTES)))
    cost = F.col("billed_bytes").cast("double") / F.lit(float(BYTES_PER_TB)) * F.lit(USD_PER_TB)
    per_month = usage.groupBy("workgroup", F.to_date(F.date_trunc("month", "ts")).alias("month")).agg(
        billed.alias("billed_bytes")
    )
    return (
        per_month.withColumn("budget_usd", _per_consumer(budgets)).filter("budget_usd IS NOT NULL")
        .withColumn("cost_usd", cost)
        .withColumn("over_budget", F.col("cost_usd") > F.col("budget_usd"))
    )


def seconds_by_day(lines: DataFrame) -> DataFrame:
    """Total run seconds and number of runs per day from log lines (``ts, message``)."""
    return (
        lines.select(_day("ts").alias("day"), run_seconds(F.col("message")).alias("seconds"))
        .filter("seconds IS NOT NULL")
        .groupBy("day")
        .agg(F.sum("seconds").cast("double").alias("total_seconds"), F.count(F.lit(1)).alias("run_count"))
    )


def recent_runs(runs: DataFrame, n: int = 5, jobs: Sequence[str] = JOBS) -> DataFrame:
    """The latest runs of each job (``name, last_event``); the job is the first part of the name.

    Ranking keeps at most ``n`` rows per job in each map task before anything is shuffled.
    """
    rank = F.row_number().over(W.partitionBy("job").orderBy(F.desc("last_event"), "name"))
    return (
        runs.withColumn("job", F.substring_index("name", "/", 1))
        .filter(F.col("name").contains("/") & F.col("job").isin(*jobs))
        .withColumn("rank", rank)
        .filter(F.col("rank") <= n)
        .select("job", "rank", "name", "last_event")
    )


def failed_tasks(events: DataFrame) -> DataFrame:
    """Stopped tasks with a failure stop code and a container that exited non-zero or never ran."""
    failed = F.exists("containers", lambda c: c["exit_code"].isNull() | (c["exit_code"] != 0))
    return events.filter(
        (F.col("last_status") == "STOPPED") & F.col("stop_code").isin(*FAILED_STOP_CODES) & failed
    )


def top_queries(stats: DataFrame, n: int = 20) -> DataFrame:
    return stats.orderBy(F.desc("total_exec_time"), "query").limit(n)


def exec_time_share(stats: DataFrame) -> DataFrame:
    """Analytical and transactional part of the total execution time (``query_class, total_exec_time``)."""
    def part(name: str) -> Column:
        return F.coalesce(exact_sum(F.when(F.col("query_class") == name, F.col("total_exec_time"))), F.lit(0.0))

    classes = ("analytical", "transactional")
    totals = stats.agg(*(part(c).alias(c) for c in classes))
    both = totals[classes[0]] + totals[classes[1]]
    rows = F.array(
        *(F.struct(F.lit(c).alias("query_class"), F.col(c).alias("seconds"),
                   F.when(both > 0, F.col(c) / both).alias("share")) for c in classes)
    )
    return totals.select(F.inline(rows))


@dataclass(frozen=True)
class Inventoried:
    spec: TableSpec
    rows: DataFrame
    size_bytes: int = 0


def table_inventory(tables: Sequence[Inventoried]) -> DataFrame:
    """One row per table: rows, days, growth per day, size, key, partition column, personal data."""
    out = None
    for t in tables:
        has_day = t.spec.date_column in t.rows.columns
        days = F.count_distinct(t.spec.date_column) if has_day else F.lit(None).cast("bigint")
        row = t.rows.agg(F.count(F.lit(1)).alias("row_count"), days.alias("days")).select(
            F.lit(t.spec.name).alias("table_name"),
            "row_count",
            "days",
            F.when(F.col("days") > 0, F.col("row_count") / F.col("days")).alias("rows_per_day"),
            F.lit(t.size_bytes).cast("bigint").alias("size_bytes"),
            F.lit(t.spec.primary_key).alias("primary_key"),
            F.lit(t.spec.date_column if has_day else None).cast("string").alias("partition_column"),
            F.lit(t.spec.identifier is not None).alias("personal_data"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def by_rows(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy(F.desc("row_count"), "table_name")


def by_size(inventory: DataFrame) -> DataFrame:
    return inventory.orderBy(F.desc("size_bytes"), "table_name")


def file_counts(files: DataFrame) -> DataFrame:
    """Files, bytes and mean file size per day of a table's ``files()``."""
    return files.groupBy(F.col("day").alias("event_date")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.avg("bytes").alias("mean_bytes")
    )
