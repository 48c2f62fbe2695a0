"""Operational inputs: job logs, query statistics, object listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines ``<timestamp> <message>`` as ``ts, message``; a line without a timestamp has a null one."""
    lines = spark.read.text(path)
    stamp = F.substring_index("value", " ", 1)
    ts = F.try_to_timestamp(stamp).cast("timestamp_ntz")
    return lines.select(
        ts.alias("ts"),
        F.when(ts.isNull(), F.col("value")).otherwise(F.expr("substring(value, locate(' ', value) + 1)")).alias("message"),
    )


def scan_query_stats(spark: SparkSession, path: str) -> DataFrame:
    schema = "query STRING, calls BIGINT, total_exec_time DOUBLE, mean_exec_time DOUBLE, rows BIGINT"
    return spark.read.schema(schema).json(path)


def scan_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Files below ``paths`` with their sizes. Spark lists them in parallel and opens none.

    Readers do not see hidden or empty files; ``storage_bytes`` counts those too.
    """
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
        .select("path", F.col("length").alias("bytes"))
    )
