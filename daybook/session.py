"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Rebalanced writes aim at this much shuffle data per output file; skewed days and cities are split
# down to it and small ones are merged up to it.
FILE_TARGET = "256m"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": FILE_TARGET,
    # A small nightly batch still opens its files from several tasks at once.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.files.maxPartitionBytes": FILE_TARGET,
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
}

# On one machine, plain local files without checksum side files: half as many files to create.
LOCAL_SETTINGS = {"spark.hadoop.fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem"}


def build_session(
    app: str, master: str | None = None, shuffle_partitions: int | None = None, **extra: str
) -> SparkSession:
    """Session with ``SETTINGS``; leave ``master`` unset on a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    local = LOCAL_SETTINGS if master and master.startswith("local") else {}
    for key, value in {**SETTINGS, **local, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
