"""Where exported rows come from: a database table over JDBC, or a Parquet dataset of the same shape."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.changes import conform
from daybook.operators.reconcile import count_checksum_by_day
from daybook.schemas import TableSpec


class _Counted:
    """Per-day totals of a source that Spark can scan again: only the key and day columns are read."""

    def totals(self, first: dt.date, last: dt.date) -> DataFrame:
        return count_checksum_by_day(self.rows(first, last), self.spec.primary_key, self.spec.date_column)


@dataclass(frozen=True)
class ParquetSource(_Counted):
    """Rows of a Parquet dataset read with the declared schema.

    With ``keep_added`` the files' own schemas are merged, and columns that are not declared follow the declared ones.
    """

    spark: SparkSession
    path: str
    spec: TableSpec
    keep_added: bool = False

    def all_rows(self) -> DataFrame:
        if self.keep_added:
            rows = self.spark.read.option("mergeSchema", "true").parquet(self.path)
            return conform(rows, self.spec.schema, keep_added=True)
        return self.spark.read.schema(self.spec.schema).parquet(self.path).select(*self.spec.columns)

    def rows(self, first: dt.date, last: dt.date) -> DataFrame:
        return self.all_rows().filter(F.col(self.spec.date_column).between(first, last))


@dataclass(frozen=True)
class FrameSource(_Counted):
    """Rows of a DataFrame that already has the declared columns; ``keep_added`` as for ``ParquetSource``."""

    frame: DataFrame
    spec: TableSpec
    keep_added: bool = False

    def rows(self, first: dt.date, last: dt.date) -> DataFrame:
        if self.keep_added:
            rows = conform(self.frame, self.spec.schema, keep_added=True)
            return rows.filter(F.col(self.spec.date_column).between(first, last))
        return self.frame.filter(F.col(self.spec.date_column).between(first, last)).select(*self.spec.columns)


@dataclass(frozen=True)
class JdbcSource:
    """Rows of a database table. The day filter runs in the database; key ranges are read in parallel."""

    spark: SparkSession
    url: str
    table: str
    spec: TableSpec
    partitions: int = 16
    fetch_size: int = 1000
    properties: Mapping[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {"url": self.url, "fetchsize": str(self.fetch_size), **self.properties}

    def _where(self, first: dt.date, last: dt.date) -> str:
        return f"WHERE {self.spec.date_column} BETWEEN DATE '{first.isoformat()}' AND DATE '{last.isoformat()}'"

    def bounds_query(self, first: dt.date, last: dt.date) -> str:
        key = self.spec.primary_key
        return f"SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {self.table} {self._where(first, last)}"

    def totals_query(self, first: dt.date, last: dt.date) -> str:
        key, day = self.spec.primary_key, self.spec.date_column
        return (
            f"SELECT {day} AS event_date, COUNT(*) AS row_count, SUM({key}) AS checksum FROM {self.table} "
            f"{self._where(first, last)} GROUP BY {day}"
        )

    def totals(self, first: dt.date, last: dt.date) -> DataFrame:
        """Counted in the database; one row per day comes over."""
        found = self.spark.read.format("jdbc").options(**self.options()).option("query", self.totals_query(first, last))
        return found.load().select(
            F.col("event_date").cast("date").alias("event_date"),
            F.col("row_count").cast("bigint").alias("row_count"),
            F.col("checksum").cast("bigint").alias("checksum"),
        )

    def range_options(self, lo: int, hi: int) -> dict[str, str]:
        return {
            **self.options(),
            "dbtable": self.table,
            "partitionColumn": self.spec.primary_key,
            "lowerBound": str(lo),
            "upperBound": str(hi + 1),
            "numPartitions": str(self.partitions),
        }

    def rows(self, first: dt.date, last: dt.date) -> DataFrame:
        bounds = (
            self.spark.read.format("jdbc").options(**self.options())
            .option("query", self.bounds_query(first, last)).load().first()
        )
        if bounds is None or bounds[0] is None:
            return self.spark.createDataFrame([], self.spec.schema)
        table = self.spark.read.format("jdbc").options(**self.range_options(int(bounds[0]), int(bounds[1]))).load()
        return table.filter(F.col(self.spec.date_column).between(first, last)).select(
            *(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.spec.schema)
        )
