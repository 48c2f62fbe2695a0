"""One hop of rows from a source into a day table, reconciled per day and recorded in manifests."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import evidence
from daybook.operators.reconcile import count_checksum_by_day, mismatch_text, reconcile
from daybook.tables.daytable import Commit, DayTable

RESULT_SCHEMA = (
    "event_date DATE, row_count BIGINT, checksum BIGINT, duration_seconds DOUBLE, success BOOLEAN, error STRING"
)

UNFINISHED = "the run has not finished"


class RunFailed(RuntimeError):
    """At least one day of a run did not come through."""


@dataclass
class DayResult:
    event_date: dt.date
    row_count: int = 0
    checksum: int = 0
    duration_seconds: float = 0.0
    success: bool = False
    error: str | None = None


@dataclass
class RunReport:
    run_id: str
    table: str
    generated_at: dt.datetime
    results: list[DayResult] = field(default_factory=list)

    @property
    def failed(self) -> list[DayResult]:
        return [r for r in self.results if not r.success]

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (r.event_date, r.row_count, r.checksum, r.duration_seconds, r.success, r.error) for r in self.results
        ]
        return spark.createDataFrame(rows, RESULT_SCHEMA)

    def raise_if_failed(self) -> RunReport:
        if self.failed:
            raise RunFailed(f"{self.table}: {len(self.failed)} of {len(self.results)} day(s) failed")
        return self


def copy_days(
    spark: SparkSession,
    rows_between: Callable[[dt.date, dt.date], DataFrame],
    target: DayTable,
    lake: str,
    days: Sequence[dt.date],
    rebalance: bool = True,
    run_id: str | None = None,
    now: dt.datetime | None = None,
    totals_between: Callable[[dt.date, dt.date], DataFrame] | None = None,
    write: Callable[[DataFrame, Sequence[dt.date]], Commit] | None = None,
) -> RunReport:
    """Replace ``days`` of ``target``, compare both sides per day, write one manifest per day.

    ``totals_between`` counts the source side per day; without it the rows themselves are counted, those of a single
    day while they are written. ``write`` makes rows the contents of the given days in its own way.

    All days go through one write. When that fails, one aggregate over the partition columns finds the days with rows
    that cannot be stored; they are set aside, and the others are written again. A source that cannot answer that
    question either is down, and all its days fail at once. Only where the aggregate finds nothing, so that some value
    deep in a row is to blame, are days split in halves until the bad ones stand alone. Every day gets a manifest,
    failed ones too. Before a day is touched its manifest says that the run has not finished, so older
    evidence of success never outlives a failure, or a driver that is lost on the way.
    """
    report = RunReport(run_id or str(uuid.uuid4()), target.spec.name, evidence.utc(now))
    target.create(now)
    pending = [sorted(set(days))]
    _write_manifests(spark, lake, report, [DayResult(d, error=UNFINISHED) for d in pending[0]])
    while pending:
        chunk = pending.pop()
        if not chunk:
            continue
        started = time.monotonic()
        try:
            results = _copy_chunk(spark, rows_between, totals_between, target, chunk, rebalance, now, write)
        except Exception as failure:  # noqa: BLE001 - any failure of a day is recorded, not raised
            bad = _quarantined(rows_between, target, chunk) if len(chunk) > 1 else dict.fromkeys(chunk, _first_line(failure))
            if bad is None:
                bad = dict.fromkeys(chunk, _first_line(failure))
            elif not bad:
                middle = len(chunk) // 2
                pending += [chunk[middle:], chunk[:middle]]
                continue
            pending.append([d for d in chunk if d not in bad])
            chunk = sorted(bad)
            results = [DayResult(d, error=bad[d]) for d in chunk]
        # One job carries the chunk, so its time is shared out evenly.
        share = (time.monotonic() - started) / len(chunk)
        for result in results:
            result.duration_seconds = share
        report.results += results
        _write_manifests(spark, lake, report, results)
    report.results.sort(key=lambda r: r.event_date)
    return report


def _copy_chunk(spark, rows_between, totals_between, target: DayTable, chunk, rebalance, now, write) -> list[DayResult]:
    first, last = chunk[0], chunk[-1]
    rows = rows_between(first, last)
    day = target.spec.date_column
    if len(chunk) != (last - first).days + 1:
        rows = rows.filter(rows[day].isin(chunk))
    key = target.spec.primary_key
    commit = write(rows, chunk) if write else target.replace_days(rows, chunk, rebalance=rebalance, now=now)
    if totals_between is not None:
        source = totals_between(first, last).filter(F.col("event_date").isin(chunk))
    elif len(chunk) == 1 and not write:
        # The write itself counted what it was given; nothing is read twice.
        source = spark.createDataFrame(
            [(first, commit.rows, commit.checksum)], "event_date DATE, row_count BIGINT, checksum BIGINT"
        )
    else:
        source = count_checksum_by_day(rows, key, day)
    stored = count_checksum_by_day(target.read(days=chunk), key, day)
    compared = reconcile(source, stored).withColumn("error", mismatch_text())
    # One row per day at most; a day that neither side has is empty on both.
    results = {d: DayResult(d, success=True) for d in chunk}
    for r in compared.collect():
        results[r.event_date] = DayResult(r.event_date, r.lake_count, r.lake_checksum, success=r.matched, error=r.error)
    return list(results.values())


def _quarantined(rows_between, target: DayTable, chunk: Sequence[dt.date]) -> dict[dt.date, str] | None:
    """Days with rows that cannot be stored, and why; null when the source cannot be read. At most a row per day."""
    day = target.spec.date_column
    try:
        rows = rows_between(chunk[0], chunk[-1])
        counts = rows.filter(target.unusable()).groupBy(F.col(day).alias("event_date")).agg(F.count(F.lit(1)).alias("rows"))
        found = counts.collect()
    except Exception:  # noqa: BLE001 - the failure that led here is the one to report
        return None
    empty = " or ".join(target.spec.partition_columns)
    return {
        r.event_date: f"{target.spec.name}: {r.rows} row(s) with an empty {empty}"
        for r in found if r.event_date in set(chunk)
    }


def _first_line(failure: Exception) -> str:
    return (str(failure).strip() or type(failure).__name__).splitlines()[0]


def _write_manifests(spark: SparkSession, lake: str, report: RunReport, results: Sequence[DayResult]) -> None:
    evidence.write(
        spark,
        lake,
        evidence.RUN_SCHEMA,
        (
            (
                evidence.run_path(r.event_date.isoformat(), report.table),
                {
                    "table": report.table,
                    "run_date": r.event_date.isoformat(),
                    "run_id": report.run_id,
                    "row_count": r.row_count,
                    "checksum": r.checksum,
                    "duration_seconds": r.duration_seconds,
                    "generated_at": report.generated_at,
                    "success": r.success,
                    "error": r.error or None,
                },
            )
            for r in results
        ),
    )
