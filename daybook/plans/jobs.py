"""The scheduled jobs: export, backfill, curate, hygiene, trim, migration."""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daybook.operators import evidence, partitions, reports
from daybook.operators.changes import without_erased, without_synthetic
from daybook.operators.cities import as_of, checked
from daybook.operators.evidence import utc
from daybook.operators.reconcile import count_checksum, count_checksum_by_day
from daybook.plans.dedup import MergeLatest
from daybook.plans.hop import RunReport, copy_days
from daybook.tables.columns import accept, evolved
from daybook.tables.daytable import BadBatch, DayTable
from daybook.tables.storage import kept, scratch_folder


# ---- export and backfill ---------------------------------------------------------------------------


def export_days(
    spark: SparkSession,
    source,
    raw: DayTable,
    lake: str,
    days: Sequence[dt.date],
    erased: DataFrame | None = None,
    drop_synthetic: bool = False,
    run_id: str | None = None,
    now: dt.datetime | None = None,
    cities: DataFrame | None = None,
) -> RunReport:
    """Copy source rows of ``days`` into the raw zone.

    ``erased`` is an erasure register (one column, named like the table's identifier): rows it lists do
    not come back. ``drop_synthetic`` keeps test rows out of the lake. ``cities`` (``operators.cities``) adds each
    row's jurisdiction. Columns that the source has beyond the declared ones, if it keeps them, are added to the table.
    """
    cities = checked(cities) if cities is not None else None

    def rows_between(first: dt.date, last: dt.date) -> DataFrame:
        rows = source.rows(first, last)
        if cities is not None:
            rows = as_of(rows, cities, raw.spec.date_column)
        if drop_synthetic:
            rows = without_synthetic(rows)
        if erased is not None:
            rows = without_erased(rows, erased, raw.spec.identifier)
        return rows

    # The source may count itself, as long as nothing is kept back here.
    totals = source.totals if erased is None and not drop_synthetic else None
    raw = raw.create(now)
    if cities is not None or getattr(source, "keep_added", False):
        raw = accept(raw, rows_between(min(days), max(days)))
    return copy_days(spark, rows_between, raw, lake, days, run_id=run_id, now=now, totals_between=totals)


def backfill(
    spark: SparkSession, source, raw: DayTable, lake: str, days: Sequence[dt.date], **options
) -> RunReport:
    """Export a range of days in one job and record the range in a summary as well."""
    report = export_days(spark, source, raw, lake, days, **options)
    totals = evidence.backfill_totals(report.frame(spark)).first()
    start, end = min(days).isoformat(), max(days).isoformat()
    summary = {
        "start_date": start,
        "end_date": end,
        "run_id": report.run_id,
        "dates": [
            {
                "date": r.event_date.isoformat(),
                "row_count": r.row_count,
                "checksum": r.checksum,
                "duration_seconds": r.duration_seconds,
                "success": r.success,
                "error": r.error or None,
            }
            for r in report.results
        ],
        **totals.asDict(),
        "generated_at": report.generated_at,
    }
    evidence.write(spark, lake, evidence.BACKFILL_SCHEMA, [(evidence.backfill_path(start, end), summary)])
    return report


# ---- curate ----------------------------------------------------------------------------------------


def curate_days(
    spark: SparkSession,
    raw: DayTable,
    curated: DayTable,
    lake: str,
    days: Sequence[dt.date],
    run_id: str | None = None,
    now: dt.datetime | None = None,
    dedup_by: str | None = None,
    cities: DataFrame | None = None,
) -> RunReport:
    """Copy days from raw to curated, with every column raw has gained. Raw counts its own rows by itself.

    As they are, raw files are laid out already, so nothing is shuffled. ``dedup_by`` names the version column: of rows
    with one key, in these days or any other day of curated, only the newest stays (``plans.dedup``). ``cities`` adds
    each row's jurisdiction.
    """
    raw, curated = evolved(raw), curated.create(now)
    cities = checked(cities) if cities is not None else None

    def rows_between(first: dt.date, last: dt.date) -> DataFrame:
        rows = raw.read_between(first, last)
        return as_of(rows, cities, raw.spec.date_column) if cities is not None else rows

    key, day = raw.spec.primary_key, raw.spec.date_column
    curated = accept(curated, rows_between(min(days), max(days)))
    if dedup_by is None:
        return copy_days(
            spark, rows_between, curated, lake, days, rebalance=False, run_id=run_id, now=now,
            totals_between=lambda a, b: count_checksum_by_day(raw.read_between(a, b), key, day),
        )
    merge = MergeLatest(curated, dedup_by, now)
    return copy_days(
        spark, rows_between, curated, lake, days, run_id=run_id, now=now, write=merge.write,
        totals_between=lambda a, b: count_checksum_by_day(merge.expected(), key, day),
    )


def curatable_days(spark: SparkSession, lake: str, raw_table: str, days: DataFrame) -> DataFrame:
    """Days whose export is on record as successful."""
    done = evidence.successful_days(evidence.scan_run_manifests(spark, lake, raw_table))
    return days.join(done, "event_date", "left_semi")


def snapshot_accounts(accounts: DataFrame, target: DayTable, day: dt.date, now: dt.datetime | None = None):
    """All accounts as the partition of one day; a second run on that day replaces it."""
    target.create(now)
    rows = accounts.withColumn(target.spec.date_column, F.lit(day))
    return target.replace_days(rows, [day], "snapshot", now=now)


# ---- hygiene ---------------------------------------------------------------------------------------


def compact(
    spark: SparkSession,
    tables: Sequence[DayTable],
    lake: str,
    keep: int = 1,
    max_age: dt.timedelta = dt.timedelta(days=5),
    now: dt.datetime | None = None,
    merge_to: int | None = None,
) -> DataFrame:
    """Expire old snapshots, remove unreferenced files, publish bytes per storage prefix.

    With ``merge_to`` days with small files are rewritten first, aiming at files of so many bytes.
    """
    rows = []
    for table in tables:
        if merge_to:
            merge_small_files(table, merge_to, now)
        expired, removed = table.forget_history(now, keep, max_age)
        rows.append((table.spec.name, len(expired), removed))
    reports.publish_storage(spark, lake, utc(now))
    return spark.createDataFrame(rows, "table_name STRING, snapshots_expired INT, paths_removed INT")


def merge_small_files(table: DayTable, target_bytes: int = 256 * 1024**2, now: dt.datetime | None = None):
    """Pack small files of a partition, those below half the target, into files of about ``target_bytes``.

    Bins are filled by running totals over a partition's listing, smallest files first; a bin of one file is left alone.
    Only files in bins are read and replaced; all others stay where they are. The rows stay the same.
    """
    spec, parent = table.spec, table.snapshot()
    listed = table.live_files(parent)
    parts = list(spec.partition_columns)
    small = listed.filter(F.col("bytes") * 2 < F.lit(target_bytes)).select(
        "file", "day", *(_partition_value(spec, c).alias(f"part_{c}") for c in parts), "bytes"
    )
    partition = W.partitionBy(*(f"part_{c}" for c in parts))
    before = F.sum("bytes").over(partition.orderBy("bytes", "file").rowsBetween(W.unboundedPreceding, -1))
    binned = small.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / target_bytes))
    together = W.partitionBy(*(f"part_{c}" for c in parts), "bin")
    binned = binned.withColumn("files", F.count(F.lit(1)).over(together)).filter("files > 1")
    binned = kept(binned, f"{scratch_folder(table.spark, 'merge')}/bins")
    # Days and a number of bins: as much as the log holds.
    found = binned.agg(F.collect_set("day").alias("days"), F.sum(1 / F.col("files")).alias("bins")).first()
    if not found.days:
        return None
    rewritten, untouched = table.split_by_hits(parent, frozenset(found.days), binned)
    rows = table.scan_entries(rewritten).withColumn("file", table.file_name()).join(binned.select("file", "bin"), "file")
    laid_out = rows.repartition(max(1, round(found.bins)), *parts, "bin").select(*spec.columns)
    staged = table.stage(laid_out, found.days, rebalance=False)
    stored = table.scan_entries(rewritten).count()
    if staged.rows != stored:
        raise BadBatch(f"{spec.name}: {staged.rows} row(s) would be left of {stored}")
    return table.publish_entries(parent, untouched, staged, "merge_files", now)


def _partition_value(spec, column: str):
    """Value of a partition column from a listed file name: escaped once as a directory, once as a URI."""
    text = F.regexp_extract("file", rf"/{column}=([^/]*)/", 1)
    for _ in range(2):
        text = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
    return text.cast(spec.schema[column].dataType)


# ---- trim ------------------------------------------------------------------------------------------

COUNT_DIFFERS = "row count differs from the manifest"


@dataclass
class TrimReport:
    created: list[str]
    dropped: list[tuple[dt.date, int, int | None]]
    skipped: list[tuple[dt.date, str]]

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per partition touched; ``late_rows`` is what arrived after the export was recorded."""
        names = [(None, n, "created", None, None, None) for n in self.created]
        gone = [
            (d, None, "dropped", n, None, None if recorded is None else n - recorded)
            for d, n, recorded in self.dropped
        ]
        kept = [(d, None, "skipped", None, reason, None) for d, reason in self.skipped]
        return spark.createDataFrame(
            names + gone + kept,
            "event_date DATE, name STRING, outcome STRING, row_count BIGINT, reason STRING, late_rows BIGINT",
        )


def trim(
    spark: SparkSession,
    hot: DayTable,
    lake: str,
    today: dt.date,
    retention_days: int = 90,
    lookahead_days: int = 14,
    run_id: str | None = None,
    now: dt.datetime | None = None,
    table: str = "trip_events",
    require_equal_counts: bool = False,
) -> TrimReport:
    """Create the coming days' partitions, drop old ones that provably reached the lake, record both.

    With ``require_equal_counts`` a day stays when its rows are not as many as its manifest says.
    """
    if retention_days <= 0 or lookahead_days <= 0:
        raise ValueError("retention and lookahead must be positive numbers of days")
    started = time.monotonic()
    report = TrimReport([], [], [])
    error = None
    try:
        _trim(spark, hot, lake, today, retention_days, lookahead_days, now, table, report, require_equal_counts)
    except Exception as failure:
        error = str(failure).splitlines()[0] if str(failure) else type(failure).__name__
        raise
    finally:
        summary = {
            "run_date": today.isoformat(),
            "run_id": run_id or str(uuid.uuid4()),
            "retention_days": retention_days,
            "partitions_created": report.created,
            "partitions_dropped": [{"date": d.isoformat(), "row_count": n} for d, n, _ in report.dropped],
            "partitions_skipped": [{"date": d.isoformat(), "reason": why} for d, why in report.skipped],
            "duration_seconds": time.monotonic() - started,
            "generated_at": utc(now),
            "success": error is None,
            "error": error,
        }
        evidence.write(spark, lake, evidence.TRIM_SCHEMA, [(evidence.trim_path(today.isoformat()), summary)])
    return report


def _trim(spark, hot, lake, today, retention_days, lookahead_days, now, table, report, require_equal_counts) -> None:
    existing = day_frame(spark, hot.days())
    created = partitions.named(partitions.missing_future(existing, today, lookahead_days)).collect()
    hot.add_days([r.event_date for r in created], now)
    report.created += [r.name for r in created]

    names = partitions.named(day_frame(spark, hot.days())).select("name")
    old = partitions.before_cutoff(partitions.dated(names), today, retention_days)
    manifests = evidence.scan_run_manifests(spark, lake, table)
    plan = partitions.retention_plan(old, manifests).orderBy("event_date").collect()
    report.skipped += [(r.event_date, r.reason) for r in plan if r.action == "skip"]
    recorded = {r.event_date: r.manifest_rows for r in plan if r.action == "drop"}
    if recorded:
        rows = hot.read(days=recorded).select("event_date")
        counts = partitions.counted(day_frame(spark, recorded), rows).orderBy("event_date").collect()
        changed = [r.event_date for r in counts if require_equal_counts and r.row_count != recorded[r.event_date]]
        report.skipped = sorted(report.skipped + [(d, COUNT_DIFFERS) for d in changed])
        hot.drop_days(set(recorded) - set(changed), "trim", now)
        report.dropped += [(r.event_date, r.row_count, recorded[r.event_date]) for r in counts if r.event_date not in changed]


def day_frame(spark: SparkSession, days) -> DataFrame:
    return spark.createDataFrame([(d,) for d in sorted(days)], "event_date DATE")


# ---- migration -------------------------------------------------------------------------------------


class MigrationMismatch(RuntimeError):
    """The copy does not hold what the old table holds; nothing was made visible."""


# Repeated keys that an error names.
NAMED_KEYS = 5


def migrate(spark: SparkSession, old: DataFrame, target: DayTable, now: dt.datetime | None = None) -> DataFrame:
    """Rewrite an unpartitioned table by day, verify count and key sum, then make it visible.

    The old table is read once: its rows are counted on the way into the copy, and its days are those of the staged
    files. Keys that repeat are found in the copy, by key and day alone, before anything is published. The old table is
    left alone as the way back. Rows whose key is already in the target are ignored; with such a target the old
    table's keys are read once more, as the write does not see all of them.
    """
    spec = target.spec
    target.create(now)
    key = [spec.primary_key, spec.date_column]
    rows = incoming = old.select(*spec.columns)
    before = target.snapshot()
    if before.live:
        incoming = rows.join(target.read().select(*key), key, "left_anti").select(*spec.columns)
    staged = target.stage(incoming, None)
    copied = target.read_staged(staged)
    repeated = copied.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    named = repeated.orderBy(*key).limit(NAMED_KEYS).collect()
    if named:
        raise MigrationMismatch(f"{spec.name}: keys repeat, the first are " + ", ".join(str(r[0]) for r in named))
    want = tuple(count_checksum(rows, spec.primary_key).first()) if before.live else (staged.rows, staged.checksum)
    have = tuple(count_checksum(target.read().unionByName(copied) if before.live else copied, spec.primary_key).first())
    if want != have:
        raise MigrationMismatch(f"{spec.name}: old table has {want}, the copy has {have}")
    target.publish(staged, (), "migrate", now)
    return spark.createDataFrame(
        [(spec.name, *want, len(target.days()))], "table_name STRING, row_count BIGINT, checksum BIGINT, days INT"
    )


def high_watermark(rows: DataFrame, key: str) -> DataFrame:
    """Where a key sequence has to continue; 1 for an empty table."""
    return rows.agg(F.coalesce(F.max(key), F.lit(1).cast("bigint")).alias("high_watermark"))
