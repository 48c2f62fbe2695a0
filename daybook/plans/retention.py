"""Retention by class and jurisdiction: days that have expired go by metadata, mixed days lose their expired rows.

A policy is a list of rules: how long a class of data is kept, in general and for single jurisdictions. Per partition
there are three cases. Expired under every rule: the log entry goes, nothing is read. Kept under every rule: nothing
happens. In between: its rows are looked at, and of its files only those with both kinds of rows are rewritten; where
partitions are by city, a file has one jurisdiction, so there are none. All of it is one snapshot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.cities import COLUMN, as_of, checked
from daybook.operators.partitions import oldest_kept
from daybook.tables.columns import evolved
from daybook.tables.daytable import BadBatch, DayTable, Live
from daybook.tables.storage import kept, scratch_folder


@dataclass(frozen=True)
class Rule:
    """A class keeps rows so many months and days; neither means for ever. Without jurisdiction it is the general rule."""

    data_class: str
    jurisdiction: str | None = None
    days: int = 0
    months: int = 0

    def cutoff(self, today: dt.date) -> dt.date | None:
        """First day that stays; null when everything does."""
        return oldest_kept(today, self.days, self.months) if self.days or self.months else None


@dataclass(frozen=True)
class DataClass:
    name: str
    table: str
    key: str
    day: str  # expression for a row's day


# The classes with their tables, and how long each is kept where no jurisdiction says otherwise. Accounts are
# hot operational data and kept for ever; test rows are no class, since exports leave them out.
CLASSES = (
    DataClass("account", "accounts", "account_id", "snapshot_date"),
    DataClass("ledger", "reward_ledger", "ledger_id", "event_date"),
    DataClass("camera", "anpr_camera_events", "event_id", "event_date"),
    DataClass("trip", "trip_events", "trip_id", "event_date"),
    DataClass("reference", "reference_feed_cache", "cache_id", "fetched_date"),
    DataClass("derived", "zone_occupancy_hourly", "occupancy_id", "cast(hour_ts AS date)"),
)
POLICY = (
    Rule("account"),
    Rule("ledger", months=84),
    Rule("camera", months=12),
    Rule("trip", days=90),
    Rule("reference", months=36),
    Rule("derived", months=12),
)


@dataclass(frozen=True)
class Cutoffs:
    """First days kept: in general, and by jurisdiction. Null keeps everything."""

    general: dt.date | None
    own: dict[str, dt.date | None]

    @property
    def all(self) -> list[dt.date | None]:
        return [self.general, *self.own.values()]


def cutoffs(policy: Sequence[Rule], data_class: str, today: dt.date) -> Cutoffs:
    """What a policy means on a day; a class without general rule keeps whatever no rule covers."""
    rules = [r for r in policy if r.data_class == data_class]
    names = [r.jurisdiction for r in rules]
    if len(set(names)) < len(names):
        raise ValueError(f"{data_class}: a jurisdiction has two rules")
    days = {r.jurisdiction: r.cutoff(today) for r in rules}
    return Cutoffs(days.pop(None, None), days)


def _is_expired(day: str, first_kept: Cutoffs, jurisdiction: Column | None) -> Column:
    """Whether a row is older than its rule allows; a row without jurisdiction, or of none with a rule, goes by the general one."""
    limit = F.lit(first_kept.general).cast("date")
    if jurisdiction is not None:
        for name, cutoff in first_kept.own.items():
            limit = F.when(jurisdiction.eqNullSafe(F.lit(name)), F.lit(cutoff).cast("date")).otherwise(limit)
    return F.coalesce(F.col(day) < limit, F.lit(False))


def expired(rows: DataFrame, day: str, first_kept: Cutoffs, jurisdiction: Column | None) -> DataFrame:
    """Rows past their retention. Without ``jurisdiction`` the general rule holds, as a literal that prunes scans."""
    return rows.filter(_is_expired(day, first_kept, jurisdiction))


def _last_day(partition: dt.date, monthly: bool) -> dt.date:
    if not monthly:
        return partition
    following = (partition.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return following - dt.timedelta(days=1)


def apply_retention(
    spark: SparkSession,
    table: DayTable,
    data_class: str,
    today: dt.date,
    policy: Sequence[Rule] = POLICY,
    cities: DataFrame | None = None,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Remove what has expired and report it: ``event_date, action, rows_removed`` per partition touched.

    A row's jurisdiction is the stored one, or that of its city on its day by ``cities``. Rows without a day stay.
    ``rows_removed`` is null for dropped partitions, which are not read. Older snapshots still show the rows until
    history is forgotten.
    """
    first_kept = cutoffs(policy, data_class, today)
    table = evolved(table)
    spec, parent = table.spec, table.snapshot()
    finite = [c for c in first_kept.all if c is not None]
    monthly = spec.date_column == "event_month"
    day = "event_date" if "event_date" in spec.columns else spec.date_column
    schema = "event_date DATE, action STRING, rows_removed BIGINT"
    if not finite:
        return spark.createDataFrame([], schema)
    # A rule that keeps everything leaves no partition that has expired as a whole.
    surely = min(finite) if len(finite) == len(first_kept.all) else None
    dropped = {d for d in parent.days if surely is not None and _last_day(d, monthly) < surely}
    mixed = {d for d in parent.days - dropped if d < max(finite)}
    report = [(d, "dropped", None) for d in sorted(dropped)]
    live = [e for e in parent.live if e.day not in dropped]
    looked_at = [e for e in live if e.day in mixed]

    def judged(rows: DataFrame) -> DataFrame:
        """The rows with whether each has expired, as ``__expired``."""
        if not first_kept.own:
            return rows.withColumn("__expired", _is_expired(day, first_kept, None))
        if COLUMN in spec.columns:
            return rows.withColumn("__expired", _is_expired(day, first_kept, F.col(COLUMN)))
        if cities is None:
            raise ValueError(f"{spec.name} stores no jurisdiction, so its rules need a dimension of cities")
        return as_of(rows, checked(cities), day).withColumn("__expired", _is_expired(day, first_kept, F.col(COLUMN)))

    partial: list[Live] = []
    if looked_at:
        needed = {day, spec.date_column, "city_code", COLUMN} & set(spec.columns)
        named = table.scan_entries(looked_at).select(*sorted(needed), table.file_name().alias("file"))
        hits = judged(named).groupBy(F.col(spec.date_column).alias("day"), "file").agg(
            F.count_if("__expired").alias("rows"), F.count(F.lit(1)).alias("of")
        )
        hits = kept(hits.filter("rows > 0"), f"{scratch_folder(spark, 'retention')}/hits")
        totals = hits.groupBy("day").agg(F.sum("rows").alias("rows")).orderBy("day").collect()  # a row per day, as in the log
        if totals:
            report += [(r.day, "rewritten", r.rows) for r in totals]
            touched = frozenset(r.day for r in totals)
            _, untouched = table.split_by_hits(parent, touched, hits)
            live = [e for e in untouched if e.day not in dropped]
            # Files that hold both kinds; those with expired rows only are left behind unread.
            both = hits.filter("rows < of").withColumn("commit", F.regexp_extract("file", r"^commit=([^/]+)/", 1))
            partial = [
                Live(r.day, r.commit, tuple(sorted(r.files)))
                for r in both.groupBy("commit", "day").agg(F.collect_list("file").alias("files")).collect()
            ]
    if partial:
        before = table.scan_entries(partial)
        staged = table.stage(
            judged(before).filter(~F.col("__expired")).select(*spec.columns), {e.day for e in partial}, rebalance=False
        )
        want = before.count() - hits.filter("rows < of").agg(F.sum("rows")).first()[0]
        if staged.rows != want:
            raise BadBatch(f"{spec.name}: {staged.rows} row(s) would be kept instead of {want}")
        table.publish_entries(parent, live, staged, "retention", now, dropped)
    elif dropped or len(report):
        table.publish_entries(parent, live, None, "retention", now, dropped)
    return spark.createDataFrame(sorted(report), schema)
