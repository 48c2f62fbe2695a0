"""A table kept by day on plain Parquet, with snapshots.

``<root>/data/commit=<token>/<day>/<second partition>/part-*.parquet`` holds immutable files and
``<root>/log/<id>.json`` one small entry per snapshot: the days that exist and the commits that hold
their rows. Data work is Spark jobs; the driver only handles the log, which has about one entry per day.
One writer at a time: publishing a snapshot whose id is already taken fails.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.functions.values import key_sum
from daybook.schemas import TableSpec
from daybook.tables.keys import matching, without
from daybook.tables.storage import Entry, Storage, each

# Files that no snapshot ever named may belong to a batch that is still being written; they stay this long.
ORPHAN_AGE = dt.timedelta(days=1)

SNAPSHOT_SCHEMA = (
    "snapshot_id BIGINT, parent_id BIGINT, committed_at TIMESTAMP, operation STRING, days ARRAY<DATE>, "
    "live ARRAY<STRUCT<day: DATE, commit: STRING, files: ARRAY<STRING>>>"
)


class SnapshotNotFound(LookupError):
    """The snapshot never existed or has been expired."""


class BadBatch(ValueError):
    """Rows that do not belong to the days being written."""


@dataclass(frozen=True)
class Live:
    """Rows of a day: a whole commit directory, or the named files in it."""

    day: dt.date
    commit: str
    files: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Snapshot:
    snapshot_id: int
    parent_id: int | None
    committed_at: dt.datetime
    operation: str
    days: frozenset[dt.date] = frozenset()
    live: tuple[Live, ...] = ()

    def to_json(self) -> str:
        return json.dumps(
            {
                "snapshot_id": self.snapshot_id,
                "parent_id": self.parent_id,
                "committed_at": self.committed_at.astimezone(dt.timezone.utc).isoformat(),
                "operation": self.operation,
                "days": [d.isoformat() for d in sorted(self.days)],
                "live": [
                    {"day": e.day.isoformat(), "commit": e.commit}
                    | ({} if e.files is None else {"files": list(e.files)})
                    for e in self.live
                ],
            }
        )

    @staticmethod
    def from_json(text: str) -> Snapshot:
        raw = json.loads(text)
        return Snapshot(
            raw["snapshot_id"],
            raw["parent_id"],
            dt.datetime.fromisoformat(raw["committed_at"]),
            raw["operation"],
            frozenset(map(dt.date.fromisoformat, raw["days"])),
            tuple(
                Live(dt.date.fromisoformat(e["day"]), e["commit"], tuple(e["files"]) if "files" in e else None)
                for e in raw["live"]
            ),
        )


@dataclass(frozen=True)
class Staged:
    """Files written but not yet visible."""

    commit: str
    days: frozenset[dt.date]
    rows: int
    checksum: int


@dataclass(frozen=True)
class Commit:
    snapshot_id: int
    rows: int = 0
    checksum: int = 0
    days: frozenset[dt.date] = field(default_factory=frozenset)


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


class DayTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.storage = Storage(spark)

    # ---- log -------------------------------------------------------------------------------------

    @property
    def data_root(self) -> str:
        return f"{self.root}/data"

    def _log_path(self, snapshot_id: int) -> str:
        return f"{self.root}/log/{snapshot_id:012d}.json"

    def snapshot_ids(self) -> list[int]:
        names = (e.name for e in self.storage.list(f"{self.root}/log"))
        return sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json"))

    def snapshot(self, version: int | None = None) -> Snapshot:
        ids = self.snapshot_ids()
        if version is None and ids:
            version = ids[-1]
        if version not in ids:
            raise SnapshotNotFound(f"{self.spec.name}: no snapshot {version}")
        return Snapshot.from_json(self.storage.read_text(self._log_path(version)))

    def snapshots(self) -> DataFrame:
        """The snapshot log as rows."""
        return self.spark.read.schema(SNAPSHOT_SCHEMA).json(f"{self.root}/log")

    def exists(self) -> bool:
        return bool(self.snapshot_ids())

    def create(self, now: dt.datetime | None = None) -> DayTable:
        """Empty table with the declared columns."""
        if not self.exists():
            self.storage.make_dirs(self.data_root)
            self._publish(None, (), frozenset(), "create", now)
        return self

    def _publish(self, parent: Snapshot | None, live, days, operation: str, now: dt.datetime | None) -> int:
        snapshot_id = parent.snapshot_id + 1 if parent else 1
        entry = Snapshot(
            snapshot_id,
            parent.snapshot_id if parent else None,
            now or utc_now(),
            operation,
            frozenset(days),
            tuple(sorted(live, key=lambda e: (e.day, e.commit))),
        )
        self.storage.publish_text(self._log_path(snapshot_id), entry.to_json())
        return snapshot_id

    # ---- read ------------------------------------------------------------------------------------

    def days(self, version: int | None = None) -> frozenset[dt.date]:
        """Days that have a partition, empty ones included."""
        return self.snapshot(version).days

    def read(self, version: int | None = None, days: Iterable[dt.date] | None = None) -> DataFrame:
        """Rows of a snapshot, the newest by default. ``days`` prunes before any listing happens."""
        live = self.snapshot(version).live
        if days is not None:
            wanted = set(days)
            live = tuple(e for e in live if e.day in wanted)
        return self.scan_entries(live).select(*self.spec.columns)

    def read_between(self, first: dt.date, last: dt.date, version: int | None = None) -> DataFrame:
        live = tuple(e for e in self.snapshot(version).live if first <= e.day <= last)
        return self.scan_entries(live).select(*self.spec.columns)

    def as_view(self, name: str | None = None, version: int | None = None) -> str:
        """Temp views for SQL users: the rows as ``name`` and the log as ``name$snapshots``.

        A view shows the snapshot it was made from; make it again after a change.
        """
        name = name or self.spec.name
        self.read(version).createOrReplaceTempView(name)
        self.snapshots().createOrReplaceTempView(f"`{name}$snapshots`")
        return name

    def _directory(self, commit: str, day: dt.date) -> str:
        return f"{self.data_root}/commit={commit}/{self.spec.date_column}={day.isoformat()}"

    def scan_entries(self, live: Iterable[Live]) -> DataFrame:
        """Rows of log entries, whatever snapshot they belong to."""
        paths: list[str] = []
        for entry in live:
            if entry.files is None:
                paths.append(self._directory(entry.commit, entry.day))
            else:
                paths.extend(f"{self.data_root}/{unquote(name)}" for name in entry.files)
        if not paths:
            return self.spark.createDataFrame([], self.spec.schema)
        return (
            self.spark.read.schema(self.spec.schema).option("basePath", self.data_root).parquet(*paths)
        )

    @staticmethod
    def file_name() -> Column:
        """Name of the file a row came from, relative to the data folder."""
        return F.substring_index("_metadata.file_path", "/data/", -1)

    # ---- write -----------------------------------------------------------------------------------

    def unusable(self) -> Column:
        """Rows that cannot be stored: partition values become directory names, where null and '' cannot be told apart."""
        found = F.lit(False)
        for c in self.spec.partition_columns:
            found = found | F.col(c).isNull() | (F.col(c).cast("string") == "")
        return found

    def stage(self, rows: DataFrame, days: Iterable[dt.date] | None, rebalance: bool = True) -> Staged:
        """Write rows of the given days, or of whatever days they have, without making them visible.

        With ``rebalance`` the rows are laid out by partition with even file sizes: adaptive execution
        splits a hot day or city over several tasks and merges small ones. Without it the input's own
        file layout is kept and nothing is shuffled.
        """
        days = None if days is None else frozenset(days)
        spec = self.spec
        token = f"{uuid.uuid4().hex[:16]}"
        parts = [F.col(c) for c in spec.partition_columns]
        laid_out = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema))
        if rebalance:
            laid_out = laid_out.hint("rebalance", *parts)
        laid_out = laid_out.sortWithinPartitions(*spec.partition_columns, spec.primary_key)
        seen = Observation(f"stage-{token}")
        outside = F.lit(days is not None)
        if days:
            outside = ~parts[0].between(min(days), max(days))
        laid_out = laid_out.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            key_sum(F.col(spec.primary_key)).alias("checksum"),
            F.count_if(self.unusable()).alias("unusable"),
            F.count_if(outside).alias("outside"),
        )
        target = f"{self.data_root}/commit={token}"
        laid_out.write.partitionBy(*spec.partition_columns).parquet(target)
        found = seen.get
        prefix = f"{spec.date_column}="
        names = [e.name.removeprefix(prefix) for e in self.storage.list(target) if e.name.startswith(prefix)]
        if found["unusable"]:
            raise BadBatch(f"{spec.name}: {found['unusable']} row(s) with an empty {' or '.join(spec.partition_columns)}")
        written = frozenset(map(dt.date.fromisoformat, names))
        if found["outside"] or not (days is None or written <= days):
            raise BadBatch(f"{spec.name}: rows outside the days being written")
        return Staged(token, written, found["rows"], found["checksum"])

    def read_staged(self, staged: Staged) -> DataFrame:
        return self.scan_entries(Live(d, staged.commit) for d in staged.days).select(*self.spec.columns)

    def publish(
        self, staged: Staged, replaced: Iterable[dt.date], operation: str, now: dt.datetime | None = None
    ) -> Commit:
        """Make staged rows visible; they take the place of everything stored for ``replaced``."""
        lost = [d for d in sorted(staged.days) if not self.storage.exists(self._directory(staged.commit, d))]
        if lost:
            raise BadBatch(f"{self.spec.name}: staged files of {len(lost)} day(s) are gone, {lost[0]} first")
        parent = self.snapshot()
        gone = frozenset(replaced)
        live = [e for e in parent.live if e.day not in gone]
        live += [Live(d, staged.commit) for d in staged.days]
        snapshot_id = self._publish(parent, live, parent.days | staged.days, operation, now)
        return Commit(snapshot_id, staged.rows, staged.checksum, staged.days)

    def replace_days(
        self,
        rows: DataFrame,
        days: Iterable[dt.date],
        operation: str = "replace",
        rebalance: bool = True,
        now: dt.datetime | None = None,
    ) -> Commit:
        """The given days hold exactly ``rows`` afterwards; a day without rows becomes empty."""
        days = frozenset(days)
        return self.publish(self.stage(rows, days, rebalance), days, operation, now)

    def append(self, rows: DataFrame, days: Iterable[dt.date], now: dt.datetime | None = None) -> Commit:
        return self.publish(self.stage(rows, days), (), "append", now)

    def add_days(self, days: Iterable[dt.date], now: dt.datetime | None = None) -> int | None:
        """Create empty partitions; no snapshot when there is nothing to create."""
        parent = self.snapshot()
        missing = frozenset(days) - parent.days
        if not missing:
            return None
        return self._publish(parent, parent.live, parent.days | missing, "add_days", now)

    def drop_days(
        self, days: Iterable[dt.date], operation: str = "drop_days", now: dt.datetime | None = None
    ) -> int | None:
        """Take days out of the table: a log entry, no data is read."""
        parent = self.snapshot()
        gone = frozenset(days) & parent.days
        if not gone:
            return None
        live = [e for e in parent.live if e.day not in gone]
        return self._publish(parent, live, parent.days - gone, operation, now)

    # ---- delete by key ---------------------------------------------------------------------------

    def key_hits(self, keys: DataFrame, column: str) -> DataFrame:
        """Rows per stored file and key, for the keys that occur."""
        live = self.snapshot().live
        if not live:
            key_type = self.spec.schema[column].dataType.simpleString()
            return self.spark.createDataFrame([], f"day DATE, file STRING, {column} {key_type}, rows BIGINT")
        named = self.scan_entries(live).select(
            F.col(self.spec.date_column).alias("day"), F.col(column), self.file_name().alias("file")
        )
        return matching(named, keys, column).groupBy("day", "file", column).agg(
            F.count(F.lit(1)).alias("rows")
        )

    def history_holds(self, keys: DataFrame, column: str) -> bool:
        """Whether an older snapshot still shows one of the keys."""
        ids = self.snapshot_ids()
        current = set(self.snapshot().live)
        past = {e for i in ids[:-1] for e in self.snapshot(i).live} - current
        if not past:
            return False
        return not matching(self.scan_entries(past).select(column), keys, column).isEmpty()

    def delete_keys(
        self, keys: DataFrame, column: str, hits: DataFrame | None = None, now: dt.datetime | None = None
    ) -> Commit | None:
        """Remove every row whose key is listed; no snapshot when none is stored.

        Only files that hold such a row are rewritten. ``hits`` may pass in a stored ``key_hits``.
        """
        parent = self.snapshot()
        if hits is None:
            hits = self.key_hits(keys, column)
        # One row per day, as in the log.
        totals = hits.groupBy("day").agg(F.sum("rows").alias("rows")).collect()
        if not totals:
            return None
        rewritten, kept = self.split_by_hits(parent, frozenset(r.day for r in totals), hits)
        before = self.scan_entries(rewritten)
        staged = self.stage(
            without(before.select(*self.spec.columns), keys, column), {e.day for e in rewritten}, rebalance=False
        )
        # The row count of the files comes from their footers.
        expected = before.count() - sum(r.rows for r in totals)
        if staged.rows != expected:
            raise BadBatch(f"{self.spec.name}: {staged.rows} row(s) would survive the delete instead of {expected}")
        return self.publish_entries(parent, kept, staged, "delete", now)

    def publish_entries(
        self,
        parent: Snapshot,
        kept: Iterable[Live],
        staged: Staged | None,
        operation: str,
        now: dt.datetime | None = None,
        dropped: Iterable[dt.date] = (),
    ) -> Commit:
        """A snapshot of the ``kept`` entries and the staged rows without the ``dropped`` days, if ``parent`` is the newest."""
        staged = staged or Staged("", frozenset(), 0, 0)
        live = [*kept, *(Live(d, staged.commit) for d in staged.days)]
        days = (parent.days | staged.days) - frozenset(dropped)
        snapshot_id = self._publish(parent, live, days, operation, now)
        return Commit(snapshot_id, staged.rows, staged.checksum, staged.days)

    def split_by_hits(
        self, parent: Snapshot, days: frozenset[dt.date], hits: DataFrame
    ) -> tuple[list[Live], list[Live]]:
        """What has to be rewritten because of ``hits`` on these days, and what stays.

        The listing, the log and the hits are joined as frames. One row per log entry comes back; it names files only
        where an entry has both kinds, as the log itself must then.
        """
        touched = {(e.commit, e.day): e for e in parent.live if e.day in days}
        listed = self.live_files(parent, [self._directory(*key) for key in touched])
        hit = F.col("hit").isNotNull()
        marked = listed.join(hits.select("file").distinct().withColumn("hit", F.lit(True)), "file", "left")
        entries = marked.groupBy("commit", "day").agg(
            F.count(F.lit(1)).alias("files"), F.count_if(hit).alias("hits"),
            F.collect_list(F.when(hit, F.col("file"))).alias("hit_files"),
            F.collect_list(F.when(~hit, F.col("file"))).alias("other_files"),
        )
        mixed = F.col("hits") < F.col("files")
        found = entries.filter("hits > 0").select(
            "commit", "day", F.when(mixed, F.col("hit_files")).alias("hit_files"),
            F.when(mixed, F.col("other_files")).alias("other_files"),
        )
        rewritten: list[Live] = []
        kept = [e for e in parent.live if e.day not in days]
        for r in found.collect():
            entry = touched.pop((r.commit, r.day))
            if r.hit_files is None:
                rewritten.append(entry)
            else:
                rewritten.append(Live(r.day, r.commit, tuple(sorted(r.hit_files))))
                kept.append(Live(r.day, r.commit, tuple(sorted(r.other_files))))
        return rewritten, kept + list(touched.values())

    def _last_change(self, entry: Entry) -> dt.datetime:
        """Newest change at or below a commit folder: its own, its days' and their partitions'."""
        latest, level = entry.modified, [entry]
        for _ in range(1 + len(self.spec.partition_columns)):
            level = [child for e in level if e.is_dir for child in self.storage.list(e.path)]
            latest = max([latest, *(e.modified for e in level)])
        return latest

    def _data_files(self, directory: str) -> list[Entry]:
        depth = "/".join("*" for _ in self.spec.partition_columns)
        return self.storage.glob(f"{directory}/{depth}")

    def _encoded(self, path: str) -> str:
        uri = self.spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()
        return uri.rsplit("/data/", 1)[1]

    # ---- history ---------------------------------------------------------------------------------

    def expirable(
        self, keep: int = 1, max_age: dt.timedelta = dt.timedelta(0), now: dt.datetime | None = None
    ) -> DataFrame:
        """Snapshots beyond the ``keep`` newest that are also older than ``max_age``."""
        cutoff = (now or utc_now()) - max_age
        return expirable(self.snapshots(), keep, cutoff)

    def expire(
        self, keep: int = 1, max_age: dt.timedelta = dt.timedelta(0), now: dt.datetime | None = None
    ) -> list[int]:
        """Forget old snapshots; the newest always stays. Returns the forgotten ids."""
        ids = [r.snapshot_id for r in self.expirable(keep, max_age, now).select("snapshot_id").collect()]
        each(lambda i: self.storage.delete(self._log_path(i)), ids)
        return sorted(ids)

    def files(self, folders: Iterable[str] | None = None) -> DataFrame:
        """Every readable data file, or those in ``folders``, with commit, day and size; the listing runs as a Spark job."""
        name = self.file_name()
        empty = "file STRING, commit STRING, day DATE, bytes BIGINT"
        if folders is None:
            folders = [e.path for e in self.storage.list(self.data_root) if e.is_dir]
        folders = list(folders)
        if not folders:
            return self.spark.createDataFrame([], empty)
        listed = (
            self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
            .select(name.alias("file"), F.col("length").alias("bytes"))
        )
        pattern = rf"^commit=([^/]+)/{self.spec.date_column}=(\d{{4}}-\d{{2}}-\d{{2}})/"
        return listed.select(
            "file",
            F.regexp_extract("file", pattern, 1).alias("commit"),
            F.try_to_date(F.regexp_extract("file", pattern, 2), "yyyy-MM-dd").alias("day"),
            "bytes",
        )

    @staticmethod
    def named(snapshots: DataFrame) -> tuple[DataFrame, DataFrame]:
        """What snapshots refer to: whole days of a commit, and single files."""
        refs = snapshots.select(F.explode("live").alias("e")).select("e.*")
        whole = refs.filter(F.col("files").isNull()).select("commit", "day").distinct()
        return whole, refs.filter(F.col("files").isNotNull()).select(F.explode("files").alias("file")).distinct()

    def orphan_files(self) -> DataFrame:
        """Data files that no retained snapshot refers to."""
        whole, single = self.named(self.snapshots())
        return (
            self.files().join(whole, ["commit", "day"], "left_anti").join(single, "file", "left_anti")
        )

    def live_files(self, snapshot: Snapshot | None = None, folders: Iterable[str] | None = None) -> DataFrame:
        """Data files of a snapshot, the newest by default; ``folders`` restricts the listing to some of its days."""
        snapshot = snapshot or self.snapshot()
        whole, single = self.named(self.snapshots().filter(F.col("snapshot_id") == F.lit(snapshot.snapshot_id)))
        files = self.files(folders)
        return files.join(whole, ["commit", "day"], "left_semi").select(*files.columns).unionByName(
            files.join(single, "file", "left_semi").select(*files.columns)
        )

    def published_commits(self) -> frozenset[str]:
        """Commits that a retained snapshot refers to."""
        ids = self.snapshot_ids()
        return frozenset(e.commit for snapshot in each(self.snapshot, ids) for e in snapshot.live)

    def forget_history(
        self, now: dt.datetime | None = None, keep: int = 1, max_age: dt.timedelta = dt.timedelta(0)
    ) -> tuple[list[int], int]:
        """Expire old snapshots and delete the files only they had, at any age. Returns ids and deleted paths."""
        published = self.published_commits()
        expired = self.expire(keep, max_age, now)
        return expired, self.remove_orphans(published=published)

    def remove_orphans(
        self, min_age: dt.timedelta = ORPHAN_AGE, published: frozenset[str] = frozenset(), now: dt.datetime | None = None
    ) -> int:
        """Delete what no retained snapshot refers to. Returns deleted paths.

        Paths of ``published`` commits go at any age; others, abandoned writes or batches in flight, must
        not have changed for ``min_age``.
        """
        newest = (now or utc_now()) - min_age

        def may_go(entry: Entry, commit: str) -> bool:
            return commit in published or self._last_change(entry) <= newest

        whole: set[tuple[str, dt.date]] = set()
        single: dict[tuple[str, dt.date], set[str]] = {}
        for snapshot_id in self.snapshot_ids():
            for entry in self.snapshot(snapshot_id).live:
                key = (entry.commit, entry.day)
                if entry.files is None:
                    whole.add(key)
                else:
                    single.setdefault(key, set()).update(entry.files)
        used = {commit for commit, _ in whole} | {commit for commit, _ in single}
        doomed: list[str] = []
        kept_commits: list[str] = []
        for entry in self.storage.list(self.data_root):
            commit = entry.name.removeprefix("commit=")
            if commit in used:
                kept_commits.append(entry.path)
            elif may_go(entry, commit):
                doomed.append(entry.path)
        prefix = f"{self.spec.date_column}="
        for path, children in zip(kept_commits, each(self.storage.list, kept_commits)):
            commit = path.rsplit("commit=", 1)[1]
            for child in children:
                if not child.name.startswith(prefix):
                    if child.is_dir:
                        doomed.append(child.path)
                    continue
                key = (commit, dt.date.fromisoformat(child.name.removeprefix(prefix)))
                if key in whole:
                    continue
                if key not in single:
                    doomed.append(child.path)
                    continue
                doomed += [
                    f.path for f in self._data_files(child.path) if self._encoded(f.path) not in single[key]
                ]
        each(self.storage.delete, doomed)
        return len(doomed)


def expirable(snapshots: DataFrame, keep: int, cutoff: dt.datetime) -> DataFrame:
    """Rows of a snapshot log that may go: not among the ``keep`` newest and committed before ``cutoff``.

    The log has one row per commit, so ranking it in one place is small work.
    """
    newest = (
        snapshots.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(max(keep, 1)).select("snapshot_id")
    )
    return snapshots.join(newest, "snapshot_id", "left_anti").filter(F.col("committed_at") <= F.lit(cutoff))
