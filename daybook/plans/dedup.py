"""Make days of a table hold only the newest row of every key, over all its days.

A key may come again on another day: a late correction, or an old copy that arrives after the new one. The batch is
reduced by itself first. Then the key index (``tables.keyindex``) names the files of other days that hold one of its
keys; only those are read, and only rows with such keys compared. An incoming row that is older than the stored one
stays out; a stored row that is older goes, and the files it stood in are rewritten without it. New days and rewritten
files are published as one snapshot.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.changes import latest_per_key
from daybook.tables.daytable import BadBatch, Commit, DayTable, Live
from daybook.tables.keyindex import KeyIndex
from daybook.tables.keys import matching, without
from daybook.tables.storage import Storage, kept, scratch_folder


class MergeLatest:
    """Writes batches of days into ``table``; ``version`` is the column whose greatest value is the newest.

    Rows of equal version are ordered by all their columns, so the outcome does not depend on which came first. Null
    keys are one key, within a batch; they are not compared with other days. A null version is older than any other.
    """

    def __init__(self, table: DayTable, version: str, now: dt.datetime | None = None):
        self.table, self.version, self.now = table, version, now
        self.key = table.spec.primary_key
        self.index = KeyIndex(table)
        self.files_read = 0
        self._batch: DataFrame | None = None
        self._outdated: DataFrame | None = None

    def _ordered(self) -> list[str]:
        return [self.version, *(c for c in self.table.spec.columns if c != self.version)]

    def _latest(self, rows: DataFrame) -> DataFrame:
        typed = rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.table.spec.schema))
        return latest_per_key(typed, [self.key], self.version)

    def expected(self) -> DataFrame:
        """What should be left of the last batch, worked out once more from the batch itself."""
        latest = self._latest(self._batch)
        return latest if self._outdated is None else without(latest, self._outdated, self.key)

    def write(self, rows: DataFrame, days: Sequence[dt.date]) -> Commit:
        """The given days hold what of ``rows`` is newest; older rows of the same keys go from all other days."""
        self._batch, self._outdated = rows, None
        work = scratch_folder(self.table.spark, "dedup")
        try:
            # Written once, as several steps read it, and so that a lost executor costs a read and not the reduction.
            return self._merge(kept(self._latest(rows), f"{work}/incoming"), days, work)
        finally:
            Storage(self.table.spark).delete(f"{work}/incoming")

    def _merge(self, incoming: DataFrame, days: Sequence[dt.date], work: str) -> Commit:
        table, key = self.table, self.key
        self.index.refresh()
        keys = incoming.select(key)
        parent = table.snapshot()
        others = [e for e in parent.live if e.day not in set(days)]
        rivals = self._rivals(keys, days, f"{work}/rivals") if others else None
        if rivals is None or rivals.isEmpty():
            return table.replace_days(incoming, days, now=self.now)

        # Per contested key: the newest row of all, and whether it stands in a file already. Among equal rows the
        # stored one wins, since a null file name is smallest.
        contested = matching(incoming, rivals, key).withColumn("file", F.lit(None).cast("string"))
        ordered = self._ordered()
        both = contested.select(*ordered, "file").unionByName(rivals.select(*ordered, "file"))
        decided = kept(
            both.groupBy(key).agg(
                F.max(F.struct(*ordered, "file")).alias("newest"), F.count("file").alias("stored"),
            ),
            f"{work}/decided",
        )
        stays = F.col("newest.file").isNotNull()
        self._outdated = decided.filter(stays).select(key)
        # A single stored row that is the newest stays where it is; all other stored rows of the key are taken out,
        # and the newest of them, if it is that, is written again.
        moved = decided.filter(~(stays & (F.col("stored") == 1)))
        hits = kept(
            rivals.join(moved.select(key), key, "left_semi")
            .groupBy(F.col(table.spec.date_column).alias("day"), "file", key).agg(F.count(F.lit(1)).alias("rows")),
            f"{work}/hits",
        )
        fresh = without(incoming, self._outdated, key)
        totals = hits.groupBy("day").agg(F.sum("rows").alias("rows")).collect()  # one row per day, as in the log
        if not totals:
            return table.replace_days(fresh, days, now=self.now)
        rewritten, untouched = table.split_by_hits(parent, frozenset(r.day for r in totals), hits)
        again = moved.filter(stays).select(*(F.col(f"newest.{c}").alias(c) for c in table.spec.columns))
        survivors = without(table.scan_entries(rewritten).select(*table.spec.columns), moved, key).unionByName(again)
        staged = table.stage(fresh.unionByName(survivors), {*days, *(e.day for e in rewritten)})
        self._check(staged, days, rewritten, sum(r.rows for r in totals), again)
        live = [e for e in untouched if e.day not in set(days)]
        return table.publish_entries(parent, live, staged, "merge_latest", self.now)

    def _rivals(self, keys: DataFrame, days: Sequence[dt.date], path: str) -> DataFrame | None:
        """Stored rows of the keys on other days, with their file; read from the files that the index names."""
        table = self.table
        found = self.index.holders(keys).filter(~F.col("day").isin(list(days)))
        # Files with a repeated key: the log names them next, if they are rewritten.
        entries = [
            Live(r.day, r.commit, tuple(sorted(r.files)))
            for r in found.groupBy("commit", "day").agg(F.collect_list("file").alias("files")).collect()
        ]
        self.files_read = sum(len(e.files) for e in entries)
        if not entries:
            return None
        stored = table.scan_entries(entries).withColumn("file", table.file_name())
        return kept(matching(stored.select(*table.spec.columns, "file"), keys, self.key), path)

    def _check(self, staged, days: Sequence[dt.date], rewritten: list[Live], removed: int, again: DataFrame) -> None:
        """Other days must have lost exactly the rows that were taken out; counts come from file footers."""
        table = self.table
        elsewhere = [Live(d, staged.commit) for d in staged.days if d not in set(days)]
        have = table.scan_entries(elsewhere).count()
        want = table.scan_entries(rewritten).count() - removed + again.count()
        if have != want:
            raise BadBatch(f"{table.spec.name}: {have} row(s) would stay on other days instead of {want}")
