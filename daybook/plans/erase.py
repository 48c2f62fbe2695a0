"""Erase identifiers from every table and from history, and verify both."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.values import null_if_empty
from daybook.operators import evidence
from daybook.operators.erasure import count_by_identifier, screen
from daybook.operators.evidence import utc
from daybook.tables.daytable import DayTable, SnapshotNotFound
from daybook.tables.storage import Storage, kept, scratch_folder

RESULT_COLUMNS = (
    "request_ref", "identifier", "database", "table_name", "rows_before", "rows_after_delete",
    "pre_erasure_snapshot_id", "time_travel_blocked", "success", "error",
)

# Tables worked on at once; each runs its own Spark jobs.
TABLES_AT_ONCE = 4


@dataclass(frozen=True)
class Target:
    """A table to erase from. ``identifiers`` maps request identifiers to the table's own key, if they differ:
    a DataFrame with ``identifier`` and the table's identifier column."""

    database: str
    table: DayTable
    identifiers: DataFrame | None = None

    @property
    def column(self) -> str:
        return self.table.spec.identifier


@dataclass(frozen=True)
class Outcome:
    """What happened in one table. ``counts`` has a row per identifier that was found:
    ``identifier, rows_before, rows_after_delete``. The rest holds for the table as a whole."""

    counts: DataFrame | None = None
    snapshot_id: str | None = None
    blocked: bool = False
    error: str | None = None


def erase(
    spark: SparkSession, lake: str, requests: DataFrame, targets: Sequence[Target], now: dt.datetime | None = None
) -> DataFrame:
    """Handle a batch of requests (``identifier, request_ref, jurisdiction``): one rewrite per table.

    The request is on record before any row is touched. A failing table does not stop the others.
    Requests that do not pass screening are refused as a whole batch, before anything happens.

    Requests, keys, hits and results are tables in a scratch folder that every step reads as frames; only totals, and
    one row per day of a table, come to the driver. Records are written by tasks, one file per request. Keys and hits
    are removed at the end, whatever happens.
    """
    started, clock = utc(now), time.monotonic()
    work = scratch_folder(spark, "erase")
    try:
        batch = kept(screen(requests).select("identifier", "request_ref", "jurisdiction", "reason"), f"{work}/requests")
        _refuse_bad(batch)
        _record(lake, batch, None, started, None)
        keys = kept(batch.select("identifier").distinct(), f"{work}/keys")
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            jobs = [pool.submit(erase_from, t, keys, f"{work}/table={i}", now) for i, t in enumerate(targets)]
            outcomes = [job.result() for job in jobs]
        results = kept(_results(batch, targets, outcomes), f"{work}-results")
        _record(lake, batch, results, started, time.monotonic() - clock)
    finally:
        # The lists of identifiers go; the results stay until the scratch folder is emptied, as they are read from it.
        Storage(spark).delete(work)
    return results.select(*RESULT_COLUMNS)


def _refuse_bad(batch: DataFrame) -> None:
    found = batch.agg(
        F.count("reason").alias("refused"), F.array_sort(F.collect_set("reason")).alias("reasons"),
        F.count(F.lit(1)).alias("requests"), F.count_distinct("request_ref").alias("references"),
    ).first()
    if found.refused:
        raise ValueError(f"{found.refused} request(s) refused: " + ", ".join(found.reasons))
    if found.references < found.requests:
        raise ValueError("request references must be unique: each one names a record")


def erase_from(target: Target, keys: DataFrame, work: str, now: dt.datetime | None = None) -> Outcome:
    """Delete, forget history, verify. ``keys`` lists identifiers; ``work`` is a folder of this table's own."""
    table, column = target.table, target.column
    key_type = table.spec.schema[column].dataType
    outcome = Outcome()
    try:
        if target.identifiers is None:
            mapped = keys.select("identifier", F.col("identifier").try_cast(key_type).alias(column))
        else:
            mapped = target.identifiers.join(keys, "identifier").select("identifier", F.col(column).cast(key_type))
        mapped = kept(mapped.filter(F.col(column).isNotNull()).distinct(), f"{work}/mapped")
        own_keys = mapped.select(column)
        hits = kept(table.key_hits(own_keys, column), f"{work}/hits")
        if hits.isEmpty():
            # An earlier attempt may have stopped between the delete and the cleaning up.
            if table.history_holds(own_keys, column):
                table.forget_history(now)
            return outcome
        before = _by_identifier(mapped, hits.groupBy(column).agg(F.sum("rows").alias("rows")), column, "rows_before")
        outcome = replace(outcome, counts=before.withColumn("rows_after_delete", F.lit(0).cast("bigint")))
        previous = table.snapshot().snapshot_id
        table.delete_keys(own_keys, column, hits, now)
        table.forget_history(now)
        left = count_by_identifier(table.read(), own_keys, column)
        after = _by_identifier(mapped, left, column, "rows_after_delete")
        counts = before.join(after, "identifier", "left").fillna(0, ["rows_after_delete"])
        outcome = replace(outcome, counts=kept(counts, f"{work}/counts"))
        return replace(outcome, snapshot_id=str(previous), blocked=_unreadable(table, previous))
    except Exception as failure:  # noqa: BLE001 - recorded against the requests
        return replace(outcome, error=str(failure).splitlines()[0] if str(failure) else type(failure).__name__)


def _by_identifier(mapped: DataFrame, counts: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per requested identifier; one that is known under several keys has the rows of all."""
    return mapped.join(counts, column).groupBy("identifier").agg(F.sum("rows").alias(name))


def _unreadable(table: DayTable, version: int) -> bool:
    try:
        table.read(version=version)
    except SnapshotNotFound:
        return True
    return False


def _results(batch: DataFrame, targets: Sequence[Target], outcomes: Sequence[Outcome]) -> DataFrame:
    """One row per request and table, with the table's ``position`` among the targets."""
    out = None
    for position, (target, o) in enumerate(zip(targets, outcomes)):
        rows = batch.select("request_ref", "identifier")
        if o.counts is None:
            zero = F.lit(0).cast("bigint")
            rows = rows.withColumns({"rows_before": zero, "rows_after_delete": zero})
        else:
            rows = rows.join(o.counts, "identifier", "left").fillna(0, ["rows_before", "rows_after_delete"])
        found = F.col("rows_before") > 0
        error: Column = F.lit(o.error)
        if o.error is None:
            left = F.format_string("expected no rows after the delete, found %d", "rows_after_delete")
            error = F.when(found & (F.col("rows_after_delete") > 0), left)
            if not o.blocked:
                error = error.when(found, F.lit(f"snapshot {o.snapshot_id} can still be read"))
        part = rows.select(
            F.lit(position).alias("position"), "request_ref", "identifier", F.lit(target.database).alias("database"),
            F.lit(target.table.spec.name).alias("table_name"), "rows_before", "rows_after_delete",
            F.when(found, F.lit(o.snapshot_id)).cast("string").alias("pre_erasure_snapshot_id"),
            (found & F.lit(o.blocked)).alias("time_travel_blocked"), error.cast("string").alias("error"),
        ).withColumn("success", F.col("error").isNull())
        out = part if out is None else out.unionByName(part)
    return out


def _record(
    lake: str, batch: DataFrame, results: DataFrame | None, started: dt.datetime, seconds: float | None
) -> None:
    """A record per request: without ``results`` that work begins, with them what became of it."""
    record = batch.select("request_ref", "identifier", null_if_empty(F.col("jurisdiction")).alias("jurisdiction"))
    if results is None:
        record = record.withColumns({"tables": F.array(), "success": F.lit(False)})
    else:
        # One entry per target, so a request's group is as small as the list of tables.
        each = F.struct(
            "position", "database", F.col("table_name").alias("table"), "rows_before", "rows_after_delete",
            "pre_erasure_snapshot_id", "time_travel_blocked", "success", "error",
        )
        done = results.groupBy("request_ref").agg(
            F.array_sort(F.collect_list(each)).alias("all"), F.bool_and("success").alias("success")
        )
        entry = F.transform("all", lambda e: e.dropFields("position"))
        record = record.join(done, "request_ref").withColumn("tables", entry)
    evidence.write_frame(
        lake,
        evidence.ERASURE_SCHEMA,
        record.withColumns(
            {
                "path": evidence.erasure_path(started.date().isoformat(), F.col("request_ref")),
                "started_at": F.lit(started),
                "finished_at": F.lit(None if results is None else utc()).cast("timestamp"),
                "duration_seconds": F.lit(seconds).cast("double"),
                "error": F.lit(None).cast("string"),
            }
        ),
    )
