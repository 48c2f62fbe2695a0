"""Run a job: ``spark-submit ... -m daybook <job> --lake <folder> ...`` or ``python -m daybook``."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from daybook.functions.days import parse_day, run_days
from daybook.lake import day_table, personal_tables
from daybook.plans.erase import Target, erase
from daybook.plans.jobs import (
    backfill,
    compact,
    curatable_days,
    curate_days,
    day_frame,
    export_days,
    migrate,
    snapshot_accounts,
    trim,
)
from daybook.plans.retention import POLICY, Rule, apply_retention
from daybook.schemas import TRIP_EVENTS
from daybook.session import build_session
from daybook.sources.events import JdbcSource, ParquetSource


def _today() -> dt.date:
    return dt.datetime.now(dt.timezone.utc).date()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="daybook")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str) -> argparse.ArgumentParser:
        p = jobs.add_parser(name, help=about)
        p.add_argument("--lake", required=True, help="root folder of the lake")
        return p

    def dated(p: argparse.ArgumentParser) -> None:
        p.add_argument("--day", help="YYYY-MM-DD; yesterday (UTC) when no day and no range is given")
        p.add_argument("--start", help="first day of a range")
        p.add_argument("--end", help="last day of a range")

    export = job("export", "copy days of the source into raw")
    dated(export)
    source = export.add_mutually_exclusive_group(required=True)
    source.add_argument("--parquet", help="source dataset")
    source.add_argument("--jdbc", help="source database URL")
    export.add_argument("--table", default="trip_events", help="source table in the database")
    export.add_argument("--partitions", type=int, default=16, help="parallel database reads")
    export.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="JDBC property")
    export.add_argument("--drop-synthetic", action="store_true", help="keep test rows out of the lake")
    export.add_argument("--keep-added", action="store_true", help="keep columns the table does not declare (Parquet sources)")
    curating = job("curate", "copy days from raw to curated")
    dated(curating)
    curating.add_argument("--exported-only", action="store_true", help="only days with a successful export manifest")
    curating.add_argument("--dedup", action="store_true", help="keep the newest row of a key only, over all days")
    for p in (export, curating):
        p.add_argument("--cities", help="Parquet of city_code, jurisdiction, valid_from, valid_to: store the jurisdiction")
    hygiene = job("compact", "expire snapshots, remove unreferenced files, publish storage bytes")
    hygiene.add_argument("--keep", type=int, default=1)
    hygiene.add_argument("--max-age-days", type=int, default=5)
    hygiene.add_argument("--merge-to-mb", type=int, help="first merge small files up to this size")
    trimming = job("trim", "create coming partitions, drop exported old ones")
    trimming.add_argument("--today", type=parse_day)
    trimming.add_argument("--retention-days", type=int, default=90)
    trimming.add_argument("--lookahead-days", type=int, default=14)
    trimming.add_argument("--require-equal-counts", action="store_true", help="keep days whose count differs from the manifest")
    erasure = job("erase", "delete an identifier everywhere and verify it")
    erasure.add_argument("--requests", help="Parquet of identifier, request_ref, jurisdiction, account_id: a whole batch")
    erasure.add_argument("--identifier")
    erasure.add_argument("--request-ref")
    erasure.add_argument("--jurisdiction", default="")
    erasure.add_argument("--account-id", type=int, help="the person's account, for tables kept by account")
    retaining = job("retain", "remove rows past the retention of their class and jurisdiction")
    retaining.add_argument("--zone", default="raw")
    retaining.add_argument("--table", required=True)
    retaining.add_argument("--class", dest="data_class", required=True, choices=sorted({r.data_class for r in POLICY}))
    retaining.add_argument("--today", type=parse_day)
    retaining.add_argument("--rule", action="append", default=[], metavar="JURISDICTION=DAYS", help="a period of its own; 0 keeps for ever")
    retaining.add_argument("--cities", help="as for curate, where the table does not store the jurisdiction")
    migration = job("migrate", "rewrite an unpartitioned dataset as the hot table")
    migration.add_argument("--parquet", required=True)
    accounts = job("snapshot-accounts", "copy all accounts into raw as one day")
    accounts.add_argument("--parquet", required=True)
    accounts.add_argument("--day", type=parse_day, required=True)
    return parser


def run(argv: list[str], spark: SparkSession | None = None):
    """Run one job and return its report; raises when the job did not fully succeed."""
    args = _parser().parse_args(argv)
    days = run_days(args.day, args.start, args.end) if args.job in ("export", "curate") else []
    spark = spark or build_session(f"daybook-{args.job}")
    lake = args.lake.rstrip("/")
    raw = day_table(spark, lake, "raw", "trip_events")
    curated = day_table(spark, lake, "curated", "trip_events_curated")
    hot = day_table(spark, lake, "hot", "trip_events")
    cities = spark.read.parquet(args.cities) if getattr(args, "cities", None) else None

    if args.job == "export":
        if args.parquet:
            source = ParquetSource(spark, args.parquet, TRIP_EVENTS, args.keep_added)
        else:
            properties = dict(p.split("=", 1) for p in args.property)
            source = JdbcSource(spark, args.jdbc, args.table, TRIP_EVENTS, args.partitions, properties=properties)
        copy = backfill if args.start else export_days
        return copy(spark, source, raw, lake, days, drop_synthetic=args.drop_synthetic, cities=cities).raise_if_failed()
    if args.job == "curate":
        if args.exported_only:
            ready = curatable_days(spark, lake, raw.spec.name, day_frame(spark, days))
            days = [r.event_date for r in ready.collect()]
        version = "created_at" if args.dedup else None
        return curate_days(spark, raw, curated, lake, days, dedup_by=version, cities=cities).raise_if_failed()
    if args.job == "retain":
        own = tuple(Rule(args.data_class, name, days=int(n)) for name, n in (r.split("=", 1) for r in args.rule))
        table = day_table(spark, lake, args.zone, args.table)
        return apply_retention(spark, table, args.data_class, args.today or _today(), POLICY + own, cities)
    if args.job == "compact":
        merge_to = args.merge_to_mb * 1024**2 if args.merge_to_mb else None
        return compact(spark, [raw, curated], lake, args.keep, dt.timedelta(days=args.max_age_days), merge_to=merge_to)
    if args.job == "snapshot-accounts":
        target = day_table(spark, lake, "raw", "account_snapshots")
        return snapshot_accounts(spark.read.parquet(args.parquet), target, args.day)
    if args.job == "trim":
        return trim(spark, hot, lake, args.today or _today(), args.retention_days, args.lookahead_days, require_equal_counts=args.require_equal_counts)
    if args.job == "erase":
        request = spark.read.parquet(args.requests) if args.requests else spark.createDataFrame(
            [(args.identifier, args.request_ref, args.jurisdiction, args.account_id)],
            "identifier STRING, request_ref STRING, jurisdiction STRING, account_id BIGINT",
        )
        if "account_id" not in request.columns:
            request = request.withColumn("account_id", F.lit(None).cast("bigint"))
        account = request.select("identifier", "account_id").filter("account_id IS NOT NULL").distinct()
        targets = [
            Target(zone, table, account if table.spec.identifier == "account_id" else None)
            for zone, table in personal_tables(spark, lake)
        ]
        done = erase(spark, lake, request, targets)
        # One line per table and error, whatever the size of the batch.
        failed = done.filter("NOT success").groupBy("database", "table_name", "error").count().limit(20).collect()
        if failed:
            raise RuntimeError("; ".join(f"{r.database}.{r.table_name}: {r.error}" for r in failed))
        return done
    return migrate(spark, ParquetSource(spark, args.parquet, TRIP_EVENTS).all_rows(), hot)


if __name__ == "__main__":
    run(sys.argv[1:])
