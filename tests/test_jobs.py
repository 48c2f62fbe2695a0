import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daybook.lake import day_table
from daybook.operators import evidence, partitions
from daybook.operators.cities import CITIES_SCHEMA
from daybook.plans import erase as erase_plan
from daybook.plans import hop, retention
from daybook.plans.dedup import MergeLatest
from daybook.plans.erase import Target, erase
from daybook.plans.hop import RunFailed
from daybook.plans.jobs import (
    MigrationMismatch,
    backfill,
    compact,
    curate_days,
    export_days,
    merge_small_files,
    migrate,
    trim,
)
from daybook.schemas import REWARD_LEDGER, REWARD_LEDGER_MONTHLY, TRIP_EVENTS, TRIP_EVENTS_CURATED
from daybook.sources.events import FrameSource
from daybook.tables.columns import ColumnConflict, accept, added_columns, evolved
from daybook.tables.daytable import DayTable, SnapshotNotFound
from daybook.tables.keyindex import KeyIndex
from daybook.tables.storage import Storage
from tests.fixture import D15, D16, NOW, TRIPS, ids, trips

D17 = dt.date(2026, 1, 17)


@pytest.fixture
def raw(spark, lake_root):
    return DayTable(spark, f"{lake_root}/raw/trip_events", TRIP_EVENTS)


@pytest.fixture
def curated(spark, lake_root):
    return DayTable(spark, f"{lake_root}/curated/trip_events_curated", TRIP_EVENTS_CURATED)


@pytest.fixture
def source(spark):
    return FrameSource(trips(spark), TRIP_EVENTS)


def manifest(lake_root, path):
    with open(f"{lake_root}/{path}") as f:
        return json.load(f)


def run_manifest(lake_root, day, table="trip_events"):
    return manifest(lake_root, evidence.run_path(day.isoformat(), table))


# ---- export ----------------------------------------------------------------------------------------


def test_export_one_day_twice(spark, lake_root, raw, source):
    for _ in range(2):
        report = export_days(spark, source, raw, lake_root, [D15], now=NOW)
        (day,) = report.results
        assert (day.row_count, day.checksum, day.success) == (5, 15, True)
    assert ids(raw.read()) == [1, 2, 3, 4, 5]
    written = run_manifest(lake_root, D15)
    assert written["row_count"] == 5 and written["checksum"] == 15 and written["success"] is True
    assert written["run_date"] == "2026-01-15" and "error" not in written


def test_backfill_includes_empty_days(spark, lake_root, raw, source):
    report = backfill(spark, source, raw, lake_root, [D15, D16, D17], now=NOW)
    assert [(r.row_count, r.checksum) for r in report.results] == [(5, 15), (1, 6), (0, 0)]
    assert report.raise_if_failed() is report
    assert len(raw.snapshot_ids()) == 2
    summary = manifest(lake_root, evidence.backfill_path("2026-01-15", "2026-01-17"))
    assert summary["total_rows"] == 6 and summary["success_count"] == 3 and summary["failure_count"] == 0
    assert [d["row_count"] for d in summary["dates"]] == [5, 1, 0]
    assert run_manifest(lake_root, D17)["row_count"] == 0


def test_a_bad_day_does_not_stop_the_others(spark, lake_root, raw):
    bad = [(7, "hash_veh_x", "", D16, 1.0, 1.0, TRIPS[0][6])]
    days = [dt.date(2026, 1, d) for d in range(13, 20)]
    source = FrameSource(trips(spark, TRIPS + bad), TRIP_EVENTS)
    evidence.write(
        spark, lake_root, evidence.RUN_SCHEMA,
        [(evidence.run_path("2026-01-16", "trip_events"), {"table": "trip_events", "success": True})],
    )
    report = backfill(spark, source, raw, lake_root, days, now=NOW)
    assert [r.event_date for r in report.failed] == [D16]
    assert len(report.results) == 7
    assert ids(raw.read()) == [1, 2, 3, 4, 5]
    failed = run_manifest(lake_root, D16)
    assert failed["success"] is False and failed["error"] and failed["row_count"] == 0
    with pytest.raises(RunFailed):
        report.raise_if_failed()


def test_a_mismatch_fails_the_day_but_counts_its_rows(spark, lake_root, raw, monkeypatch):
    shortened = TRIPS[:3] + TRIPS[5:]
    read = DayTable.read

    def lossy(self, version=None, days=None):
        return read(self, version, days).filter("trip_id NOT IN (4, 5)")

    monkeypatch.setattr(DayTable, "read", lossy)
    report = backfill(spark, FrameSource(trips(spark), TRIP_EVENTS), raw, lake_root, [D15, D16], now=NOW)
    assert [(r.row_count, r.success) for r in report.results] == [(3, False), (1, True)]
    assert "source has 5 row(s) with checksum 15, lake has 3 row(s) with checksum 6" in report.failed[0].error
    summary = manifest(lake_root, evidence.backfill_path("2026-01-15", "2026-01-16"))
    assert summary["total_rows"] == len(shortened) and summary["failure_count"] == 1


def test_days_with_a_gap(spark, lake_root, raw):
    rows = TRIPS + [(8, "v", "BLR", D17, 1.0, 1.0, TRIPS[0][6])]
    report = export_days(spark, FrameSource(trips(spark, rows), TRIP_EVENTS), raw, lake_root, [D15, D17], now=NOW)
    assert not report.failed
    assert ids(raw.read()) == [1, 2, 3, 4, 5, 8]


def test_synthetic_and_erased_rows_can_be_kept_out(spark, lake_root, raw, source):
    export_days(spark, source, raw, lake_root, [D15], drop_synthetic=True, now=NOW)
    assert ids(raw.read()) == []
    register = spark.createDataFrame([("hash_veh_aaa111",)], "vehicle_id_hash STRING")
    export_days(spark, source, raw, lake_root, [D15], erased=register, now=NOW)
    assert ids(raw.read()) == [2, 3, 5]


# ---- curate and hygiene ----------------------------------------------------------------------------


def test_curate_copies_and_records(spark, lake_root, raw, curated, source):
    backfill(spark, source, raw, lake_root, [D15, D16], now=NOW)
    report = curate_days(spark, raw, curated, lake_root, [D15, D16], now=NOW)
    assert [(r.row_count, r.checksum) for r in report.results] == [(5, 15), (1, 6)]
    assert sorted(map(tuple, curated.read().collect())) == sorted(TRIPS)
    assert run_manifest(lake_root, D15, "trip_events_curated")["success"] is True


def test_compact_expires_and_measures(spark, lake_root, raw, curated, source):
    export_days(spark, source, raw, lake_root, [D15], now=NOW)
    export_days(spark, source, raw, lake_root, [D15], now=NOW + dt.timedelta(days=1))
    curate_days(spark, raw, curated, lake_root, [D15], now=NOW)
    done = compact(spark, [raw, curated], lake_root, now=NOW + dt.timedelta(days=30)).collect()
    assert [(r.table_name, r.snapshots_expired, r.paths_removed) for r in done] == [
        ("trip_events", 2, 1),
        ("trip_events_curated", 1, 0),
    ]
    assert ids(raw.read()) == ids(curated.read()) == [1, 2, 3, 4, 5]
    metrics = {r.prefix: r.bytes for r in spark.read.parquet(f"{lake_root}/metrics/storage").collect()}
    assert metrics["raw"] == Storage(spark).usage(f"{lake_root}/raw")[0] > 0
    assert metrics["athena-results/export"] == 0


def test_merging_files_aims_at_a_size(spark, raw):
    raw.create(NOW)
    rows = spark.range(40_000).select(
        F.col("id").alias("trip_id"), F.sha2(F.col("id").cast("string"), 256).alias("vehicle_id_hash"),
        F.when(F.col("id") % 10 == 0, "A B+50%").otherwise("BLR").alias("city_code"), F.lit(D15).alias("event_date"),
        F.rand(1).alias("distance_km"), F.rand(2).alias("fare_amount"),
        F.lit(dt.datetime(2026, 1, 15)).cast("timestamp_ntz").alias("created_at"),
    )
    for part in range(12):
        raw.append(rows.filter(F.col("trip_id") % 12 == part), [D15], now=NOW)
    before = len(raw.read().inputFiles())
    merge_small_files(raw, target_bytes=1024**2, now=NOW)
    assert {r[0] for r in raw.read().select("city_code").distinct().collect()} == {"A B+50%", "BLR"}
    assert 3 <= len(raw.read().inputFiles()) < before
    assert raw.read().count() == 40_000 and raw.read().select("trip_id").distinct().count() == 40_000


def test_merging_files_keeps_the_rows(spark, raw):
    raw.create(NOW)
    for t in TRIPS[:4]:
        raw.append(trips(spark, [t]), [D15], now=NOW)
    raw.append(trips(spark, TRIPS[5:]), [D16], now=NOW)
    assert len(raw.read().inputFiles()) == 5
    merge_small_files(raw, now=NOW)
    assert len(raw.read().inputFiles()) == 2
    assert ids(raw.read()) == [1, 2, 3, 4, 6]
    assert merge_small_files(raw, now=NOW) is None
    # Files that a delete has replaced are still stored, but they are not the table's.
    raw.delete_keys(spark.createDataFrame([(TRIPS[0][1],)], "vehicle_id_hash STRING"), "vehicle_id_hash", now=NOW)
    assert merge_small_files(raw, now=NOW) is None


# ---- migration -------------------------------------------------------------------------------------


def test_migration_moves_everything(spark, raw):
    done = migrate(spark, trips(spark), raw, now=NOW).first()
    assert (done.row_count, done.checksum, done.days) == (6, 21, 2)
    assert sorted(map(tuple, raw.read().collect())) == sorted(TRIPS)


def test_migration_can_be_repeated(spark, raw):
    migrate(spark, trips(spark), raw, now=NOW)
    migrate(spark, trips(spark), raw, now=NOW)
    assert ids(raw.read()) == [1, 2, 3, 4, 5, 6]


def test_migration_stops_on_repeated_keys(spark, raw):
    with pytest.raises(MigrationMismatch):
        migrate(spark, trips(spark, TRIPS + TRIPS[:1]), raw, now=NOW)
    assert raw.read().count() == 0


def test_migration_checksum_of_a_long_id_run(spark, raw):
    rows = spark.range(1, 35_001).select(
        F.col("id").alias("trip_id"), F.lit("v").alias("vehicle_id_hash"), F.lit("BLR").alias("city_code"),
        F.date_add(F.lit(D15), (F.col("id") % 3).cast("int")).alias("event_date"), F.lit(1.0).alias("distance_km"),
        F.lit(1.0).alias("fare_amount"), F.lit(dt.datetime(2026, 1, 1)).cast("timestamp_ntz").alias("created_at"),
    )
    done = migrate(spark, rows, raw, now=NOW).first()
    assert (done.row_count, done.checksum) == (35_000, 612_517_500)


# ---- trim ------------------------------------------------------------------------------------------

GATE = {
    1: '{"table": "trip_events", "success": true, "row_count": 1}',
    2: '{"table": "trip_events", "success": false}',
    3: '{"table": "trip_events"}',
    4: '{"table": "trip_events", "succ',
    5: '{"table": "trip_events", "success": "yes"}',
    6: "",
    7: None,
    8: '{"success": true} x',
    9: '{"success": true}, {"success": true}',
    10: "[]",
    11: "null",
    12: '{\n  "success": true,\n  "row_count": 1\n}\n',
}


def test_retention_gate(spark, lake_root):
    hot = DayTable(spark, f"{lake_root}/hot/trip_events", TRIP_EVENTS).create(NOW)
    days = [dt.date(2026, 1, d) for d in range(1, 14)]
    rows = [(d.day, "v", "BLR", d, 1.0, 1.0, TRIPS[0][6]) for d in days]
    hot.replace_days(trips(spark, rows + [(99, *rows[11][1:])]), days, now=NOW)
    storage = Storage(spark)
    for d in days[:12]:
        if GATE[d.day] is not None:
            storage.write_text(f"{lake_root}/{evidence.run_path(d.isoformat(), 'trip_events')}", GATE[d.day])
    report = trim(spark, hot, lake_root, dt.date(2026, 1, 16), retention_days=3, lookahead_days=2, now=NOW)
    assert report.created == ["trip_events_y2026_m01_d16", "trip_events_y2026_m01_d17"]
    assert [(d.day, n, recorded) for d, n, recorded in report.dropped] == [(1, 1, 1), (12, 2, 1)]
    reasons = {d.day: why for d, why in report.skipped}
    assert reasons == {
        2: evidence.NOT_SUCCESSFUL,
        3: evidence.NOT_SUCCESSFUL,
        4: evidence.PARSE_ERROR,
        5: evidence.PARSE_ERROR,
        6: evidence.PARSE_ERROR,
        7: evidence.NO_MANIFEST,
        8: evidence.PARSE_ERROR,
        9: evidence.PARSE_ERROR,
        10: evidence.PARSE_ERROR,
        11: evidence.PARSE_ERROR,
    }
    late = {r.event_date.day: r.late_rows for r in report.frame(spark).filter("outcome = 'dropped'").collect()}
    assert late == {1: 0, 12: 1}
    assert dt.date(2026, 1, 13) in hot.days() and dt.date(2026, 1, 1) not in hot.days()
    summary = manifest(lake_root, evidence.trim_path("2026-01-16"))
    assert summary["success"] is True and len(summary["partitions_skipped"]) == 10
    assert summary["partitions_dropped"][0] == {"date": "2026-01-01", "row_count": 1}


def test_trim_can_insist_on_equal_counts(spark, lake_root):
    hot = DayTable(spark, f"{lake_root}/hot/trip_events", TRIP_EVENTS).create(NOW)
    hot.replace_days(trips(spark), [D15, D16], now=NOW)
    raw = DayTable(spark, f"{lake_root}/raw/trip_events", TRIP_EVENTS)
    export_days(spark, FrameSource(trips(spark, TRIPS[1:]), TRIP_EVENTS), raw, lake_root, [D15, D16], now=NOW)
    report = trim(spark, hot, lake_root, D16 + dt.timedelta(days=9), 3, 2, now=NOW, require_equal_counts=True)
    assert [d for d, _, _ in report.dropped] == [D16]
    assert report.skipped == [(D15, "row count differs from the manifest")]
    assert ids(hot.read()) == [1, 2, 3, 4, 5]


def test_a_run_that_is_lost_leaves_no_old_success(spark, lake_root, monkeypatch):
    raw = DayTable(spark, f"{lake_root}/raw/trip_events", TRIP_EVENTS)
    source = FrameSource(trips(spark), TRIP_EVENTS)
    export_days(spark, source, raw, lake_root, [D15, D16], now=NOW).raise_if_failed()
    monkeypatch.setattr(hop, "_copy_chunk", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        export_days(spark, source, raw, lake_root, [D15, D16], now=NOW)
    found = evidence.scan_run_manifests(spark, lake_root, "trip_events")
    assert found.count() == 2 and evidence.successful_days(found).count() == 0


def test_trim_counts_add_up(spark, lake_root):
    """362 partitions, 31 of the old ones proven, 14 new days: 345 remain."""
    hot = DayTable(spark, f"{lake_root}/hot/trip_events", TRIP_EVENTS).create(NOW)
    today = dt.date(2026, 9, 25)
    days = [today - dt.timedelta(days=i) for i in range(1, 363)]
    hot.add_days(days, NOW)
    proven = [d for d in days if d < today - dt.timedelta(days=90)][:31]
    evidence.write(
        spark, lake_root, evidence.RUN_SCHEMA,
        [(evidence.run_path(d.isoformat(), "trip_events"), {"table": "trip_events", "success": True}) for d in proven],
    )
    report = trim(spark, hot, lake_root, today, now=NOW)
    assert (len(report.created), len(report.dropped), len(hot.days())) == (14, 31, 345)


def test_a_failed_trim_is_recorded(spark, lake_root):
    hot = DayTable(spark, f"{lake_root}/hot/none", TRIP_EVENTS)
    with pytest.raises(SnapshotNotFound):
        trim(spark, hot, lake_root, D15, now=NOW)
    summary = manifest(lake_root, evidence.trim_path("2026-01-15"))
    assert summary["success"] is False and summary["error"]
    with pytest.raises(ValueError):
        trim(spark, hot, lake_root, D15, retention_days=0)


# ---- erasure ---------------------------------------------------------------------------------------


def _request(spark, *requests):
    return spark.createDataFrame(list(requests), "identifier STRING, request_ref STRING, jurisdiction STRING")


def _ordered(done):
    """Rows by request; raw before curated."""
    return done.orderBy("request_ref", F.desc("database")).collect()


@pytest.fixture
def lake(spark, lake_root, raw, curated, source):
    backfill(spark, source, raw, lake_root, [D15, D16], now=NOW)
    curate_days(spark, raw, curated, lake_root, [D15], now=NOW)
    return [Target("raw", raw), Target("curated", curated)]


def test_erasure(spark, lake_root, lake):
    done = _ordered(erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-1", "IN")), lake, now=NOW))
    assert [(r.table_name, r.rows_before, r.rows_after_delete, r.time_travel_blocked, r.success) for r in done] == [
        ("trip_events", 2, 0, True, True),
        ("trip_events_curated", 2, 0, True, True),
    ]
    assert ids(lake[0].table.read()) == [2, 3, 5, 6]
    assert ids(lake[1].table.read()) == [2, 3, 5]
    record = manifest(lake_root, evidence.erasure_path("2026-01-17", "REQ-1"))
    assert record["success"] is True and record["jurisdiction"] == "IN" and len(record["tables"]) == 2
    # Nothing on disk shows the identifier any more.
    for target in lake:
        left = spark.read.option("recursiveFileLookup", "true").parquet(target.table.data_root)
        assert left.filter("vehicle_id_hash = 'hash_veh_aaa111'").count() == 0


def test_erasure_where_one_table_has_nothing(spark, lake_root, lake):
    request = _request(spark, ("hash_veh_eee555", "REQ-2", None), ("nobody", "REQ-3", ""))
    done = {(r.request_ref, r.database): r for r in erase(spark, lake_root, request, lake, now=NOW).collect()}
    assert done["REQ-2", "raw"].rows_before == 1 and done["REQ-2", "raw"].time_travel_blocked
    for key in (("REQ-2", "curated"), ("REQ-3", "raw"), ("REQ-3", "curated")):
        assert done[key].success and done[key].rows_before == 0
        assert not done[key].time_travel_blocked and done[key].pre_erasure_snapshot_id is None
    record = manifest(lake_root, evidence.erasure_path("2026-01-17", "REQ-3"))
    assert record["success"] is True and "pre_erasure_snapshot_id" not in record["tables"][0]
    assert "jurisdiction" not in record


def test_a_failing_table_does_not_stop_the_next(spark, lake_root, lake, monkeypatch):
    monkeypatch.setattr(lake[0].table, "expire", lambda *a, **k: 1 / 0)
    done = _ordered(erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-4", "")), lake, now=NOW))
    assert [(r.success, bool(r.error)) for r in done] == [(False, True), (True, False)]
    assert manifest(lake_root, evidence.erasure_path("2026-01-17", "REQ-4"))["success"] is False


def test_history_that_can_still_be_read_is_a_failure(spark, lake_root, lake, monkeypatch):
    monkeypatch.setattr(lake[0].table, "expire", lambda *a, **k: [])
    done = _ordered(erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-5", "")), lake, now=NOW))
    assert "can still be read" in done[0].error and not done[0].success


def test_the_request_is_on_record_first(spark, lake_root, lake, monkeypatch):
    def check(*args):
        record = manifest(lake_root, evidence.erasure_path("2026-01-17", "REQ-6"))
        assert record["success"] is False and "finished_at" not in record and record["tables"] == []
        raise RuntimeError("stop here")

    monkeypatch.setattr(erase_plan, "erase_from", check)
    with pytest.raises(RuntimeError, match="stop here"):
        erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-6", "")), lake, now=NOW)


def test_bad_requests_are_refused_before_anything_happens(spark, lake_root, lake):
    with pytest.raises(ValueError, match="request_ref"):
        erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "../../raw/x", "")), lake, now=NOW)
    assert ids(lake[0].table.read()) == [1, 2, 3, 4, 5, 6]
    assert not Storage(spark).exists(f"{lake_root}/{evidence.ROOT}/erasure")


def test_a_delete_that_would_lose_rows_is_not_published(spark, lake, monkeypatch):
    from daybook.tables import daytable

    table = lake[0].table
    monkeypatch.setattr(daytable, "without", lambda rows, keys, column: rows.filter("trip_id NOT IN (1, 2, 4)"))
    with pytest.raises(daytable.BadBatch):
        table.delete_keys(spark.createDataFrame([("hash_veh_aaa111",)], "vehicle_id_hash STRING"), "vehicle_id_hash")
    assert ids(table.read()) == [1, 2, 3, 4, 5, 6]


def test_a_second_attempt_cleans_up_what_the_first_left(spark, lake_root, lake, monkeypatch):
    table = lake[0].table
    with monkeypatch.context() as patch:
        patch.setattr(table, "expire", lambda *a, **k: 1 / 0)
        erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-7", "")), lake, now=NOW)
    assert table.read(version=2).filter("vehicle_id_hash = 'hash_veh_aaa111'").count() == 2
    done = _ordered(erase(spark, lake_root, _request(spark, ("hash_veh_aaa111", "REQ-8", "")), lake, now=NOW))
    assert all(r.success for r in done)
    with pytest.raises(SnapshotNotFound):
        table.read(version=2)
    left = spark.read.option("recursiveFileLookup", "true").parquet(table.data_root)
    assert left.filter("vehicle_id_hash = 'hash_veh_aaa111'").count() == 0


def test_request_references_name_one_record_each(spark, lake_root, lake):
    request = _request(spark, ("hash_veh_aaa111", "REQ-9", ""), ("hash_veh_bbb222", "REQ-9", ""))
    with pytest.raises(ValueError, match="unique"):
        erase(spark, lake_root, request, lake, now=NOW)


def test_a_batch_of_100_000_requests_stays_in_frames(spark, lake_root, lake, monkeypatch):
    """No list of requests, keys, counts or files comes to the driver, and every request has its record."""
    from pyspark.sql.classic.dataframe import DataFrame

    brought = []
    collect = DataFrame.collect

    def counted(frame):
        rows = collect(frame)
        brought.append(len(rows))
        return rows

    size = 100_000
    known = {1: "hash_veh_aaa111", 2: "hash_veh_bbb222", 3: "hash_veh_aaa111"}
    identifier = F.col("id").cast("string")
    for i, vehicle in known.items():
        identifier = F.when(F.col("id") == i, vehicle).otherwise(identifier)
    request = spark.range(size, numPartitions=8).select(
        identifier.alias("identifier"), F.concat(F.lit("REQ-"), "id").alias("request_ref"), F.lit("IN").alias("jurisdiction")
    )
    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "collect", counted)
        done = erase(spark, lake_root, request, lake, now=NOW)
    assert max(brought) <= 8  # days and log entries
    assert done.count() == 2 * size and done.filter("NOT success").count() == 0
    found = {(r.request_ref, r.database): r.rows_before for r in done.filter("rows_before > 0").collect()}
    raw_rows = {"hash_veh_aaa111": 2, "hash_veh_bbb222": sum(t[1] == "hash_veh_bbb222" for t in TRIPS)}
    assert {k: n for k, n in found.items() if k[1] == "raw"} == {(f"REQ-{i}", "raw"): raw_rows[v] for i, v in known.items()}
    gone = {t[0] for t in TRIPS if t[1] in known.values()}
    assert ids(lake[0].table.read()) == [t[0] for t in TRIPS if t[0] not in gone]
    folder = f"{lake_root}/{evidence.ROOT}/erasure/2026-01-17"
    records = spark.read.schema(evidence.ERASURE_SCHEMA).option("multiLine", "true").json([f"{folder}/REQ-{i}.json" for i in (0, 1, 99_999)])
    assert {(r.request_ref, r.success, len(r.tables)) for r in records.collect()} == {("REQ-0", True, 2), ("REQ-1", True, 2), ("REQ-99999", True, 2)}
    assert Storage(spark).usage(folder)[1] == size


def test_an_identifier_under_several_keys(spark, lake_root):
    ledger = DayTable(spark, f"{lake_root}/raw/reward_ledger", REWARD_LEDGER).create(NOW)
    entries = spark.createDataFrame(
        [(i, i % 4, "BLR", "reward", None, D15, None) for i in range(12)], ledger.spec.schema
    )
    ledger.replace_days(entries, [D15], now=NOW)
    accounts = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("b", 77), ("c", None)], "identifier STRING, account_id BIGINT")
    request = _request(spark, ("a", "REQ-1", ""), ("b", "REQ-2", ""), ("c", "REQ-3", ""))
    done = erase(spark, lake_root, request, [Target("raw", ledger, accounts)], now=NOW)
    assert [(r.identifier, r.rows_before, r.success) for r in _ordered(done)] == [("a", 6, True), ("b", 3, True), ("c", 0, True)]
    assert sorted(r.ledger_id for r in ledger.read().collect()) == [0, 4, 8]


# ---- SQL users and the command line ----------------------------------------------------------------


def test_tables_as_views(spark, lake):
    name = lake[1].table.as_view()
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE event_date = DATE '2026-01-15'").first()[0] == 5
    lake[0].table.as_view("raw_trips")
    log = spark.sql("SELECT snapshot_id FROM `raw_trips$snapshots` ORDER BY committed_at DESC, snapshot_id DESC LIMIT 1")
    assert log.first()[0] == 2
    lake[0].table.as_view("trips_before", version=1)
    assert spark.table("trips_before").count() == 0


def test_command_line(spark, lake_root):
    from daybook.__main__ import run

    trips(spark).write.parquet(f"{lake_root}/source")
    lake = f"{lake_root}/lake"
    report = run(["export", "--lake", lake, "--parquet", f"{lake_root}/source", "--start", "2026-01-15",
                  "--end", "2026-01-16"], spark)
    assert [r.row_count for r in report.results] == [5, 1]
    run(["export", "--lake", lake, "--parquet", f"{lake_root}/source", "--day", "2026-01-15"], spark)
    ready = run(["curate", "--lake", lake, "--start", "2026-01-14", "--end", "2026-01-15", "--exported-only"], spark)
    assert [r.event_date for r in ready.results] == [D15]
    erased = run(["erase", "--lake", lake, "--identifier", "hash_veh_aaa111", "--request-ref", "REQ-1"], spark)
    assert [r.rows_before for r in erased.collect()] == [2, 2]
    assert run(["compact", "--lake", lake, "--max-age-days", "0"], spark).count() == 2
    accounts = spark.createDataFrame([(7, "h", "BLR", "active"), (8, "i", "DEL", "active")], "account_id LONG, email_hash STRING, city_code STRING, status STRING")
    accounts.write.parquet(f"{lake_root}/accounts")
    for _ in range(2):
        assert run(["snapshot-accounts", "--lake", lake, "--parquet", f"{lake_root}/accounts", "--day", "2026-01-15"], spark).rows == 2
    gone = run(["erase", "--lake", lake, "--identifier", "hash_veh_bbb222", "--request-ref", "REQ-2", "--account-id", "7"], spark)
    assert {(r.table_name, r.rows_before, r.rows_after_delete) for r in gone.collect()} >= {("account_snapshots", 1, 0), ("trip_events", 1, 0)}
    assert run(["compact", "--lake", lake, "--merge-to-mb", "64"], spark).count() == 2
    assert run(["migrate", "--lake", lake, "--parquet", f"{lake_root}/source"], spark).first().row_count == 6
    done = run(["trim", "--lake", lake, "--today", "2026-01-20", "--retention-days", "4"], spark)
    assert [d for d, _, _ in done.dropped] == [D15]
    with pytest.raises(ValueError):
        run(["export", "--lake", lake, "--parquet", "x", "--start", "2026-01-15"], spark)


def test_command_line_of_the_governed_lake(spark, lake_root):
    from daybook.__main__ import run

    lake, source, cities = f"{lake_root}/lake", f"{lake_root}/source", f"{lake_root}/cities"
    trips(spark).withColumn("surge", F.lit(2.0)).write.parquet(source)
    spark.createDataFrame(CITIES, CITIES_SCHEMA).write.parquet(cities)
    run(["export", "--lake", lake, "--parquet", source, "--start", "2026-01-15", "--end", "2026-01-16", "--keep-added"], spark)
    run(["curate", "--lake", lake, "--start", "2026-01-15", "--end", "2026-01-16", "--dedup", "--cities", cities], spark)
    curated = evolved(day_table(spark, lake, "curated", "trip_events_curated"))
    assert curated.spec.columns == [*TRIP_EVENTS.columns, "jurisdiction", "surge"]
    assert ids(curated.read().filter("surge = 2.0")) == [1, 2, 3, 4, 5, 6]
    done = run(["retain", "--lake", lake, "--table", "trip_events", "--class", "trip", "--today", "2026-04-16", "--cities", cities,
                "--rule", "IN-KA=1"], spark)
    assert [r.event_date for r in done.collect()][0] == D15
    requests = _request(spark, ("hash_veh_aaa111", "REQ-1", ""), ("hash_veh_bbb222", "REQ-2", ""))
    requests.write.parquet(f"{lake_root}/requests")
    erased = run(["erase", "--lake", lake, "--requests", f"{lake_root}/requests"], spark)
    assert erased.count() == 4 and ids(curated.read()) == [3, 5, 6]
    with pytest.raises(ValueError, match="both required"):
        run(["erase", "--lake", lake, "--identifier", "hash_veh_aaa111"], spark)


# ---- columns, cities and one row per key ----------------------------------------------------------------

TRIP = "trip_id long, vehicle_id_hash string, city_code string, event_date date, distance_km double, fare_amount double, created_at timestamp_ntz"


def _at(hour):
    return dt.datetime(2026, 1, 15, hour)


def _trips(spark, *rows):
    """(key, day, version hour, fare) as trips."""
    return spark.createDataFrame([(k, f"v{k}", "BLR", d, 1.0, float(fare), _at(h)) for k, d, h, fare in rows], TRIP)


def _state(table):
    return sorted((r.trip_id, r.event_date, r.created_at.hour, r.fare_amount) for r in table.read().collect())


def test_curate_keeps_the_newest_row_of_a_key_over_all_days(spark, lake_root, raw, curated):
    first = _trips(spark, (1, D15, 5, 1), (2, D15, 5, 1), (3, D15, 5, 1), (4, D15, 5, 1), (4, D15, 6, 2), (4, D15, 6, 2))
    export_days(spark, FrameSource(first, TRIP_EVENTS), raw, lake_root, [D15], now=NOW).raise_if_failed()
    report = curate_days(spark, raw, curated, lake_root, [D15], now=NOW, dedup_by="created_at").raise_if_failed()
    assert report.results[0].row_count == 4
    assert _state(curated) == [(1, D15, 5, 1), (2, D15, 5, 1), (3, D15, 5, 1), (4, D15, 6, 2)]
    # The next day brings a newer row of 1, an older one of 2, one of 3 that is just as new but larger, and a new key.
    second = _trips(spark, (1, D16, 9, 7), (2, D16, 1, 7), (3, D16, 5, 7), (5, D16, 5, 7))
    export_days(spark, FrameSource(second, TRIP_EVENTS), raw, lake_root, [D16], now=NOW).raise_if_failed()
    for _ in range(2):  # and a second run changes nothing
        report = curate_days(spark, raw, curated, lake_root, [D16], now=NOW, dedup_by="created_at").raise_if_failed()
        assert _state(curated) == [(1, D16, 9, 7), (2, D15, 5, 1), (3, D16, 5, 7), (4, D15, 6, 2), (5, D16, 5, 7)]
    assert report.results[0].row_count == 3
    assert curated.read(version=2).count() == 4  # what was there before can still be read
    # The same days in the other order end up the same.
    other = DayTable(spark, f"{lake_root}/curated/other", TRIP_EVENTS_CURATED)
    for day in (D16, D15):
        curate_days(spark, raw, other, lake_root, [day], now=NOW, dedup_by="created_at").raise_if_failed()
    assert _state(other) == _state(curated)


def test_dedup_against_plain_version(spark, lake_root, raw, curated):
    import random

    rng = random.Random(4)
    days = [D15 + dt.timedelta(days=i) for i in range(5)]
    rows = [(rng.randrange(40) - 5, rng.choice(days), rng.randrange(4), rng.randrange(3)) for _ in range(150)]
    export_days(spark, FrameSource(_trips(spark, *rows), TRIP_EVENTS), raw, lake_root, days, now=NOW).raise_if_failed()
    for chunk in ([days[2]], [days[4], days[0]], [days[1]], [days[3]], [days[2]]):
        curate_days(spark, raw, curated, lake_root, chunk, now=NOW, dedup_by="created_at").raise_if_failed()
    newest = {}
    for k, d, h, fare in rows:  # columns after the version, in the table's order, settle ties
        newest[k] = max(newest.get(k, (-1,)), (h, d, fare))
    assert _state(curated) == sorted((k, d, h, fare) for k, (h, d, fare) in newest.items())


def test_dedup_reads_only_files_that_hold_a_key(spark, lake_root, raw, curated):
    days = [D15 + dt.timedelta(days=i) for i in range(8)]
    rows = _trips(spark, *[(1000 * i + k, d, 5, 1) for i, d in enumerate(days) for k in range(50)])
    export_days(spark, FrameSource(rows, TRIP_EVENTS), raw, lake_root, days, now=NOW).raise_if_failed()
    curate_days(spark, raw, curated, lake_root, days, now=NOW, dedup_by="created_at").raise_if_failed()
    before = set(curated.read().inputFiles())
    late = days[-1] + dt.timedelta(days=1)
    batch = _trips(spark, (2003, late, 9, 2), (2004, late, 1, 2), (5999, late, 9, 2), (99_000_000, late, 5, 2))
    merge = MergeLatest(curated, "created_at", NOW)
    merge.write(batch, [late])
    # 5999 lies in the range of no file; 2003 replaces a row and 2004 is older than the stored one.
    assert merge.files_read == 1
    assert len(before - set(curated.read().inputFiles())) == 1
    assert sorted(r.trip_id for r in curated.read(days=[late]).collect()) == [2003, 5999, 99_000_000]
    assert curated.read().count() == 8 * 50 + 2
    merge.write(_trips(spark, (777_777, late, 1, 1)), [late])
    assert merge.files_read == 0
    assert KeyIndex(curated).prune() == 0
    curated.forget_history(NOW)
    assert curated.read().count() == 8 * 50 and KeyIndex(curated).refresh() >= 0


@pytest.mark.parametrize("keys", [[1], [0, -1, -40_000], [32_768, 32_769, 65_536, 10**15], list(range(-50, 50))])
def test_key_index_is_exact(spark, raw, keys):
    raw.create(NOW).replace_days(_trips(spark, *[(k, D15, 1, 1) for k in keys]), [D15], now=NOW)
    index = KeyIndex(raw)
    assert index.refresh() == 1 and index.refresh() == 0
    probes = sorted({k + d for k in keys for d in (-1, 0, 1, 32_768)})
    for k in probes[:40]:
        assert (index.holders(spark.createDataFrame([(k,)], "trip_id long")).count() > 0) == (k in keys), k


def test_a_lost_index_build_is_made_again(spark, raw):
    raw.create(NOW).replace_days(_trips(spark, (1, D15, 1, 1)), [D15], now=NOW)
    index = KeyIndex(raw)
    index.refresh()
    for entry in raw.storage.list(index.root):
        if entry.name.endswith(".json"):
            raw.storage.delete(entry.path)
    assert index.rows().count() == 0
    assert index.refresh() == 1 and index.rows().count() == 1


def test_added_columns_are_kept_by_export_and_curate(spark, lake_root, raw, curated):
    old = _trips(spark, (1, D15, 5, 1))
    export_days(spark, FrameSource(old, TRIP_EVENTS), raw, lake_root, [D15], now=NOW).raise_if_failed()
    curate_days(spark, raw, curated, lake_root, [D15], now=NOW).raise_if_failed()
    new = _trips(spark, (2, D16, 5, 1)).drop("fare_amount").withColumn("surge", F.lit(1.5)).withColumn("Note", F.lit(None))
    export_days(spark, FrameSource(new, TRIP_EVENTS, keep_added=True), raw, lake_root, [D16], now=NOW).raise_if_failed()
    curate_days(spark, raw, curated, lake_root, [D16], now=NOW).raise_if_failed()
    for table in (raw, curated):
        assert table.read().columns == TRIP_EVENTS.columns  # declared readers see what they declared
        assert [(a.name, a.type, a.since) for a in added_columns(table)] == [("surge", "double", 3)]
        rows = {r.trip_id: r for r in evolved(table).read().collect()}
        assert (rows[1].surge, rows[2].surge, rows[2].fare_amount) == (None, 1.5, None)
        assert "surge" not in evolved(table, version=2).read(version=2).columns
    # Curated again without anything new: the column stays.
    curate_days(spark, raw, curated, lake_root, [D15, D16], now=NOW).raise_if_failed()
    assert {r.surge for r in evolved(curated).read().collect()} == {None, 1.5}


@pytest.mark.parametrize(
    ("change", "problem"),
    [
        ({"surge": "'high'"}, "holds double"),
        ({"SURGE": "true"}, "holds double"),
        ({"trip_id": "'x'"}, "holds bigint"),
        ({"bad name": "1"}, "no name"),
        ({"surge": "1"}, None),
        ({"extra": "1"}, None),
    ],
)
def test_columns_do_not_change_their_type(spark, raw, change, problem):
    raw.create(NOW)
    accept(raw, _trips(spark, (1, D15, 5, 1)).withColumn("surge", F.lit(1.5)))
    rows = _trips(spark, (1, D15, 5, 1)).withColumns({name: F.expr(e) for name, e in change.items()})
    if problem:
        with pytest.raises(ColumnConflict, match=problem):
            accept(raw, rows)
        assert [a.name for a in added_columns(raw)] == ["surge"]
    else:
        accept(raw, rows)
        assert {a.name for a in added_columns(raw)} == {"surge", *change}


CITIES = [("BLR", "IN", None, D16), ("BLR", "IN-KA", D16, None), ("MUM", "IN", D16, None)]


def test_jurisdiction_is_that_of_the_day(spark, lake_root, raw, curated):
    cities = spark.createDataFrame(CITIES, CITIES_SCHEMA)
    rows = _trips(spark, (1, D15, 5, 1), (2, D16, 5, 1), (3, D15, 5, 1), (4, D16, 5, 1), (5, D16, 5, 1)).withColumn(
        "city_code", F.when(F.col("trip_id").isin(3, 4), "MUM").when(F.col("trip_id") == 5, "XXX").otherwise("BLR")
    )
    export_days(spark, FrameSource(rows, TRIP_EVENTS), raw, lake_root, [D15, D16], now=NOW).raise_if_failed()
    curate_days(spark, raw, curated, lake_root, [D15, D16], now=NOW, cities=cities).raise_if_failed()
    found = {r.trip_id: r.jurisdiction for r in evolved(curated).read().collect()}
    assert found == {1: "IN", 2: "IN-KA", 3: None, 4: "IN", 5: None}
    again = DayTable(spark, f"{lake_root}/raw/again", TRIP_EVENTS)
    export_days(spark, FrameSource(rows, TRIP_EVENTS), again, lake_root, [D15, D16], now=NOW, cities=cities).raise_if_failed()
    assert {r.trip_id: r.jurisdiction for r in evolved(again).read().collect()} == found
    twice = spark.createDataFrame([*CITIES, ("BLR", "EU", D17, None)], CITIES_SCHEMA)
    with pytest.raises(ValueError, match="overlap"):
        curate_days(spark, raw, curated, lake_root, [D15], now=NOW, cities=twice)


def test_curate_counts_raw_by_itself(spark, lake_root, raw, curated, source, monkeypatch):
    """Rows that are lost between raw and the write are noticed, for one day as for many."""
    export_days(spark, source, raw, lake_root, [D15, D16], now=NOW).raise_if_failed()
    replace_days = DayTable.replace_days
    monkeypatch.setattr(
        DayTable, "replace_days", lambda self, rows, *a, **k: replace_days(self, rows.filter("trip_id <> 1"), *a, **k)
    )
    for days in ([D15], [D15, D16]):
        report = curate_days(spark, raw, curated, lake_root, days, now=NOW)
        assert [(r.event_date, r.success) for r in report.results] == [(d, d != D15) for d in days]
        assert "mismatch" in report.results[0].error


# ---- retention, merging, migration and bad days: what they read and write --------------------------------


def _fares(spark, *rows):
    """(key, city, day) as trips."""
    return trips(spark, [(k, "v", c, d, 1.0, 1.0, TRIPS[0][6]) for k, c, d in rows])


TODAY = dt.date(2026, 3, 1)
RULES = (
    retention.Rule("trip", days=30), retention.Rule("trip", "IN-KA", days=45), retention.Rule("trip", "EU"),
    retention.Rule("camera", days=1),
)


def test_retention_drops_days_and_rewrites_mixed_ones(spark, raw):
    raw.create(NOW)
    days = [dt.date(2026, 1, 1), D15, D16, dt.date(2026, 1, 30), dt.date(2026, 2, 20)]
    rows = [(10 * i + j, c, d) for i, d in enumerate(days) for j, c in enumerate(("BLR", "MUM", "BUD", "XXX"))]
    raw.replace_days(_fares(spark, *rows), days, now=NOW)
    cities = spark.createDataFrame([("BLR", "IN-KA", None, None), ("MUM", "IN", None, None)], CITIES_SCHEMA)
    # General cutoff 30 January, that of IN-KA 15 January.
    no_eu = tuple(r for r in RULES if r.jurisdiction != "EU")
    files = set(raw.read().inputFiles())
    done = retention.apply_retention(spark, raw, "trip", TODAY, no_eu, cities, NOW)
    assert [tuple(r) for r in done.collect()] == [(days[0], "dropped", None), (D15, "rewritten", 3), (D16, "rewritten", 3)]
    assert ids(raw.read()) == [10, 20, *range(30, 34), *range(40, 44)]
    assert set(raw.read().inputFiles()) < files  # files are by city, so none had to be rewritten
    assert days[0] not in raw.days() and raw.read(version=2).count() == 20
    again = retention.apply_retention(spark, raw, "trip", TODAY, no_eu, cities, NOW)
    assert again.count() == 0


def test_retention_with_a_jurisdiction_that_keeps_everything(spark, raw):
    raw.create(NOW)
    days = [dt.date(2026, 1, 1), dt.date(2026, 2, 20)]
    raw.replace_days(_fares(spark, (1, "BLR", days[0]), (2, "BUD", days[0]), (3, "XXX", days[0]), (4, "XXX", days[1])), days, now=NOW)
    with pytest.raises(ValueError, match="cities"):
        retention.apply_retention(spark, raw, "trip", TODAY, RULES, now=NOW)
    cities = spark.createDataFrame([("BLR", "IN-KA", None, None), ("BUD", "EU", None, None)], CITIES_SCHEMA)
    done = retention.apply_retention(spark, raw, "trip", TODAY, RULES, cities, NOW)
    assert [tuple(r) for r in done.collect()] == [(days[0], "rewritten", 2)]
    assert ids(raw.read()) == [2, 4]
    assert retention.apply_retention(spark, raw, "account", TODAY, retention.POLICY).count() == 0  # kept for ever


def test_retention_uses_the_stored_jurisdiction(spark, lake_root, raw):
    cities = spark.createDataFrame([("BLR", "IN-KA", None, None)], CITIES_SCHEMA)
    day = dt.date(2026, 1, 20)
    source = FrameSource(_fares(spark, (1, "BLR", day), (2, "MUM", day)), TRIP_EVENTS)
    export_days(spark, source, raw, lake_root, [day], now=NOW, cities=cities).raise_if_failed()
    retention.apply_retention(spark, raw, "trip", TODAY, RULES, now=NOW)
    assert [(r.trip_id, r.jurisdiction) for r in evolved(raw).read().collect()] == [(1, "IN-KA")]


def test_retention_of_months_keeps_rows_of_a_mixed_month(spark, lake_root):
    ledger = DayTable(spark, f"{lake_root}/raw/reward_ledger", REWARD_LEDGER_MONTHLY).create(NOW)
    days = [dt.date(2018, 12, 31), dt.date(2019, 2, 27), dt.date(2019, 2, 28), dt.date(2019, 3, 1), dt.date(2019, 3, 2)]
    rows = [(i, 1, "BLR", "reward", None, d, None, d.replace(day=1)) for i, d in enumerate(days)]
    entries = spark.createDataFrame(rows, ledger.spec.schema)
    ledger.replace_days(entries, {d.replace(day=1) for d in days}, now=NOW)
    done = retention.apply_retention(spark, ledger, "ledger", TODAY, now=NOW)  # 84 months
    assert [tuple(r) for r in done.collect()] == [
        (dt.date(2018, 12, 1), "dropped", None), (dt.date(2019, 2, 1), "dropped", None),
    ]
    done = retention.apply_retention(spark, ledger, "ledger", TODAY + dt.timedelta(days=1), now=NOW)
    assert [tuple(r) for r in done.collect()] == [(dt.date(2019, 3, 1), "rewritten", 1)]
    assert [r.ledger_id for r in ledger.read().collect()] == [4]


def test_policies_name_a_jurisdiction_once():
    with pytest.raises(ValueError, match="two rules"):
        retention.cutoffs((*RULES, retention.Rule("trip", "EU", days=1)), "trip", TODAY)
    assert retention.cutoffs(RULES, "nothing", TODAY).all == [None]


def test_merging_reads_small_files_only(spark, raw):
    raw.create(NOW)
    big = spark.range(60_000).select(
        (F.col("id") + 1000).alias("trip_id"), F.sha2(F.col("id").cast("string"), 256).alias("vehicle_id_hash"),
        F.lit("BLR").alias("city_code"), F.lit(D15).alias("event_date"), F.rand(1).alias("distance_km"),
        F.rand(2).alias("fare_amount"), F.lit(dt.datetime(2026, 1, 15)).cast("timestamp_ntz").alias("created_at"),
    ).coalesce(1)
    raw.append(big, [D15], now=NOW)
    large = set(raw.read().inputFiles())
    for k in range(5):
        raw.append(_fares(spark, (k, "BLR", D15)), [D15], now=NOW)
    raw.append(_fares(spark, (90, "MUM", D15)), [D15], now=NOW)
    alone = {f for f in raw.read().inputFiles() if "MUM" in f}
    commit = merge_small_files(raw, target_bytes=2 * 1024**2, now=NOW)
    assert commit.rows == 5  # what was written again
    after = set(raw.read().inputFiles())
    assert large <= after and alone <= after and len(after) == len(large) + 2
    assert raw.read().count() == 60_006
    assert merge_small_files(raw, target_bytes=2 * 1024**2, now=NOW) is None


def test_migration_reads_the_old_table_once_and_names_repeated_keys(spark, raw, lake_root):
    trips(spark).write.parquet(f"{lake_root}/old")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    schema = TRIP_EVENTS.schema
    old = spark.read.schema(schema).parquet(f"{lake_root}/old").mapInArrow(counted, schema)
    assert migrate(spark, old, raw, now=NOW).first().row_count == len(TRIPS)
    assert reads.value == len(TRIPS)
    other = DayTable(spark, f"{lake_root}/raw/other", TRIP_EVENTS)
    with pytest.raises(MigrationMismatch, match="keys repeat, the first are 2, 5"):
        migrate(spark, trips(spark, [*TRIPS, TRIPS[4], TRIPS[1]]), other, now=NOW)
    assert other.snapshot_ids() == [1]


def test_bad_days_cost_one_extra_scan(spark, lake_root, raw, monkeypatch):
    days = [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(365)]
    rows = _fares(spark, (1, "BLR", days[3]), (2, "", days[50]), (3, None, days[51]), (4, "BLR", days[360]))
    copies = []
    copy = hop._copy_chunk
    monkeypatch.setattr(hop, "_copy_chunk", lambda *a: (copies.append(len(a[4])), copy(*a))[1])
    report = backfill(spark, FrameSource(rows, TRIP_EVENTS), raw, lake_root, days, now=NOW)
    assert copies == [365, 363]
    assert [(r.event_date, "1 row(s) with an empty" in r.error) for r in report.failed] == [(days[50], True), (days[51], True)]
    assert len(report.results) == 365 and ids(raw.read()) == [1, 4]


def test_a_source_that_is_down_stops_at_once(spark, lake_root, raw, monkeypatch):
    asked = []

    class Down:
        keep_added = False

        def rows(self, first, last):
            asked.append((first, last))
            raise ConnectionError("no route to the source")

        totals = None

    days = [D15 + dt.timedelta(days=i) for i in range(20)]
    report = export_days(spark, Down(), raw, lake_root, days, now=NOW)
    assert len(asked) == 2 and len(report.failed) == 20
    assert {r.error for r in report.failed} == {"no route to the source"}


def test_partitions_come_from_the_listing(spark, raw):
    raw.create(NOW).replace_days(_fares(spark, (1, "BLR", D15), (2, "BLR", D16)), [D15, D16], now=NOW)
    raw.drop_days([D16], now=NOW)
    for file in raw.read().inputFiles():
        Storage(spark).write_text(file, "no Parquet at all")
    assert [r.event_date for r in partitions.stored_days(raw).collect()] == [D15]
