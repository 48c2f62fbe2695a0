import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.schemas import TRIP_EVENTS
from daybook.tables.daytable import BadBatch, DayTable, SnapshotNotFound
from tests.fixture import D15, D16, NOW, TRIPS, ids, trips


@pytest.fixture
def raw(spark, lake_root):
    return DayTable(spark, f"{lake_root}/raw/trip_events", TRIP_EVENTS).create(NOW)


@pytest.fixture
def full(spark, raw):
    raw.replace_days(trips(spark), [D15, D16], now=NOW)
    return raw


def test_empty_table_has_the_declared_columns(raw):
    assert raw.read().columns == TRIP_EVENTS.columns
    assert raw.read().count() == 0
    assert raw.read().schema == TRIP_EVENTS.schema


def test_rows_come_back_unchanged(spark, full):
    assert sorted(map(tuple, full.read().collect())) == sorted(TRIPS)
    assert full.read().schema == TRIP_EVENTS.schema


def test_replace_twice_is_replace_once(spark, full):
    commit = full.replace_days(trips(spark).filter(F.col("event_date") == F.lit(D15)), [D15], now=NOW)
    assert (commit.rows, commit.checksum) == (5, 15)
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6]


def test_replace_leaves_no_stale_partition(spark, full):
    moved = [(*t[:2], "BLR" if t[0] < 3 else "DEL", *t[3:]) for t in TRIPS if t[3] == D15]
    full.replace_days(trips(spark, moved), [D15], now=NOW)
    full.replace_days(trips(spark, moved[:2]), [D15], now=NOW)
    assert ids(full.read()) == [1, 2, 6]


def test_replace_with_nothing_empties_the_day(spark, full):
    full.replace_days(trips(spark, []), [D15], now=NOW)
    assert ids(full.read()) == [6]
    assert D15 in full.days()


def test_rows_outside_the_batch_are_refused_and_invisible(spark, full):
    with pytest.raises(BadBatch):
        full.replace_days(trips(spark), [D15], now=NOW)
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6]
    assert full.snapshot_ids() == [1, 2]


@pytest.mark.parametrize("city", ["", None])
def test_unusable_partition_values_are_refused(spark, raw, city):
    with pytest.raises(BadBatch):
        raw.replace_days(trips(spark, [(*TRIPS[0][:2], city, *TRIPS[0][3:])]), [D15], now=NOW)


def test_awkward_partition_values_survive(spark, raw):
    cities = ["A B", "50%", "a/b=c", "été", "x+y", "{q}", "a*b?"]
    rows = [(i, f"v{i % 2}", c, D15, 1.0, 2.0, TRIPS[0][6]) for i, c in enumerate(cities)]
    raw.replace_days(trips(spark, rows), [D15], now=NOW)
    assert {r.city_code for r in raw.read().collect()} == set(cities)
    raw.delete_keys(spark.createDataFrame([("v1",)], "vehicle_id_hash STRING"), "vehicle_id_hash", now=NOW)
    raw.forget_history()
    assert {r.city_code for r in raw.read().collect()} == set(cities[::2])


def test_reading_prunes_by_day(full):
    assert ids(full.read(days=[D16])) == [6]
    assert ids(full.read_between(D15, D15)) == [1, 2, 3, 4, 5]
    assert len(full.read(days=[D16]).inputFiles()) == 1


def test_versions(spark, full):
    full.drop_days([D15], now=NOW)
    assert ids(full.read(version=2)) == [1, 2, 3, 4, 5, 6]
    assert ids(full.read(version=1)) == []
    assert ids(full.read()) == [6]
    with pytest.raises(SnapshotNotFound):
        full.read(version=99)


def test_publishing_a_taken_snapshot_fails(spark, full):
    stale = full.snapshot(1)
    with pytest.raises(Exception, match="already exists"):
        full._publish(stale, (), (), "late", NOW)
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6]


def _key(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "vehicle_id_hash STRING")


def test_delete_keys(spark, full):
    full.delete_keys(_key(spark, "hash_veh_aaa111"), "vehicle_id_hash", now=NOW)
    assert ids(full.read()) == [2, 3, 5, 6]


def test_deleting_nothing_makes_no_snapshot(spark, full):
    assert full.delete_keys(_key(spark, "nobody"), "vehicle_id_hash", now=NOW) is None
    assert full.snapshot_ids() == [1, 2]


def test_delete_twice_is_delete_once(spark, full):
    full.delete_keys(_key(spark, "hash_veh_aaa111"), "vehicle_id_hash", now=NOW)
    assert full.delete_keys(_key(spark, "hash_veh_aaa111"), "vehicle_id_hash", now=NOW) is None


def test_delete_that_empties_a_day(spark, full):
    full.delete_keys(_key(spark, "hash_veh_eee555"), "vehicle_id_hash", now=NOW)
    assert ids(full.read()) == [1, 2, 3, 4, 5]
    assert not [e for e in full.snapshot().live if e.day == D16]


def test_rows_without_identifier_survive_a_delete(spark, raw):
    rows = [TRIPS[0], (7, None, *TRIPS[0][2:])]
    raw.replace_days(trips(spark, rows), [D15], now=NOW)
    raw.delete_keys(_key(spark, "hash_veh_aaa111"), "vehicle_id_hash", now=NOW)
    assert ids(raw.read()) == [7]


@pytest.fixture
def spread(spark, raw):
    """Ten cities, so ten files in a day."""
    rows = [(i, f"v{i % 20}", f"C{i % 10}", D15, 1.0, 1.0, TRIPS[0][6]) for i in range(200)]
    raw.replace_days(trips(spark, rows), [D15], now=NOW)
    return raw


@pytest.mark.parametrize("gone", [["v3"], ["v3", "v13", "v7"], [f"v{i}" for i in range(0, 20, 2)]])
def test_delete_against_brute_force(spark, spread, gone):
    want = [i for i in range(200) if f"v{i % 20}" not in gone]
    spread.delete_keys(_key(spark, *gone), "vehicle_id_hash", now=NOW)
    assert ids(spread.read()) == want
    assert ids(spread.read(version=2)) == list(range(200))
    spread.forget_history()
    assert ids(spread.read()) == want


def test_delete_rewrites_only_the_files_it_hits(spark, spread):
    before = set(spread.read().inputFiles())
    spread.delete_keys(_key(spark, "v3"), "vehicle_id_hash", now=NOW)
    after = set(spread.read().inputFiles())
    assert len(before & after) == len(before) - 1
    spread.delete_keys(_key(spark, "v4"), "vehicle_id_hash", now=NOW)
    assert len(before & set(spread.read().inputFiles())) == len(before) - 2
    assert spread.forget_history()[1] == 2
    assert ids(spread.read()) == [i for i in range(200) if i % 20 not in (3, 4)]


def test_expire_keeps_the_newest_and_the_young(spark, full):
    full.drop_days([D16], now=NOW + dt.timedelta(days=1))
    full.replace_days(trips(spark, TRIPS[5:]), [D16], now=NOW + dt.timedelta(days=2))
    assert full.expire(keep=1, max_age=dt.timedelta(days=10), now=NOW + dt.timedelta(days=3)) == []
    assert full.expire(keep=3, now=NOW + dt.timedelta(days=3)) == [1]
    assert full.expire(keep=0, now=NOW + dt.timedelta(days=3)) == [2, 3]
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6]


def test_orphans_never_touch_the_live_read(spark, full):
    full.stage(trips(spark), [D15, D16])
    full.drop_days([D16], now=NOW)
    assert full.orphan_files().count() == 2
    full.expire(keep=1)
    assert full.orphan_files().count() == 3
    assert full.remove_orphans() == 1  # the dropped day; the young batch may be in flight
    assert full.orphan_files().count() == 2
    assert full.remove_orphans(min_age=dt.timedelta(0)) > 0
    assert full.orphan_files().count() == 0
    assert ids(full.read()) == [1, 2, 3, 4, 5]
    assert full.files().count() == 1


def test_hygiene_leaves_a_batch_in_flight_alone(spark, full):
    staged = full.stage(trips(spark, TRIPS[:2]), [D15])
    full.replace_days(trips(spark, TRIPS[5:]), [D16], now=NOW)
    expired, removed = full.forget_history(NOW + dt.timedelta(days=30))
    assert len(expired) == 2 and removed == 1  # the replaced day goes, the staged batch stays
    full.publish(staged, [D15], "replace", NOW)
    assert ids(full.read()) == [1, 2, 6]


def test_a_batch_whose_files_are_gone_cannot_be_published(spark, full):
    staged = full.stage(trips(spark, TRIPS[:2]), [D15])
    full.remove_orphans(min_age=dt.timedelta(0))
    with pytest.raises(BadBatch, match="are gone"):
        full.publish(staged, [D15], "replace", NOW)
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6]


def test_append_adds_to_a_day(spark, full):
    full.append(trips(spark, [(9, *TRIPS[0][1:])]), [D15], now=NOW)
    assert ids(full.read()) == [1, 2, 3, 4, 5, 6, 9]


def test_empty_partitions_can_be_added_and_dropped(full):
    new = dt.date(2026, 1, 20)
    assert full.add_days([new, D15], NOW) == 3
    assert full.add_days([new], NOW) is None
    assert new in full.days()
    assert full.drop_days([new], now=NOW) == 4
    assert full.drop_days([new], now=NOW) is None


def test_hot_day_is_split_over_several_files(spark, raw):
    """A day and city with nearly all rows is written by more than one task."""
    rows = spark.range(400_000).select(
        F.col("id").alias("trip_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("vehicle_id_hash"),
        F.lit("BLR").alias("city_code"),
        F.lit(D15).alias("event_date"),
        F.rand(1).alias("distance_km"),
        F.rand(2).alias("fare_amount"),
        F.lit(dt.datetime(2026, 1, 15)).cast("timestamp_ntz").alias("created_at"),
    ).repartition(8)
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        raw.replace_days(rows, [D15], now=NOW)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(raw.read().inputFiles()) > 1
    assert raw.read().count() == 400_000
