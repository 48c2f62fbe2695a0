import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.functions.days import parse_day, partition_date, partition_name, run_days, yesterday_utc
from daybook.operators import changes, reports
from daybook.operators.erasure import screen
from daybook.plans import workload
from daybook.schemas import TRIP_EVENTS
from daybook.sources.events import JdbcSource, ParquetSource
from daybook.sources.operations import scan_run_log
from tests.fixture import D15, D16, TRIPS, ids, trips

REQUESTS = [
    ("hash_veh_000067", "REQ-2026-0001", "", None),
    ("c51e9a0a77", "req.2026_09.25", "IN", None),
    ("a" * 128, "abc", "", None),
    ("", "REQ-1", "", "both required"),
    ("hash_veh_1", "", "", "both required"),
    (None, "REQ-1", None, "both required"),
    ("x' OR '1'='1", "REQ-1", "", "identifier"),
    ("hash veh", "REQ-1", "", "identifier"),
    ("hash-veh", "REQ-1", "", "identifier"),
    ("a" * 129, "REQ-1", "", "identifier"),
    ("hash_veh_1", "../../raw/x", "", "request_ref"),
    ("hash_veh_1", "ab", "", "request_ref"),
    ("hash_veh_1", "r" * 65, "", "request_ref"),
    ("hash_veh_1", "REQ/1", "", "request_ref"),
    ("hash_veh_1", "REQ-1", "in", "jurisdiction"),
    ("hash_veh_1", "REQ-1", "IND", "jurisdiction"),
    ("hash_veh_1\n", "REQ-1", "", "identifier"),
    ("hash_veh_1", "REQ-1\n", "", "request_ref"),
    ("hash_veh_1", "REQ-1", "IN\n", "jurisdiction"),
]


def test_screening(spark):
    numbered = [(i, *r[:3]) for i, r in enumerate(REQUESTS)]
    rows = spark.createDataFrame(numbered, "i INT, identifier STRING, request_ref STRING, jurisdiction STRING")
    got = {r.i: (r.accepted, r.reason) for r in screen(rows).collect()}
    assert got == {i: (r[3] is None, r[3]) for i, r in enumerate(REQUESTS)}


def test_run_days():
    assert run_days(day="2026-01-15") == [D15]
    assert run_days(start="2026-01-15", end="2026-01-16") == [D15, D16]
    assert run_days(start="2026-01-15", end="2026-01-15") == [D15]
    late = dt.datetime(2026, 1, 17, 1, 0, tzinfo=dt.timezone(dt.timedelta(hours=5, minutes=30)))
    assert run_days(now=late) == [D15]
    assert yesterday_utc(dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)) == dt.date(2026, 2, 28)


@pytest.mark.parametrize(
    "options",
    [
        {"start": "2026-01-15"},
        {"end": "2026-01-15"},
        {"day": "2026-01-15", "start": "2026-01-15", "end": "2026-01-16"},
        {"start": "2026-01-16", "end": "2026-01-15"},
        {"day": "2026-1-15"},
        {"day": "15-01-2026"},
        {"day": "2026-02-30"},
    ],
)
def test_bad_run_days(options):
    with pytest.raises(ValueError):
        run_days(**options)


def test_parse_day_is_strict():
    assert parse_day("2024-02-29") == dt.date(2024, 2, 29)


def test_partition_names(spark):
    names = {
        "trip_events_y2026_m01_d15": D15,
        "trip_events_default": None,
        "trip_events_y2026_m02_d30": None,
        "trip_events_y2026_m13_d01": None,
        "trip_events_y2026_m1_d15": None,
        "trip_events_y2026_m01_d15\n": None,
        "x_trip_events_y2026_m01_d15": None,
        "trip_events_y2026_m01_d15_old": None,
    }
    rows = spark.createDataFrame([(n,) for n in names], "name STRING")
    assert {r[0]: r[1] for r in rows.select("name", partition_date(F.col("name"))).collect()} == names
    assert trips(spark).select(partition_name(F.col("event_date"))).first()[0] == "trip_events_y2026_m01_d15"


def test_latest_per_key_with_a_hot_key(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )
    out = changes.latest_per_key(rows, ["k"], "v")
    assert out.count() == rows.select("k").distinct().count()
    assert out.filter("k = 7").first().v == 99_999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max(" in plan and "Window" not in plan


def test_new_rows_ignores_conflicts_and_repeats(spark):
    incoming = trips(spark, TRIPS + TRIPS[3:])
    out = changes.new_rows(incoming, trips(spark, TRIPS[:4]), ["trip_id", "event_date"])
    assert ids(out) == [5, 6]
    assert out.columns == TRIP_EVENTS.columns


def test_pairs_are_counted_without_being_formed(spark):
    """A vehicle with a third of all rows on both sides, against brute force."""
    cities = ["BLR", "MUM"]
    t = [(i, "hot" if i % 3 == 0 else f"v{i % 50}", cities[i % 2], D15) for i in range(600)]
    c = [("hot" if i % 3 == 0 else f"v{i % 40}", cities[i % 2]) for i in range(500)]
    c += [(None, "BLR")]
    left = spark.createDataFrame(
        [*t, (1000, None, "BLR", D15)], "trip_id INT, vehicle_id_hash STRING, city_code STRING, event_date DATE"
    )
    right = spark.createDataFrame(c, "vehicle_id_hash STRING, city_code STRING")
    out = {r.city_code: (r.trips, r.vehicles) for r in workload.trips_with_cameras(left, right, D15).collect()}
    for city in cities:
        pairs = [(a[1]) for a in t for b in c if a[2] == city and b == (a[1], city)]
        assert out[city] == (len(pairs), len(set(pairs)))


def test_ledger_against_brute_force(spark):
    ledger = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("account_id"),
        F.when(F.col("id") % 2 == 0, "reward").otherwise("penalty").alias("ledger_type"),
        (F.col("id") - 1500).cast("decimal(10,2)").alias("amount"),
    )
    accounts = spark.range(90).select(F.col("id").alias("account_id"), (F.col("id") % 4).cast("string").alias("city_code"))
    got = {tuple(r) for r in workload.ledger_by_city(ledger, accounts).collect()}
    want: dict = {}
    for i in range(3000):
        account = 5 if i % 3 == 0 else i % 100
        if account < 90:
            n, total = want.get((str(account % 4), "reward" if i % 2 == 0 else "penalty"), (0, 0))
            want[str(account % 4), "reward" if i % 2 == 0 else "penalty"] = (n + 1, total + i - 1500)
    assert {(a, b, n, int(s)) for a, b, n, s in got} == {(*k, *v) for k, v in want.items()}


def test_recent_runs_rank_before_the_shuffle(spark):
    runs = spark.range(5000).select(
        F.concat(F.when(F.col("id") % 3 == 0, "export").otherwise("trim"), F.lit("/main/"), F.col("id")).alias("name"),
        F.timestamp_seconds("id").alias("last_event"),
    )
    out = reports.recent_runs(runs)
    assert out.count() == 10
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_run_log_lines(spark, lake_root):
    lines = [
        "2026-01-15T02:00:11.5 run a succeeded: 76 row(s), checksum=177962, duration=11.01s",
        "2026-01-15T03:00:00 run b succeeded: 0 row(s), checksum=0, duration=9.93s",
        "2026-01-16T02:00:00 run c failed",
        "2026-01-16T02:00:01 run d odd duration=1.2.3s",
    ]
    spark.createDataFrame([(x,) for x in lines], "value STRING").write.text(f"{lake_root}/log")
    log = scan_run_log(spark, f"{lake_root}/log")
    assert log.filter("ts IS NULL").count() == 0
    out = [(r.day, round(r.total_seconds, 2), r.run_count) for r in reports.seconds_by_day(log).collect()]
    assert out == [(D15, 20.94, 2)]


def test_declared_columns_win_over_the_source(spark):
    rows = trips(spark).drop("fare_amount").withColumn("surge", F.lit(2)).withColumn("trip_id", F.col("trip_id").cast("int"))
    out = changes.conform(rows, TRIP_EVENTS.schema)
    assert out.schema == TRIP_EVENTS.schema or out.columns == TRIP_EVENTS.columns
    assert out.filter("fare_amount IS NULL").count() == 6


def test_parquet_source_pushes_the_day_down(spark, lake_root):
    trips(spark).write.parquet(f"{lake_root}/source")
    rows = ParquetSource(spark, f"{lake_root}/source", TRIP_EVENTS).rows(D15, D15)
    assert ids(rows) == [1, 2, 3, 4, 5]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_date" in plan


def test_jdbc_read_is_split_by_key(spark):
    source = JdbcSource(spark, "jdbc:postgresql://db/app", "trip_events", TRIP_EVENTS, partitions=4,
                        properties={"user": "reader"})
    assert source.bounds_query(D15, D16) == (
        "SELECT MIN(trip_id) AS lo, MAX(trip_id) AS hi FROM trip_events "
        "WHERE event_date BETWEEN DATE '2026-01-15' AND DATE '2026-01-16'"
    )
    assert "SUM(trip_id) AS checksum" in source.totals_query(D15, D16)
    assert source.totals_query(D15, D16).endswith("GROUP BY event_date")
    options = source.range_options(10, 20)
    assert options["partitionColumn"] == "trip_id" and options["fetchsize"] == "1000"
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("10", "21", "4")
    assert options["user"] == "reader"


def test_table_inventory_of_a_table_without_days(spark):
    from daybook.schemas import ACCOUNT_SNAPSHOTS

    accounts = spark.createDataFrame([(1,), (2,)], "account_id BIGINT")
    (row,) = reports.table_inventory([reports.Inventoried(ACCOUNT_SNAPSHOTS, accounts, 10)]).collect()
    assert (row.row_count, row.days, row.rows_per_day, row.size_bytes) == (2, None, None, 10)
    assert row.partition_column is None
