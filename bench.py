"""Headline timings: ``BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daybook.catalog import QUERIES  # noqa: E402
from daybook.catalog.registry import DAY, NOW, TODAY, SampleLake, day_range, frequent_vehicle, trips  # noqa: E402
from daybook.plans.erase import Target, erase  # noqa: E402
from daybook.plans.jobs import backfill, compact, curate_days, export_days, migrate, trim  # noqa: E402
from daybook.plans.workload import city_day, city_since  # noqa: E402
from daybook.schemas import TRIP_EVENTS  # noqa: E402
from daybook.session import build_session  # noqa: E402
from daybook.sources.events import FrameSource  # noqa: E402
from daybook.tables.daytable import DayTable  # noqa: E402

# Answered straight from the given tables.
DIRECT = (
    "q1_trips_with_cameras", "q2_zone_occupancy_7d", "q3_city_since", "q4_ledger_by_city_type", "lookup_trip",
    "lookup_account", "count_distinct_vehicles", "run_seconds_by_day", "monthly_cost_vs_budget",
    "recent_runs_per_job", "screen_erasure_requests", "retention_plan", "reconcile_dates",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "daybook-bench", f"local[{cpus}]", int(cpus),
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name: str, action):
        started = time.monotonic()
        result = action()
        timings[name] = round(time.monotonic() - started, 3)
        return result

    def drain(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    rows = trips(spark, folder)
    total = rows.count()  # also warms the session up
    days = day_range(rows)
    source = FrameSource(rows, TRIP_EVENTS)

    for name in DIRECT:
        # Once to compile, then the median of three.
        drain(QUERIES[name](spark, folder))
        seconds = []
        for _ in range(3):
            started = time.monotonic()
            drain(QUERIES[name](spark, folder))
            seconds.append(time.monotonic() - started)
        timings[name] = round(statistics.median(seconds), 3)

    timed("curated_dedup", lambda: drain(QUERIES["curated_dedup"](spark, folder)))
    lake = SampleLake(spark, "bench")
    timed("backfill", lambda: backfill(spark, source, lake.raw, lake.root, days, now=NOW).raise_if_failed())
    timed("export_day", lambda: export_days(spark, source, lake.raw, lake.root, [DAY], now=NOW).raise_if_failed())
    timed("curate", lambda: curate_days(spark, lake.raw, lake.curated, lake.root, days, now=NOW).raise_if_failed())
    timed("q7_city_day", lambda: drain(city_day(lake.curated.read(days=[DAY]), DAY)))
    timed("q3_on_curated", lambda: drain(city_since(lake.curated.read(), DAY)))

    vehicle = frequent_vehicle(rows).first()[0]
    request = spark.createDataFrame([(vehicle, "REQ-BENCH", "")], "identifier STRING, request_ref STRING, jurisdiction STRING")
    targets = [Target("raw", lake.raw), Target("curated", lake.curated)]
    erased = timed("erase_one", lambda: erase(spark, lake.root, request, targets, now=NOW).collect())
    assert all(r.success for r in erased), erased
    timed("compact", lambda: compact(spark, [lake.raw, lake.curated], lake.root, now=NOW))

    hot = DayTable(spark, f"{lake.root}/hot/trip_events", TRIP_EVENTS)
    timed("migrate", lambda: migrate(spark, rows, hot, now=NOW))
    timed("trim", lambda: trim(spark, hot, lake.root, TODAY, retention_days=15, now=NOW))

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(folder).name.removeprefix("sf"),
                "rows": total,
                "rows_per_second": {
                    name: round(total / timings[name]) for name in ("backfill", "curate", "migrate")
                },
                "erased_rows": sum(r.rows_before for r in erased),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
