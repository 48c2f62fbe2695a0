"""The six-row trip fixture."""

import datetime as dt

from daybook.schemas import TRIP_EVENTS

D15, D16 = dt.date(2026, 1, 15), dt.date(2026, 1, 16)
NOW = dt.datetime(2026, 1, 17, 2, 0, tzinfo=dt.timezone.utc)

TRIPS = [
    (1, "hash_veh_aaa111", "CITY_ZZ", D15, 4.2, 120.50, dt.datetime(2026, 1, 15, 8, 12)),
    (2, "hash_veh_bbb222", "CITY_ZZ", D15, 12.8, 340.00, dt.datetime(2026, 1, 15, 9, 45)),
    (3, "hash_veh_ccc333", "CITY_ZZ", D15, 2.1, 60.00, dt.datetime(2026, 1, 15, 10, 3)),
    (4, "hash_veh_aaa111", "CITY_ZZ", D15, 7.5, 210.25, dt.datetime(2026, 1, 15, 14, 22)),
    (5, "hash_veh_ddd444", "CITY_ZZ", D15, 18.3, 480.75, dt.datetime(2026, 1, 15, 19, 50)),
    (6, "hash_veh_eee555", "CITY_ZZ", D16, 5.0, 150.00, dt.datetime(2026, 1, 16, 7, 0)),
]


def trips(spark, rows=TRIPS):
    return spark.createDataFrame(rows, TRIP_EVENTS.schema)


def ids(frame, column="trip_id"):
    return sorted(r[0] for r in frame.select(column).collect())
