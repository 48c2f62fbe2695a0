"""The analytical workload: four aggregates and joins, two lookups, the daily consumer query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.values import exact_mean, exact_sum


def trips_with_cameras(trips: DataFrame, cameras: DataFrame, since: dt.date) -> DataFrame:
    """Per city: pairs of a trip and a camera sighting of the same vehicle there, and vehicles seen.

    Both sides are reduced to one row per vehicle and city first, so the pairs are counted without
    being formed and a vehicle with very many rows is one row in the join. Each joined row is then a
    different vehicle of its city, so counting rows counts vehicles.
    """
    key = ["vehicle_id_hash", "city_code"]
    left = trips.filter(F.col("event_date") >= F.lit(since)).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    right = cameras.groupBy(*key).agg(F.count(F.lit(1)).alias("m"))
    return (
        left.join(right, key)
        .groupBy("city_code")
        .agg(F.sum(F.col("n") * F.col("m")).alias("trips"), F.count(F.lit(1)).alias("vehicles"))
        .orderBy("city_code")
    )


def zone_occupancy(hours: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Mean occupancy per zone over the seven days up to ``as_of``."""
    start = F.lit(as_of - dt.timedelta(days=7)).cast("timestamp_ntz")
    return (
        hours.filter(F.col("hour_ts") >= start)
        .groupBy("city_code", "zone_id")
        .agg(exact_mean(F.col("occupancy_pct")).alias("avg_occupancy"))
        .orderBy("city_code", "zone_id")
    )


def city_since(trips: DataFrame, since: dt.date) -> DataFrame:
    """Trips, mean fare and total distance per city since a day."""
    return (
        trips.filter(F.col("event_date") >= F.lit(since))
        .groupBy("city_code")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            exact_mean(F.col("fare_amount")).alias("avg_fare"),
            exact_sum(F.col("distance_km")).alias("total_km"),
        )
        .orderBy("city_code")
    )


def ledger_by_city(ledger: DataFrame, accounts: DataFrame) -> DataFrame:
    """Entries and amounts per the account's city and ledger type.

    Entries are first summed per account, so an account with very many is one row in the join.
    """
    cities = accounts.select("account_id", F.col("city_code").alias("account_city"))
    entries = ledger.groupBy("account_id", "ledger_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount")
    )
    return (
        entries.join(cities, "account_id")
        .groupBy(F.col("account_city").alias("city_code"), "ledger_type")
        .agg(F.sum("n").alias("entries"), F.sum("amount").cast("decimal(20,2)").alias("amount"))
        .orderBy("city_code", "ledger_type")
    )


def city_day(curated: DataFrame, day: dt.date) -> DataFrame:
    """Trips and mean fare per city for one day."""
    return (
        curated.filter(F.col("event_date") == F.lit(day))
        .groupBy("city_code")
        .agg(F.count(F.lit(1)).alias("trips"), exact_mean(F.col("fare_amount")).alias("avg_fare"))
        .orderBy("city_code")
    )


def lookup(rows: DataFrame, key: str, value: int) -> DataFrame:
    return rows.filter(F.col(key) == F.lit(value))


def distinct_vehicles(trips: DataFrame) -> DataFrame:
    return trips.agg(F.count_distinct("vehicle_id_hash").alias("vehicles"))
