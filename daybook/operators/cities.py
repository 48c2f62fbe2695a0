"""Which jurisdiction a city belonged to on a day: a dimension of cities with validity dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# valid_from is the first day, valid_to the first day after; null is open.
CITIES_SCHEMA = "city_code STRING, jurisdiction STRING, valid_from DATE, valid_to DATE"

COLUMN = "jurisdiction"


def overlapping(cities: DataFrame) -> DataFrame:
    """Cities with two periods that share a day, where a row would have two jurisdictions; empty periods count as none."""
    periods = cities.select(
        "city_code",
        F.coalesce("valid_from", F.lit("0001-01-01").cast("date")).alias("first"),
        F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("stop"),
    ).filter("first < stop")
    # A city has a handful of periods.
    following = F.lead("first").over(W.partitionBy("city_code").orderBy("first", "stop"))
    return periods.withColumn("following", following).filter("following < stop").select("city_code").distinct()


def checked(cities: DataFrame) -> DataFrame:
    """The dimension, if no day of a city has two jurisdictions."""
    twice = [r.city_code for r in overlapping(cities).orderBy("city_code").limit(5).collect()]
    if twice:
        raise ValueError(f"periods of a city overlap: {', '.join(map(str, twice))}")
    return cities


def as_of(rows: DataFrame, cities: DataFrame, day: str = "event_date") -> DataFrame:
    """The rows with the jurisdiction of their city on their day; null for a city, or a day, that is not covered.

    A stored jurisdiction is replaced. Periods do not overlap, so rows neither multiply nor disappear.
    """
    rows = rows.drop(COLUMN)
    r, c = rows.alias("r"), cities.select("city_code", COLUMN, "valid_from", "valid_to").alias("c")
    on = F.col(f"r.{day}")
    valid = (
        (F.col("r.city_code") == F.col("c.city_code"))
        & (F.col("c.valid_from").isNull() | (F.col("c.valid_from") <= on))
        & (F.col("c.valid_to").isNull() | (on < F.col("c.valid_to")))
    )
    return r.join(c, valid, "left").select("r.*", F.col(f"c.{COLUMN}"))
