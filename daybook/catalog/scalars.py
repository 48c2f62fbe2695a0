"""Scalar helpers, each over a whole table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from daybook.catalog.registry import query, trips
from daybook.functions.days import date_spine, days_since_epoch, partition_date, partition_name
from daybook.functions.values import null_if_empty, run_seconds, without_hyphens, without_trailing_slash
from daybook.sources.given import given, view


@query(
    "partition_name",
    "SELECT trip_id, concat('trip_events_y', strftime(event_date, '%Y_m%m_d%d')) AS name FROM trip_events",
    "trip_events",
)
def name_of_day(spark, sf):
    return trips(spark, sf).select("trip_id", partition_name(F.col("event_date")).alias("name"))


@query(
    "parse_partition_date",
    r"""SELECT name, CASE WHEN regexp_full_match(name, 'trip_events_y\d{4}_m\d{2}_d\d{2}') THEN
      try_cast(concat(substr(name, 14, 4), '-', substr(name, 20, 2), '-', substr(name, 24, 2)) AS date) END AS event_date
    FROM partition_names""",
    "partition_names",
)
def day_of_name(spark, sf):
    names = view(spark, sf, "partition_names")
    return names.select("name", partition_date(F.col("name")).alias("event_date"))


@query(
    "date_spine",
    """SELECT cast(unnest(generate_series((SELECT min(event_date) FROM trip_events),
      (SELECT max(event_date) FROM trip_events), INTERVAL 1 DAY)) AS date) AS event_date""",
    "trip_events",
)
def spine(spark, sf):
    first, last = trips(spark, sf).agg(F.min("event_date"), F.max("event_date")).first()
    return date_spine(spark, first, last)


@query(
    "date_shift",
    """SELECT trip_id, event_date - 90 AS cutoff, event_date + 1 AS next_day, event_date - 1 AS yesterday
    FROM trip_events""",
    "trip_events",
)
def shift(spark, sf):
    day = F.col("event_date")
    return trips(spark, sf).select(
        "trip_id",
        F.date_sub(day, 90).alias("cutoff"),
        F.date_add(day, 1).alias("next_day"),
        F.date_sub(day, 1).alias("yesterday"),
    )


@query(
    "parse_day",
    "SELECT trip_id, cast(strftime(event_date, '%Y-%m-%d') AS date) AS event_date FROM trip_events",
    "trip_events",
)
def parsed_day(spark, sf):
    text = F.date_format("event_date", "yyyy-MM-dd")
    return trips(spark, sf).select("trip_id", F.to_date(text, "yyyy-MM-dd").alias("event_date"))


@query(
    "days_since_epoch",
    "SELECT trip_id, cast(event_date - DATE '1970-01-01' AS integer) AS epoch_day FROM trip_events",
    "trip_events",
)
def epoch_day(spark, sf):
    return trips(spark, sf).select("trip_id", days_since_epoch(F.col("event_date")).alias("epoch_day"))


@query(
    "strip_hyphens",
    "SELECT o_orderkey, replace(concat(o_orderpriority, '-', cast(o_orderkey AS varchar)), '-', '') AS run_token FROM orders",
)
def strip_hyphens(spark, sf):
    orders = given(spark, sf, "orders")
    run_id = F.concat(F.col("o_orderpriority"), F.lit("-"), F.col("o_orderkey").cast("string"))
    return orders.select("o_orderkey", without_hyphens(run_id).alias("run_token"))


@query(
    "trim_trailing_slash",
    "SELECT cache_id, regexp_replace(concat(provider, '//'), '/$', '') AS prefix FROM reference_feed_cache",
    "reference_feed_cache",
)
def trim_slash(spark, sf):
    cached = view(spark, sf, "reference_feed_cache")
    return cached.select(
        "cache_id", without_trailing_slash(F.concat("provider", F.lit("//"))).alias("prefix")
    )


@query(
    "parse_duration",
    r"""SELECT ts, message, cast(cast(nullif(regexp_extract(message, 'duration=([0-9.]+)s', 1), '')
      AS decimal(18,4)) AS double) AS seconds FROM run_log""",
    "run_log",
)
def parse_duration(spark, sf):
    return view(spark, sf, "run_log").withColumn("seconds", run_seconds(F.col("message")).cast("double"))


@query(
    "bin_to_day",
    "SELECT trip_id, cast(date_trunc('day', created_at) AS date) AS day FROM trip_events",
    "trip_events",
)
def bin_to_day(spark, sf):
    return trips(spark, sf).select("trip_id", F.to_date(F.date_trunc("day", "created_at")).alias("day"))


@query(
    "coalesce_empty_sum",
    "SELECT cast(coalesce(sum(trip_id), 0) AS bigint) AS checksum FROM trip_events WHERE event_date > DATE '2999-01-01'",
    "trip_events",
)
def empty_sum(spark, sf):
    future = trips(spark, sf).filter(F.col("event_date") > F.lit(dt.date(2999, 1, 1)))
    return future.agg(F.coalesce(F.sum("trip_id"), F.lit(0).cast("bigint")).alias("checksum"))


@query(
    "json_omit_empty",
    """SELECT request_ref, concat('{"identifier":"', replace(identifier, chr(10), '\\n'), '"',
      CASE WHEN jurisdiction = '' THEN '' ELSE concat(',"jurisdiction":"', jurisdiction, '"') END, '}') AS body
    FROM erasure_requests""",
    "erasure_requests",
)
def json_omit_empty(spark, sf):
    requests = view(spark, sf, "erasure_requests")
    record = F.struct("identifier", null_if_empty(F.col("jurisdiction")).alias("jurisdiction"))
    return requests.select("request_ref", F.to_json(record).alias("body"))


@query(
    "json_read_back",
    "SELECT trip_id, vehicle_id_hash, event_date FROM trip_events",
    "trip_events",
)
def json_read_back(spark, sf):
    body = F.to_json(F.struct("trip_id", "vehicle_id_hash", "event_date"))
    parsed = F.from_json(body, "trip_id BIGINT, vehicle_id_hash STRING, event_date DATE")
    return trips(spark, sf).select(parsed.alias("r")).select("r.*")
