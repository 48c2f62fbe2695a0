"""Small scalar and aggregate expressions shared by the reports and jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_sum(value: Column) -> Column:
    """Sum of doubles that does not depend on the order in which tasks finish."""
    return F.sum(value.cast("decimal(18,4)")).cast("double")


def exact_mean(value: Column) -> Column:
    """Mean of the non-null doubles, order-independent like ``exact_sum``."""
    return exact_sum(value) / F.count(value)


def key_sum(key: Column) -> Column:
    """Checksum of a set of integer keys; zero for the empty set."""
    return F.coalesce(F.sum(key), F.lit(0).cast("bigint"))


def run_seconds(line: Column) -> Column:
    """Seconds in ``duration=11.01s`` of a log line, NULL where the line has none."""
    digits = F.regexp_extract(line, r"duration=([0-9.]+)s", 1)
    return F.when(digits != "", digits.try_cast("decimal(18,4)"))


def without_trailing_slash(prefix: Column) -> Column:
    return F.regexp_replace(prefix, r"/\z", "")


def without_hyphens(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(""))


def null_if_empty(text: Column) -> Column:
    """JSON writing omits nulls, so an empty field becomes an absent one."""
    return F.when(text != "", text)
