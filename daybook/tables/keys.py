"""Rows whose key is, or is not, in a list of keys. One plan at any size; Spark picks the join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _distinct(keys: DataFrame, column: str) -> DataFrame:
    return keys.select(column).where(F.col(column).isNotNull()).distinct()


def matching(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is one of ``keys``."""
    return rows.join(_distinct(keys, column), column, "left_semi").select(*rows.columns)


def without(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is none of ``keys``; rows without a value stay."""
    return rows.join(_distinct(keys, column), column, "left_anti").select(*rows.columns)
