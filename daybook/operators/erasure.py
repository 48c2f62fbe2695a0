"""Erasure requests: which are well formed, and what they match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.tables.keys import matching

# What identifiers, request references and jurisdictions may look like.
# They end in \z because $ would let a trailing newline through.
IDENTIFIER_PATTERN = r"^[A-Za-z0-9_]{1,128}\z"
REQUEST_REF_PATTERN = r"^[A-Za-z0-9._-]{3,64}\z"
JURISDICTION_PATTERN = r"^[A-Z]{2}\z"


def screen(requests: DataFrame) -> DataFrame:
    """Adds ``accepted`` and the first rule a request breaks as ``reason``."""
    text = {c: F.coalesce(F.col(c), F.lit("")) for c in ("identifier", "request_ref", "jurisdiction")}
    reason = (
        F.when((text["identifier"] == "") | (text["request_ref"] == ""), "both required")
        .when(~text["identifier"].rlike(IDENTIFIER_PATTERN), "identifier")
        .when(~text["request_ref"].rlike(REQUEST_REF_PATTERN), "request_ref")
        .when((text["jurisdiction"] != "") & ~text["jurisdiction"].rlike(JURISDICTION_PATTERN), "jurisdiction")
    )
    return requests.withColumn("reason", reason).withColumn("accepted", F.col("reason").isNull())


def count_by_identifier(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows per requested identifier; those without rows are absent."""
    return matching(rows.select(column), keys, column).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def all_succeeded(results: DataFrame) -> DataFrame:
    """Per request, whether every table came through."""
    return results.groupBy("request_ref").agg(F.bool_and("success").alias("success"))
