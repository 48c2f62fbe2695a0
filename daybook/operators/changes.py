"""Row-level rules for copying: new keys only, latest version only, allowed rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.tables.keys import without

# Fixed value: the city code of synthetic test rows.
SYNTHETIC_CITY = "CITY_ZZ"


# The reductions are aggregates rather than windows: map tasks already keep one row per key, so a key with
# very many copies never gathers in one task. Only rows of repeated keys, found from the key columns alone,
# are reduced; keys are nearly unique, so the rest passes through without a sort.


def _repeated(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys with more than one row; only the key columns are read and shuffled."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select(*key)


def _reduced(rows: DataFrame, key: Sequence[str], pick: Column) -> DataFrame:
    """One row per key: ``pick`` (an aggregate of a row struct) among copies, single rows as they are."""
    repeated = _repeated(rows, key)
    unusable = F.lit(False)
    for c in key:
        unusable = unusable | F.col(c).isNull()
    # Null keys match no join, so they are always reduced.
    single = rows.filter(~unusable).join(repeated, list(key), "left_anti").select(*rows.columns)
    several = rows.filter(~unusable).join(repeated, list(key), "left_semi").unionByName(rows.filter(unusable))
    picked = several.groupBy(*key).agg(pick.alias("row")).select(*(F.col(f"row.{c}") for c in rows.columns))
    return single.unionByName(picked)


def one_per_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key, the smallest of its copies in column order."""
    return _reduced(rows, key, F.min(F.struct(*rows.columns)))


def latest_per_key(rows: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """The row with the newest ``version`` per key; ties go to the largest row."""
    others = [c for c in rows.columns if c != version]
    return _reduced(rows, key, F.max(F.struct(version, *others)))


def has_duplicates(rows: DataFrame, key: Sequence[str]) -> bool:
    """Whether a key repeats."""
    return not _repeated(rows, key).isEmpty()


def new_rows(incoming: DataFrame, existing: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows an insert that ignores conflicts would add; stored keys drop out before copies are compared."""
    fresh = incoming.join(existing.select(*key), list(key), "left_anti").select(*incoming.columns)
    return one_per_key(fresh, key)


def without_synthetic(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col("city_code").eqNullSafe(F.lit(SYNTHETIC_CITY)))


def without_erased(rows: DataFrame, register: DataFrame, column: str) -> DataFrame:
    """Rows whose identifier has no erasure on record."""
    return without(rows, register, column)


def conform(rows: DataFrame, schema, keep_added: bool = False) -> DataFrame:
    """Declared columns in order, cast to their types; absent ones are null, undeclared ones are dropped.

    With ``keep_added`` undeclared ones follow the declared ones as they are.
    """
    have, declared = set(rows.columns), {f.name.lower() for f in schema}
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ]
    if keep_added:
        columns += [F.col(f"`{c}`") for c in rows.columns if c.lower() not in declared]
    return rows.select(*columns)
