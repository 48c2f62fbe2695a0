"""Columns that a table has gained since it was declared: one small file each, named after the column.

``<root>/columns/<name>.json`` holds the column's type and the first snapshot that may have it. A file is published once
and never changed, so a column keeps its type for good; days written before it show nulls. Readers and writers take the
declared columns first, then the added ones by snapshot and name.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from daybook.tables.daytable import DayTable

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")
# Types in the order in which one holds all values of those before it.
_WIDENING = (("tinyint", "smallint", "int", "bigint"), ("float", "double"), ("int", "double"))


class ColumnConflict(ValueError):
    """A batch has a column whose type, or whose name, the table cannot take."""


@dataclass(frozen=True)
class Added:
    name: str
    type: str
    since: int


def added_columns(table: DayTable, version: int | None = None) -> list[Added]:
    """Columns gained, in the order in which readers show them; with ``version`` as of that snapshot."""
    found = []
    for entry in table.storage.list(f"{table.root}/columns"):
        if entry.name.endswith(".json") and not entry.name.startswith("."):
            raw = json.loads(table.storage.read_text(entry.path))
            found.append(Added(raw["name"], raw["type"], raw["since"]))
    return sorted((a for a in found if version is None or a.since <= version), key=lambda a: (a.since, a.name))


def evolved(table: DayTable, version: int | None = None) -> DayTable:
    """The same table with the columns it has gained; files without one read as null."""
    extra = [T.StructField(a.name, T.StructType.fromDDL(f"c {a.type}")[0].dataType) for a in added_columns(table, version)]
    declared = {c.lower() for c in table.spec.columns}
    spec = table.spec.with_fields(f for f in extra if f.name.lower() not in declared)
    return DayTable(table.spark, table.root, spec)


def fits(given: T.DataType, held: T.DataType) -> bool:
    """Whether every value of a type can be stored in a column without loss."""
    if given == held or isinstance(given, T.NullType):
        return True
    if isinstance(given, T.DecimalType) and isinstance(held, T.DecimalType):
        return given.scale <= held.scale and given.precision - given.scale <= held.precision - held.scale
    a, b = given.simpleString(), held.simpleString()
    return any(a in row and b in row and row.index(a) <= row.index(b) for row in _WIDENING)


def accept(table: DayTable, rows: DataFrame) -> DayTable:
    """The table ready to be written with ``rows``: columns it does not know are registered, from the next snapshot on.

    Only the schema of ``rows`` is looked at. A column without a type (all nulls) is not registered; names that differ
    in case are one column. A type that the known column cannot hold, or a name that is no plain word, is refused
    before anything is registered.
    """
    current = evolved(table)
    known = {f.name.lower(): f for f in current.spec.schema}
    fresh: dict[str, T.StructField] = {}
    for field in rows.schema:
        held = known.get(field.name.lower()) or fresh.get(field.name.lower())
        if held is not None:
            if not fits(field.dataType, held.dataType):
                raise ColumnConflict(
                    f"{table.spec.name}.{held.name} holds {held.dataType.simpleString()}, "
                    f"the batch has {field.dataType.simpleString()}"
                )
        elif not _NAME.match(field.name):
            raise ColumnConflict(f"{table.spec.name}: {field.name!r} is no name for a column")
        elif not isinstance(field.dataType, T.NullType):
            fresh[field.name.lower()] = field
    if not fresh:
        return current
    since = table.snapshot().snapshot_id + 1
    for lower, field in fresh.items():
        entry = {"name": field.name, "type": field.dataType.simpleString(), "since": since}
        path = f"{table.root}/columns/{lower}.json"
        table.storage.make_dirs(f"{table.root}/columns")
        try:
            table.storage.publish_text(path, json.dumps(entry))
        except Exception:
            # Somebody else was first: fine if the column is the same.
            if not table.storage.exists(path) or json.loads(table.storage.read_text(path))["type"] != entry["type"]:
                raise
    return evolved(table)
