from daybook.catalog import analytics, jobs, operations, scalars, tables  # noqa: F401 - they register queries
from daybook.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
