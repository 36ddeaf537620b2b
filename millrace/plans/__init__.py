"""All registered queries: ``QUERIES`` by name, ``ORACLES`` with their SQL."""

from millrace.plans import aggs, joining, layouts, logs, rows, scans, streams  # noqa: F401
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
