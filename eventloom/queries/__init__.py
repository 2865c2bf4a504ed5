"""Queries over the driver's tables with the SQL that gives the same result."""

from . import deliveries, enrichment, events, jobs, logs, redaction, streams  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
