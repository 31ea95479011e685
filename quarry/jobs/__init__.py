"""Registered queries: importing this package fills ``registry.QUERIES``."""

from quarry.jobs import (  # noqa: F401
    aggregates, change, complex, composite, joins, ordering, plans, projection, protection, scalar, sinks,
    sources, streams)
from quarry.jobs.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
