"""Runnable plans: each wires operators to the given tables and states the same result in SQL."""

from tierwork.plans import (  # noqa: F401
    finance, history, ingest, joins, loads, mastering, merges, observations, quality, reports, shapes, staging, storage, streams, vendors,
)
from tierwork.plans.registry import ORACLE, QUERIES  # noqa: F401
