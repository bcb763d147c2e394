"""Queries that bind every operator to the driver tables, with their SQL counterparts."""

from registry import (  # noqa: F401
    aggregates, checks, joins, loads, profiles, scalars, selection, storage, warehouse,
)
from registry.base import ORACLES, QUERIES  # noqa: F401
