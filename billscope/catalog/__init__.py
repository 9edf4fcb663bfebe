"""Registered queries: every operator and report applied to the driver tables, with its SQL counterpart."""

from __future__ import annotations

from billscope.catalog import aggregates, changes, expressions, joins, reports, rows, scans, sequences  # noqa: F401
from billscope.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
