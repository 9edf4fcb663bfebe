"""Active registers per model and month."""

from __future__ import annotations

from pyspark.sql import DataFrame

from billscope.operators.months import active_per_month


def months_active(registers: DataFrame) -> DataFrame:
    """``registers``: ``model``, ``register_id`` (unique), ``registered``, ``fiscal_end``."""
    return active_per_month(registers, "model", "registered", "fiscal_end")
