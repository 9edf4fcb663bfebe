"""Which client a portal user belongs to, from tracker events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.json import json_string
from billscope.functions.values import NIL_GUID


def user_inn_map(tracker: DataFrame, inn_key: str = "organizationInn") -> DataFrame:
    """Distinct (``inn``, ``portal_user_id``) of known users and clients."""
    return (
        tracker.where(F.col("portal_user_id") != NIL_GUID)
        .select(json_string(F.col("custom_variables"), inn_key).alias("inn"), "portal_user_id")
        .where(F.col("inn") != "")
        .distinct()
    )
