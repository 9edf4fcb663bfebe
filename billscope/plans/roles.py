"""Likely client roles, read from the notes on CRM activities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.text import first_rule, through_marker
from billscope.operators.aggregates import string_agg
from billscope.operators.joins import exists_in

# The marker in activity notes and the role rules, first match wins.
ROLE_MARKER = "Кто клиенты:"
ROLE_RULES = (
    (("%производ%",), "Производитель"),
    (("%опт%",), "Оптовик"),
    (("%розн%",), "Розница"),
    (("%импорт%",), "Импорт"),
)


def client_roles(offers: DataFrame, activities: DataFrame, clients: DataFrame) -> DataFrame:
    """Distinct (``inn``, ``role``) of the given clients. Notes are classified before any join."""
    noted = (
        activities.select("activity_id", first_rule(through_marker(F.col("description"), ROLE_MARKER), ROLE_RULES).alias("role"))
        .where(F.col("role").isNotNull())
    )
    known = exists_in(offers.select("inn", "activity_id"), clients, "inn")
    return known.join(noted, "activity_id").select("inn", "role").distinct()


def role_lists(offers: DataFrame, activities: DataFrame, clients: DataFrame) -> DataFrame:
    """``inn`` and its roles as one text."""
    return string_agg(client_roles(offers, activities, clients), ["inn"], "role", "; ", "role")
