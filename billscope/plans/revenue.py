"""Revenue: new bills by category, with roles and segments; refunded bills removed."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions.text import first_rule
from billscope.functions.values import MONEY, money_or_zero
from billscope.operators.aggregates import string_agg
from billscope.operators.changes import delete_groups, update_from
from billscope.operators.checks import require_allowed
from billscope.operators.joins import exists_in, not_in
from billscope.params import ReportParams
from billscope.plans import Outputs
from billscope.plans.roles import role_lists
from billscope.plans.vocabulary import UNASSIGNED
from billscope.session import cut

# The price set that is never revenue, the category lists and the renaming rules.
TEST_DRIVE = "Тест-драйв 7 дней"
CATEGORIES = (
    "API-лицензия",
    "Базовый",
    "Внедрение",
    "Допы",
    "Коннектор",
    "Модуль Интеграция",
    "Модуль Оборудование",
    "Пакет",
    "Сопровождение",
)
OTHER_CATEGORIES = ("Железо", "доставка и бамперы", "допы др проектов")
CATEGORY_RULES = (
    (
        (
            "%стоимость за час%",
            "%стоимость за 1 час%",
            "Внедрение%",
            "Инструктаж%",
            "Консультации%",
            "Доработка%",
        ),
        "Внедрение",
    ),
    (("Сопровождение%",), "Сопровождение"),
    (("Модуль Оборудование тариф%",), "Модуль Оборудование"),
)
OTHER_CATEGORY_RULES = ((("Бампер защитный%", "Доставка%"), "доставка и бамперы"),)


def new_bill_lines(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """Lines of bills not reported yet that have a payment in the reporting period."""
    payments = inputs["payments"].where(F.col("pay_date").between(F.lit(params.first_pay_date), F.lit(params.as_of)))
    paid = inputs["payment_lines"].join(payments, "payment_id").select("bill_id", "bill_line_id")
    lines = inputs["bill_lines"].where(F.col("price_set_name") != TEST_DRIVE)
    fresh = not_in(lines, inputs["all_revenue"].select("num"), "num")
    return exists_in(fresh, paid, ["bill_id", "bill_line_id"])


def category_columns(lines: DataFrame, rules, categories, *more: Column) -> DataFrame:
    """One row per bill with the summed cost of each category in a column of its name, and ``more`` aggregates.

    With the columns known in advance a pivot is a set of conditional sums, so everything a bill needs
    comes out of one exchange.
    """
    label = first_rule(F.col("price_set_name"), rules, F.col("price_set_name"))
    named = require_allowed(lines.withColumn("category", label), "category", categories)
    cost = F.col("cost").cast(MONEY)
    sums = [F.sum(F.when(F.col("category") == name, cost)).alias(name) for name in categories]
    return named.groupBy("num").agg(*sums, *more)


def revenue(inputs: dict[str, DataFrame], params: ReportParams) -> Outputs:
    """``all_revenue``: the revenue table after this run; ``roles``: likely role per client.

    Inputs: bill_lines, payments, payment_lines, other_lines, offer_links, offers, activities,
    segmentation, all_revenue. A category outside the known lists fails the job. A bill is a partial
    refund when less than its recorded cost, but more than nothing, is left of its payments (whole units).
    """

    @cache
    def lines() -> DataFrame:  # the increment is joined out of the full history; the amounts and the roles both start from it
        return cut(new_bill_lines(inputs, params).select("num", "inn", "price_set_name", "cost"))

    def roles() -> DataFrame:
        everyone = inputs["all_revenue"].select("inn").unionByName(lines().select("inn"))
        return role_lists(inputs["offers"], inputs["activities"], everyone)

    return Outputs(all_revenue=lambda: revenue_table(inputs, lines()), roles=roles)


def revenue_table(inputs: dict[str, DataFrame], lines: DataFrame) -> DataFrame:
    """The revenue table with the bills of the new ``lines``, segments corrected, refunds taken out."""
    own = category_columns(lines, CATEGORY_RULES, CATEGORIES, F.min("inn").alias("inn"))
    others = category_columns(inputs["other_lines"], OTHER_CATEGORY_RULES, OTHER_CATEGORIES)
    offers = inputs["offers"].where(F.col("external_id").isNotNull()).select("offer_id", "external_id")
    temperature = string_agg(
        inputs["offer_links"].select(F.col("bill_num").alias("num"), "offer_id").join(offers, "offer_id"),
        ["num"],
        "external_id",
        "; ",
        "external_ids",
    )
    bills = (
        own.join(others, "num", "left")
        .join(temperature, "num", "left")
        .select(
            "num",
            "inn",
            *CATEGORIES,
            *[money_or_zero(F.col(c)).alias(c) for c in OTHER_CATEGORIES],
            F.coalesce("external_ids", F.lit("")).alias("external_ids"),
            F.lit(UNASSIGNED).alias("segment"),
        )
    )
    table = inputs["all_revenue"].unionByName(bills, allowMissingColumns=True)
    known = inputs["segmentation"].where(F.col("segment") != UNASSIGNED).select("inn", F.col("segment").alias("_segment"))
    table = update_from(table, known, "inn", {"segment": "_segment"}, lambda new: new["_segment"] != F.col("segment"))

    left_over, recorded = F.col("payed"), F.col("recorded")
    return delete_groups(
        table,
        inputs["bill_lines"],
        "num",
        (left_over == 0) | ((F.round(left_over, 0) < F.round(recorded, 0)) & (left_over > 0)),
        payed=F.sum("payed"),
        recorded=F.sum("cost"),
    )
