"""Renewal report: does a subscription have a following one of the same tariff family, and how soon."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.text import first_rule
from billscope.operators.changes import update_where_exists
from billscope.operators.windows import first_per_key, in_sequence
from billscope.params import ReportParams
from billscope.plans import Outputs
from billscope.plans.roles import role_lists
from billscope.plans.vocabulary import UNASSIGNED
from billscope.session import cut

# Tariff families and revenue kinds.
FAMILY_RULES = ((("Базовый%",), "Базовый"), (("Модуль %",), "Модуль"))
NEW_CONNECTION = "подключение"
RENEWAL = "продление"


def subscription_chain(subscriptions: DataFrame, clients: DataFrame, bills: DataFrame) -> DataFrame:
    """Real subscriptions with client, bill and tariff family."""
    real = subscriptions.where(F.col("is_real") == 1).select("client_id", "bill_id", "tariff_name", "since", "up_to").distinct()
    return (
        real.join(clients.select("client_id", "inn", F.coalesce("kpp", F.lit("")).alias("kpp")), "client_id")
        .join(bills.select("bill_id", "num", "bill_date"), "bill_id")
        .select("inn", "kpp", "num", "tariff_name", "since", "up_to", "bill_date", first_rule(F.col("tariff_name"), FAMILY_RULES).alias("family"))
        .distinct()
    )


def renewals(chain: DataFrame, gap_days: int) -> DataFrame:
    """The chain with the following subscription of the same client and family and the renewal flag.

    Renewed means the following one starts less than ``gap_days`` after the end, overlaps included. When
    not renewed, the following bill, its date and start are blanked; its tariff and the gap stay. Rows
    without a client or a family have no successor.
    """
    known = F.col("inn").isNotNull() & F.col("family").isNotNull()
    linked = in_sequence(
        chain.where(known),
        ["inn", "family"],
        ["since", "num", "tariff_name", "up_to", "kpp", "bill_date"],
        following={"num": "_num", "tariff_name": "_tariff", "bill_date": "_bill_date", "since": "_since"},
    )
    linked = linked.unionByName(chain.where(~known), allowMissingColumns=True)
    gap = F.date_diff(F.col("_since"), F.col("up_to"))
    renewed = F.col("prolong") == 1
    return (
        linked.withColumn("defer", gap)
        .withColumn("prolong", F.when(F.col("defer") < gap_days, 1).otherwise(0))
        .select(
            "inn",
            "kpp",
            "num",
            "tariff_name",
            "since",
            "up_to",
            "family",
            "prolong",
            "defer",
            F.when(renewed, F.col("_num")).alias("next_num"),
            F.coalesce("_tariff", F.lit("")).alias("next_tariff"),
            F.when(renewed, F.col("_bill_date")).alias("next_bill_date"),
            F.when(renewed, F.col("_since")).alias("next_since"),
        )
    )


def bill_codes(lines: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """(``num``, ``code``) of every bill with the money paid per tariff family on subscribed bills.

    One pass over the lines: the few codes of a bill are collected beside its sums.
    """
    subscribed = subscriptions.where(F.col("is_real") == 1).select("bill_id").distinct().withColumn("_own", F.lit(True))
    sums = [
        F.sum(F.when(F.col("_own") & (F.col("tariff_name") == family), F.col("payed"))).alias(family)
        for _, family in FAMILY_RULES
    ]
    per_bill = lines.join(subscribed, "bill_id", "left").groupBy("num").agg(F.collect_set(F.struct("code")).alias("_codes"), *sums)
    return per_bill.select("num", F.explode("_codes").alias("_code"), *[family for _, family in FAMILY_RULES]).select(
        "num", F.col("_code.code").alias("code"), *[family for _, family in FAMILY_RULES]
    )


def prolongation(inputs: dict[str, DataFrame], params: ReportParams, product: str) -> Outputs:
    """``report``: one row per subscription and bill-line code; ``all_revenue``: the corrected revenue table."""

    @cache
    def rows() -> DataFrame:
        chain = cut(subscription_chain(inputs["subscriptions"], inputs["clients"], inputs["bills"]))  # sampled, then numbered
        return cut(renewals(chain, params.renewal_gap_days))  # read several times by each result

    @cache
    def revenue() -> DataFrame:
        renewing = rows().select(F.col("next_num").alias("num")).where(F.col("num").isNotNull())
        return update_where_exists(
            inputs["all_revenue"], renewing, "num", "revenue_type", F.lit(RENEWAL), F.col("revenue_type") == NEW_CONNECTION
        )

    return Outputs(report=lambda: report(inputs, rows(), revenue(), params, product), all_revenue=revenue)


def report(inputs: dict[str, DataFrame], rows: DataFrame, revenue: DataFrame, params: ReportParams, product: str) -> DataFrame:
    """The renewal rows with reasons, status, roles, codes, payments and product group."""
    lost = rows.where(F.col("prolong") == 0).select("inn").distinct()
    refusals = inputs["offers"].where((F.col("crm_product") == product) & F.col("reject_reason").isNotNull())
    reasons = first_per_key(
        refusals.join(lost, "inn", "left_semi"), ["inn"], [("reject_date", "desc"), ("reject_reason", "asc")], ["reject_reason"]
    )
    status = inputs["org_registry"].select("inn", "status").distinct()
    after_end = F.date_add("up_to", 1)
    dated = (
        rows.join(reasons, "inn", "left")
        .join(status, "inn", "left")
        .withColumns({"renewal_year": F.year(after_end), "renewal_month": F.month(after_end)})
    )

    roles = role_lists(inputs["offers"], inputs["activities"], rows.select("inn"))
    codes = bill_codes(inputs["bill_lines"], inputs["subscriptions"])
    paid = revenue.select(F.col("num").alias("next_num"), F.col("pay_date").alias("next_pay_date")).distinct()
    segments = inputs["segmentation"].select("inn", "segment").distinct()
    groups = inputs["all_categories"].select("inn", F.col("product_group").alias("_group")).distinct()
    unassigned = (F.col("segment") == UNASSIGNED) | F.col("segment").isNull()
    tariff_sum = None
    for _, family in FAMILY_RULES:
        mine = F.col("family") == family
        tariff_sum = F.when(mine, F.col(family)) if tariff_sum is None else tariff_sum.when(mine, F.col(family))
    return (
        dated.join(codes, "num")
        .withColumn("tariff_sum", tariff_sum)
        .join(paid, "next_num", "left")
        .join(segments, "inn", "left")
        .join(groups, "inn", "left")
        .join(roles, "inn", "left")
        .select(
            "renewal_year",
            "renewal_month",
            "inn",
            "kpp",
            F.coalesce("role", F.lit("")).alias("role"),
            F.when(unassigned, F.coalesce("_group", F.lit(""))).otherwise(F.col("segment")).alias("product_group"),
            "num",
            "tariff_sum",
            "code",
            "tariff_name",
            "since",
            "up_to",
            "prolong",
            "defer",
            "next_tariff",
            "next_num",
            "next_bill_date",
            F.date_diff(F.col("next_pay_date"), F.col("next_bill_date")).alias("days_to_pay"),
            "next_since",
            "status",
            "reject_reason",
            F.lit(params.as_of).alias("date_load"),
        )
        .distinct()
    )
