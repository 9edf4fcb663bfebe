"""Client segments from two sources: product groups used in the service, then tags in CRM notes."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.dates import week_of_year
from billscope.functions.json import with_texts
from billscope.functions.values import NIL_GUID, differs_or_missing
from billscope.operators.aggregates import string_agg
from billscope.operators.changes import update_from
from billscope.operators.checks import unmapped_values
from billscope.operators.dictionary import tag_matches
from billscope.operators.joins import exists_in, not_in
from billscope.operators.windows import running_first
from billscope.params import ReportParams
from billscope.plans import Outputs
from billscope.plans.vocabulary import BASE_TARIFF, UNASSIGNED
from billscope.session import cut

# Client types for charts.
MULTI_SEGMENT = "мультиотрасль"
UNKNOWN_SEGMENT = "неизвестно"


def service_groups(tracker: DataFrame) -> DataFrame:
    """Distinct (``inn``, ``product_group``) of clients seen in the service."""
    return (
        with_texts(
            tracker.where(F.col("portal_user_id") != NIL_GUID).select("custom_variables"),
            "custom_variables",
            {"inn": "organizationInn", "product_group": "productGroup"},
        )
        .select("inn", "product_group")
        .where((F.col("inn") != "") & (F.col("product_group") != ""))
        .distinct()
    )


def first_payments(inputs: dict[str, DataFrame]) -> DataFrame:
    """First payment date of a base tariff and its manager, per client not segmented yet."""
    lines = inputs["bill_lines"].where((F.col("payed") > 1) & F.col("price_set_name").ilike(BASE_TARIFF))
    dated = (
        lines.select("inn", "manager_name", "bill_line_id")
        .join(inputs["payment_lines"].select("bill_line_id", "payment_id"), "bill_line_id")
        .join(inputs["payments"].select("payment_id", "pay_date"), "payment_id")
    )
    return not_in(running_first(dated, ["inn"], "pay_date", "manager_name"), inputs["segmentation"].select("inn"), "inn")


def client_type(segment):
    return (
        F.when(segment.like("%,%"), MULTI_SEGMENT).when(segment == UNASSIGNED, UNKNOWN_SEGMENT).otherwise(segment)
    )


def segmentation(inputs: dict[str, DataFrame], params: ReportParams) -> Outputs:
    """``segmentation``: the table after this run; ``new_clients``: the rows added; ``unmapped``: product groups that the
    catalog does not know, one per row.

    Inputs: tracker, tag_catalog, segmentation, bill_lines, payment_lines, payments, offers, activities.
    The three per-client intermediates feed several steps each and are written once.
    """
    catalog = inputs["tag_catalog"]
    assign = {"segment": "new_segment"}
    guard = lambda new: differs_or_missing(F.col("segment"), new["new_segment"])

    def unmapped() -> DataFrame:
        return unmapped_values(service_groups(inputs["tracker"]), "product_group", catalog.select(F.col("tags").alias("product_group")))

    @cache
    def by_service() -> DataFrame:
        mapped = service_groups(inputs["tracker"]).join(catalog.withColumnRenamed("tags", "product_group"), "product_group")
        return cut(string_agg(mapped, ["inn"], "segment", ", ", "new_segment"))

    @cache
    def payments() -> DataFrame:
        return cut(first_payments(inputs))

    @cache
    def serviced() -> DataFrame:
        return update_from(inputs["segmentation"], by_service(), "inn", assign, guard)

    @cache
    def by_note() -> DataFrame:
        unsure = serviced().where((F.col("segment") == UNASSIGNED) | F.col("segment").isNull()).select("inn")
        candidates = exists_in(inputs["offers"].select("inn", "activity_id"), payments().select("inn").unionByName(unsure), "inn")
        candidates = not_in(candidates, by_service().select("inn"), "inn")
        notes = exists_in(inputs["activities"].select("activity_id", "description"), candidates, "activity_id")
        segment_of_tag = catalog.select(F.lower("tags").alias("tag"), "segment").distinct()
        mentioned = tag_matches(notes, "activity_id", "description", catalog, "tags").join(segment_of_tag, "tag")
        noted = candidates.join(mentioned, "activity_id").select("inn", "segment").distinct()
        return cut(string_agg(noted, ["inn"], "segment", ", ", "new_segment"))

    @cache
    def noted() -> DataFrame:
        return update_from(serviced(), by_note(), "inn", assign, guard)

    @cache
    def new_clients() -> DataFrame:
        found = exists_in(by_service(), payments(), "inn").unionByName(exists_in(by_note(), payments(), "inn")).distinct()
        clients = payments().join(found, "inn", "left").withColumn("week_num", week_of_year(F.col("pay_date"), params.first_weekday))
        listed = string_agg(clients, ["week_num", "inn", "manager_name", "pay_date"], "new_segment", ", ", "segment")
        rows = listed.withColumn("segment", F.coalesce("segment", F.lit(UNASSIGNED))).withColumn("tip", client_type(F.col("segment")))
        return not_in(rows, noted().select("inn"), "inn").select("week_num", "segment", "inn", "manager_name", "pay_date", "tip")

    return Outputs(segmentation=lambda: noted().unionByName(new_clients()), new_clients=new_clients, unmapped=unmapped)
