"""Active and future subscriptions with activity, plan sum and segment."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.json import json_string
from billscope.functions.text import matches_any
from billscope.functions.values import not_below_zero
from billscope.operators.aggregates import string_agg
from billscope.operators.changes import delete_where
from billscope.operators.joins import exists_in, not_in
from billscope.params import ReportParams
from billscope.plans import Outputs
from billscope.plans.vocabulary import BASE_TARIFF, REPORT_DATE_FORMAT
from billscope.session import cut

# One-off services and hardware that do not count towards the plan sum.
ONE_OFF_PATTERNS = (
    "Инструктаж%",
    "Рабочее место%",
    "Внедрение%",
    "%стоимость за час%",
    "%стоимость за 1 час%",
    "Бампер%",
    "Доставка%",
    "Пакет для обработки%",
)
# Ignored actions and categories, payer product, renamed segment.
IGNORED_ACTIONS = ("Переход в раздел", "Отправка в архив")
IGNORED_CATEGORIES = ("Сотрудники", "Настройки")
PAYER_PRODUCT = "Mark"
CENTER_SEGMENT_RENAME = ("Остальные", "Масс")

CLIENT = ["inn", "kpp", "short_name", "role", "revenue_last_known", "agent_name", "center_segment", "department"]
BILL = ["bill_date", "bill_sum", "payed", "pay_date", "since", "up_to"]
DISPLAY = [
    *CLIENT,
    "bill_date",
    "payed",
    "pay_date",
    "since",
    "up_to",
    "tariff",
    "enter",
    "last_date",
    "status",
    "product_group",
    "summ_plan",
    "plan_date",
    "bill_id",
    "agent_code",
    "since_date",
    "up_to_date",
    "current",
]


def in_force_or_future(subscriptions: DataFrame, as_of) -> DataFrame:
    """Real subscriptions running on ``as_of`` (current = '1') or starting later (current = '0'), one scan."""
    day = F.lit(as_of)
    running = day.between(F.col("since"), F.col("up_to"))
    label = F.when(running, "1").when(F.col("since") > day, "0")
    return (
        subscriptions.where((F.col("is_real") == 1) & ((F.col("up_to") >= day) | (F.col("since") > day)))
        .select("client_id", "agent_id", "bill_id", "tariff_name", "since", "up_to", label.alias("current"))
        .where(F.col("current").isNotNull())
        .distinct()
    )


def last_activity(tracker: DataFrame, as_of, site: str) -> DataFrame:
    """Per client seen in the service before ``as_of``: day of the last action that counts (NULL if none)."""
    counts = ~F.col("action").isin(*IGNORED_ACTIONS) & ~F.col("category").isin(*IGNORED_CATEGORIES)
    return (
        tracker.where((F.col("site_id") == site) & (F.col("event_date") < F.lit(as_of)))
        .select(json_string(F.col("custom_variables"), "organizationInn").alias("inn"), F.when(counts, F.col("event_date")).alias("_day"))
        .where(F.col("inn") != "")
        .groupBy("inn")
        .agg(F.max("_day").alias("last_date"), F.lit(1).alias("enter"))
    )


def clients_known(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """Clients with registry, activity, segment and holder: all that a subscription takes from its client."""
    clients = inputs["clients"].select("client_id", "inn", F.col("kpp").alias("_kpp"))
    registry = inputs["org_registry"].select("inn", F.col("kpp").alias("_kpp"), "short_name", "role", "revenue_last_known", "status")
    links = inputs["payer_links"].where((F.col("expiration_date") > F.lit(params.as_of)) & (F.col("product_id") == PAYER_PRODUCT))
    holders = (
        links.join(inputs["agents"].select("code").distinct(), F.col("center_code") == F.col("code"), "left")
        .select(F.col("payer_id").alias("client_id"), F.col("code").alias("hold"))
        .distinct()
    )
    segments = inputs["segmentation"].select("inn", F.col("segment").alias("product_group")).distinct()
    return (
        clients.join(registry, ["inn", "_kpp"], "left")
        .join(last_activity(inputs["tracker"], params.as_of, params.tracker_site), "inn", "left")
        .join(segments, "inn", "left")
        .join(holders, "client_id", "left")
        .withColumn("kpp", F.coalesce("_kpp", F.lit("")))
        .drop("_kpp")
    )


def bills_known(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """Bills with ``pure_sum``, their total less the one-off lines.

    Only lines of listed bills can matter, so the pattern is tested on those lines directly.
    """
    one_off = inputs["bill_lines"].where(matches_any(F.col("price_set_name"), ONE_OFF_PATTERNS))
    listed = in_force_or_future(inputs["subscriptions"], params.as_of)
    net = (
        exists_in(one_off, listed, "bill_id")
        .groupBy("bill_id", "doc_sum")
        .agg((F.col("doc_sum") - F.sum("cost")).alias("pure_sum"))
        .select("bill_id", "pure_sum")
    )
    return inputs["bills"].select("bill_id", "bill_date", "bill_sum", "payed", "pay_date").join(net, "bill_id", "left")


def enriched(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """Subscriptions with all that is known of client, bill and agent; tariffs of equal rows as one text.

    A group is one bill and period, so the set it collects is no longer than the list of tariffs. Bills are joined last: the
    groups, which hold ``bill_id``, and the distinct rows after them then need no further exchange of the wide rows.
    """
    subs = in_force_or_future(inputs["subscriptions"], params.as_of)
    agents = inputs["agents"]
    old, new = CENTER_SEGMENT_RENAME
    agents = agents.select(
        "agent_id",
        F.col("code").alias("agent_code"),
        "agent_name",
        F.when(F.col("center_segment") == old, new).otherwise(F.col("center_segment")).alias("center_segment"),
        "department",
    )
    rows = subs.join(agents, "agent_id").join(clients_known(inputs, params), "client_id").join(bills_known(inputs, params), "bill_id")
    bundle = F.collect_set(F.struct("tariff_name", "client_id"))
    names = F.array_sort(F.transform("_bundle", lambda b: b["tariff_name"]))
    wide = [*CLIENT, *BILL, "status", "bill_id", "agent_code", "hold", "current", "pure_sum", "enter", "last_date", "product_group"]
    return (
        rows.groupBy(*wide)
        .agg(bundle.alias("_bundle"))
        .select(*wide, F.when(F.size(F.array_compact(names)) > 0, F.array_join(names, "; ")).alias("tariff"))
    )


def detail_rows(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """One row per subscription bundle with activity flags, plan sum, segment and formatted dates."""
    shown = lambda column: F.date_format(column, REPORT_DATE_FORMAT)
    return (
        enriched(inputs, params)
        .withColumns(
            {
                "enter": F.coalesce("enter", F.lit(0)),
                "summ_plan": F.coalesce("pure_sum", "bill_sum"),
                "plan_date": shown(F.date_add("up_to", 1)),
                "pay_date": shown("pay_date"),
                "since_date": F.col("since"),
                "up_to_date": F.col("up_to"),
                "since": shown("since"),
                "up_to": shown("up_to"),
            }
        )
        .select(*DISPLAY, "hold")
        .distinct()
    )


def without_foreign_holders(rows: DataFrame) -> DataFrame:
    """Where a client has several holders, rows whose holder is not the billing agent go. Only such rows look their client up."""
    several = rows.groupBy("inn").agg(F.countDistinct("hold").alias("_n")).where(F.col("_n") > 1)
    foreign = F.coalesce(F.col("agent_code") != F.col("hold"), F.lit(False))
    marked = rows.where(foreign).join(several, "inn", "left")
    return rows.where(~foreign).unionByName(delete_where(marked, F.col("_n").isNotNull()).select(*rows.columns))


def rolled_up(rows: DataFrame) -> DataFrame:
    """Base-tariff rows carrying all tariffs and the summed plan of their client and period flag.

    The totals are grouped once per (client, flag); every base row then picks them up, so no row meets
    every other row of its client. Base rows that differ only in the holder count once; they are told apart after the
    join, which has brought equal ones together.
    """
    totals = string_agg(rows, ["inn", "current"], "tariff", "; ", "_tariffs", sums={"summ_plan": "_sum"})
    base = rows.where(F.col("tariff").ilike(BASE_TARIFF)).select(*DISPLAY).drop("tariff", "summ_plan")
    joined = base.join(totals, ["inn", "current"])
    return joined.withColumnsRenamed({"_tariffs": "tariff", "_sum": "summ_plan"}).select(*DISPLAY).distinct()


def upcoming_pairs(report: DataFrame) -> DataFrame:
    """Clients with both current and future rows: difference of the plan sums, future tariff and dates."""
    now = report.where(F.col("current") == "1").select("inn", "bill_id", F.col("summ_plan").alias("_now"), F.col("plan_date").alias("_plan"))
    later = report.where(F.col("current") == "0").select(
        "inn",
        F.col("summ_plan").alias("_later"),
        F.col("plan_date").alias("_plan_later"),
        F.col("tariff").alias("tariff_2"),
        F.col("since_date").alias("since_2"),
        F.col("up_to_date").alias("up_to_2"),
    )
    return now.join(later, "inn").select(
        "inn",
        not_below_zero(F.col("_now") - F.col("_later")).alias("sum_plan"),
        F.coalesce("_plan_later", "_plan").alias("plan_date"),
        "bill_id",
        "tariff_2",
        "since_2",
        "up_to_2",
    )


def active_report(inputs: dict[str, DataFrame], params: ReportParams) -> Outputs:
    """``report``: rolled-up base rows plus the rows of clients without a base tariff; ``upcoming``: pairs.

    Inputs: subscriptions, clients, bills, agents, org_registry, payer_links, tracker, bill_lines,
    segmentation.
    """

    @cache
    def report() -> DataFrame:
        # the details, the rows kept of them and the report each feed several steps and are computed once
        detail = cut(detail_rows(inputs, params))
        kept = cut(without_foreign_holders(detail))
        base = rolled_up(kept)
        based = kept.where(F.col("tariff").ilike(BASE_TARIFF) & F.col("inn").isNotNull()).select("inn")
        plain = not_in(detail.select(*DISPLAY), based, "inn").distinct()
        return cut(base.unionByName(plain))

    return Outputs(report=report, upcoming=lambda: upcoming_pairs(report()))
