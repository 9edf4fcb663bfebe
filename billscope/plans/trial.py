"""Trial sign-ups: status updates, new leads with campaign payload, hand-over to the CRM loader, summary."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.functions.json import with_texts
from billscope.functions.text import UTM_PARTS, labelled_lines, next_list_number, stable_uuid, utm_payload
from billscope.operators.aggregates import string_agg
from billscope.operators.changes import delete_matching, only_new, outbox, update_from, update_where_exists
from billscope.operators.checks import require_rows
from billscope.operators.joins import exists_from_date, exists_in
from billscope.operators.windows import first_per_key, row_identity
from billscope.params import ReportParams
from billscope.plans import Outputs
from billscope.session import cut, cut_counted
from billscope.sources.readers import on_days, typed_landing

# Keys of the event variables, {column: key}.
SIGN_UP_KEYS = {
    "inn": "inn",
    "user_id": "userId",
    "user_name": "contactPerson",
    "phone": "phone",
    "email": "mail",
    "city": "city",
}
UTM_KEYS = {
    "utm_source": "utmSource",
    "utm_medium": "utmMedium",
    "utm_campaign": "utmCampaign",
    "utm_term": "utmTerm",
    "utm_content": "utmContent",
    "utm_from": "from",
    "utm_order_page": "utmOrderPage",
    "utm_referer": "utmReferer",
    "utm_start_page": "utmStartPage",
    "utm_ad": "utmAd",
    "utm_device": "utmDevice",
    "utm_region": "utmRegion",
    "utm_type": "utmType",
}
# Wording, list naming and codes of the hand-over.
COMMENT_HEADLINE = "Клиент создал орзанизацию. Познакомьте клиента с сервисом и выставьте счет."
COMMENT_LABELS = (
    ("ФИО", "user_name"),
    ("Телефон", "phone"),
    ("Электронная почта", "email"),
    ("Дата регистрации", "event_date"),
)
EXCLUDED_TARIFF = "Отчетность %"
OPEN_CARD_STATES = (1, 3)
CRM_ID, TASK_TYPE = 2, 8
NO_CARDS, NO_LEADS = "не было карточек", "Новых созданных организаций по Триалу нет"


def updated_trials(inputs: dict[str, DataFrame]) -> DataFrame:
    """Trial table with yesterday's loader answers, CRM ids and paid-bill flags filled in."""
    answers = inputs["load_log"].where(F.col("response").isNotNull()).select(
        F.col("object_id").alias("create_pp_id"), F.col("response"), F.to_date("date").alias("loaded")
    )
    trials = update_from(
        inputs["trial_orgs"],
        answers,
        "create_pp_id",
        {"pp_id": "response", "load_to_crm_date": "loaded"},
        lambda new: F.col("pp_id").isNull(),
    )
    sales = inputs["prospect_sales"].select(F.col("sale_id").alias("pp_id"), "offer_id")
    trials = update_from(trials, sales, "pp_id", {"kp_id": "offer_id"}, lambda new: F.col("kp_id").isNull())
    paying = exists_from_date(
        trials, inputs["client_bills"], "inn", "load_to_crm_date", "pay_date", F.col("bill_payed") > 0
    )
    return update_where_exists(
        trials, paying.select("create_pp_id"), "create_pp_id", "paid_bill", F.lit(1), F.col("paid_bill").isNull()
    )


def sign_ups(events: DataFrame, params: ReportParams) -> DataFrame:
    """Yesterday's registrations, one row per client; each column is the largest value seen."""
    topic, category, action = params.sign_up_event
    day = on_days(events, "client_date", params.yesterday)
    found = day.where((F.col("topic") == topic) & (F.col("category") == category) & (F.col("action") == action))
    columns = {name: (F.col(name), "string") for name in SIGN_UP_KEYS}
    columns["event_date"] = (F.col("client_date"), "date")
    landed = typed_landing(with_texts(found.select("client_date", "variables"), "variables", SIGN_UP_KEYS), columns, required=["event_date"])
    values = [c for c in columns if c != "inn"]
    return landed.groupBy("inn").agg(*[F.max(c).alias(c) for c in values])


def campaigns(events: DataFrame, params: ReportParams) -> DataFrame:
    """Yesterday's campaign events: user and the thirteen parts."""
    category, action = params.campaign_event
    day = on_days(events, "client_date", params.yesterday)
    found = day.where((F.col("category") == category) & (F.col("action") == action))
    keys = {"user_id": SIGN_UP_KEYS["user_id"], **{name: UTM_KEYS[name] for name, _ in UTM_PARTS}}
    return with_texts(found.select("variables"), "variables", keys).select(*keys).distinct()


def current_clients(inputs: dict[str, DataFrame], params: ReportParams) -> DataFrame:
    """Clients with a running subscription of the excluded tariff or a bill paid in full within a year."""
    day = F.lit(params.as_of)
    running = inputs["subscriptions"].where(
        (F.col("is_real") == 1) & day.between(F.col("since"), F.col("up_to")) & F.col("tariff_name").ilike(EXCLUDED_TARIFF)
    )
    subscribed = running.select("client_id").distinct().join(inputs["clients"].select("client_id", "inn"), "client_id").select("inn")
    paid = inputs["client_bills"].where(
        (F.col("bill_payed") == F.col("bill_sum")) & (F.col("pay_date") > F.add_months(day, -12))
    ).select("inn")
    return subscribed.unionByName(paid)


def leads(new: DataFrame, utm: DataFrame, registry: DataFrame) -> DataFrame:
    """New clients with head-office data, payload, comment and ids that survive a recomputation."""
    head = first_per_key(
        registry.join(new.select("inn"), "inn", "left_semi"),
        ["inn"],
        [("is_head", "desc"), ("kpp", "asc")],
        ["kpp", "region_code", "ct", "addr", "short_name"],
    )
    rows = (
        new.drop("city")
        .join(head, "inn")
        .join(utm, "user_id", "left")
        .select(
            "inn",
            "kpp",
            "region_code",
            F.col("ct").alias("city"),
            "addr",
            "short_name",
            "event_date",
            utm_payload({name: F.col(name) for name, _ in UTM_PARTS}).alias("specific_data"),
            labelled_lines(COMMENT_HEADLINE, [(label, F.col(c)) for label, c in COMMENT_LABELS]).alias("comment"),
        )
        .distinct()
    )
    return rows.withColumns(
        {
            "client_id": stable_uuid(F.lit("client"), F.col("inn"), F.col("specific_data"), F.col("comment")),
            "create_pp_id": stable_uuid(F.lit("lead"), F.col("inn"), F.col("specific_data"), F.col("comment")),
        }
    )


def trial(inputs: dict[str, DataFrame], params: ReportParams, stop_when_empty: bool = False) -> Outputs:
    """``trial_orgs``, ``leads``, ``existing``, ``task``, ``comments``, ``card_links`` and the one-row ``summary``.

    Inputs: trial_orgs, load_log, prospect_sales, client_bills, events, subscriptions, clients,
    org_registry, prospect_cards, tasks, offers. With ``stop_when_empty`` a day without new leads fails the job. What the
    summary counts is counted by the writes of the tables it is about.
    """

    @cache
    def counted_trials() -> tuple[DataFrame, dict]:
        loaded = F.count(F.when(F.col("load_to_crm_date") == F.lit(params.yesterday), 1))
        return cut_counted(updated_trials(inputs), "trials", n_loaded=loaded)

    def trials() -> DataFrame:
        return counted_trials()[0]

    @cache
    def prepared() -> DataFrame:
        fresh = only_new(sign_ups(inputs["events"], params), trials(), "inn")
        fresh = delete_matching(fresh, current_clients(inputs, params), "inn")
        rows = leads(fresh, campaigns(inputs["events"], params), inputs["org_registry"])
        return require_rows(rows, NO_LEADS) if stop_when_empty else cut(rows)

    @cache
    def existing() -> DataFrame:
        open_cards = inputs["prospect_cards"].where(F.col("state").isin(*OPEN_CARD_STATES))
        best_card = first_per_key(
            exists_in(open_cards, prepared(), "inn"),
            ["inn"],
            [("temperature", "asc"), ("created", "desc"), ("card_id", "asc")],
            ["card_id"],
        )
        return cut(prepared().join(best_card, "inn").select("comment", "create_pp_id", F.col("card_id").alias("pp_id")))

    @cache
    def new_leads() -> tuple[DataFrame, dict]:
        return cut_counted(delete_matching(prepared(), existing(), "create_pp_id"), "new_leads")

    @cache
    def handed_over() -> tuple[DataFrame, DataFrame]:
        number = inputs["tasks"].select(next_list_number(F.col("brief_id"), params.list_suffix).alias("list_id")).scalar()
        task = {
            "task_id": stable_uuid(F.lit("task"), F.lit(params.as_of.isoformat()), F.lit(params.list_name)),
            "list_id": number,
            "base_name": F.lit(params.list_name),
        }
        header, comments = outbox(existing().select("pp_id", "comment"), task, params.outbox_priority)
        codes = {"crm_id": F.lit(CRM_ID), "task_type_id": F.lit(TASK_TYPE), "user_id": F.lit(params.outbox_user)}
        return header.withColumns(codes), comments

    def links() -> DataFrame:
        return card_links(trials(), inputs["prospect_sales"], inputs["offers"], params)

    return Outputs(
        trial_orgs=trials,
        leads=lambda: row_identity(new_leads()[0], ["inn", "create_pp_id"], "row_id"),
        existing=existing,
        task=lambda: handed_over()[0],
        comments=lambda: handed_over()[1],
        card_links=links,
        summary=lambda: summary(links(), counted_trials()[1]["n_loaded"], new_leads()[1]["n"]),
    )


def card_links(trials: DataFrame, sales: DataFrame, offers: DataFrame, params: ReportParams) -> DataFrame:
    """Links of the CRM cards of the trials loaded yesterday, one per row."""
    loaded = trials.where(F.col("load_to_crm_date") == F.lit(params.yesterday))
    return (
        loaded.select("pp_id")
        .join(sales.select(F.col("sale_id").alias("pp_id"), "offer_id"), "pp_id")
        .join(offers.select("offer_id", "activity_id"), "offer_id")
        .select(F.concat(F.lit(params.card_url), F.col("activity_id").cast("string")).alias("url"))
    )


def summary(links: DataFrame, n_loaded: int, n_leads: int) -> DataFrame:
    """One row for the message of the day: trials loaded yesterday, their card links as one text, number of new leads
    and a note if none. The text is as long as the day's links; ``card_links`` has them as rows.
    """
    text = string_agg(links, [], "url", " <br> ", "links")
    return text.select(
        F.lit(str(n_loaded)).alias("created_yesterday"),
        F.coalesce("links", F.lit(NO_CARDS)).alias("cards"),
        F.lit(n_leads).cast("long").alias("n_leads"),
        F.lit("" if n_leads else NO_LEADS).alias("note"),
    )
