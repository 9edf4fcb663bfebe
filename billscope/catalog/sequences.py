"""Order-based operators: latest, first, numbering, month series."""

from __future__ import annotations

from pyspark.sql import functions as F

from billscope.catalog.base import Tables, query
from billscope.catalog.views import bills, sql_with, subs
from billscope.operators.months import active_per_month, month_rows
from billscope.operators.windows import first_per_key, in_sequence, keep_latest, row_identity, running_first


@query(
    "win_keep_latest",
    """SELECT user_id, event_id, event_type, CAST(ts AS DATE) AS day FROM events
       QUALIFY CAST(ts AS DATE) = max(CAST(ts AS DATE)) OVER (PARTITION BY user_id)""",
)
def win_keep_latest(t: Tables):
    rows = t.events.select("user_id", "event_id", "event_type", F.to_date("ts").alias("day"))
    return keep_latest(rows, ["user_id"], "day")


@query(
    "win_first_value",
    sql_with("bills")
    + """SELECT DISTINCT cid, first_value(num) OVER w AS num, first_value(bdate) OVER w AS bdate, first_value(status) OVER w AS status,
         first_value(priority) OVER w AS priority FROM bills WINDOW w AS (PARTITION BY cid ORDER BY summ DESC, num)""",
)
def win_first_value(t: Tables):
    return first_per_key(bills(t), ["cid"], [("summ", "desc"), ("num", "asc")], ["num", "bdate", "status", "priority"])


@query(
    "win_first_multi_key",
    sql_with("bills")
    + "SELECT DISTINCT cid, first_value(num) OVER (PARTITION BY cid ORDER BY priority, bdate DESC, num) AS card FROM bills WHERE status IN ('F', 'O')",
)
def win_first_multi_key(t: Tables):
    open_cards = bills(t).where(F.col("status").isin("F", "O")).withColumnRenamed("num", "card")
    return first_per_key(open_cards, ["cid"], [("priority", "asc"), ("bdate", "desc"), ("card", "asc")], ["card"])


@query(
    "win_latest_reason",
    sql_with("bills", r="SELECT cid, bdate, num, NULLIF(status, 'P') AS reason FROM bills")
    + "SELECT DISTINCT cid, first_value(reason) OVER (PARTITION BY cid ORDER BY bdate DESC, num) AS reason FROM r WHERE reason IS NOT NULL",
)
def win_latest_reason(t: Tables):
    refusals = bills(t).withColumn("reason", F.nullif("status", F.lit("P"))).where(F.col("reason").isNotNull())
    return first_per_key(refusals, ["cid"], [("bdate", "desc"), ("num", "asc")], ["reason"])


@query(
    "win_running_min",
    sql_with("bills", g="SELECT cid, bdate, priority FROM bills WHERE payed > 1 GROUP BY cid, bdate, priority")
    + """SELECT DISTINCT cid, min(bdate) OVER (PARTITION BY cid ORDER BY bdate, priority) AS bdate,
         first_value(priority) OVER (PARTITION BY cid ORDER BY bdate, priority) AS priority FROM g""",
)
def win_running_min(t: Tables):
    return running_first(bills(t).where(F.col("payed") > 1), ["cid"], "bdate", "priority")


@query(
    "win_row_number",
    sql_with("subs") + "SELECT id, inn, fam, row_number() OVER (PARTITION BY inn, fam ORDER BY since, id) AS s FROM subs",
)
def win_row_number(t: Tables):
    return in_sequence(subs(t), ["inn", "fam"], ["since", "id"], number="s").select("id", "inn", "fam", "s")


@query(
    "win_lead",
    sql_with("subs")
    + """SELECT id, lead(id) OVER w AS next_id, lead(priority) OVER w AS next_tariff, lead(since) OVER w AS next_since FROM subs
         WINDOW w AS (PARTITION BY inn, fam ORDER BY since, id)""",
)
def win_lead(t: Tables):
    linked = in_sequence(
        subs(t),
        ["inn", "fam"],
        ["since", "id"],
        following={"id": "next_id", "priority": "next_tariff", "since": "next_since"},
    )
    return linked.select("id", "next_id", "next_tariff", "next_since")


@query(
    "row_identity",
    sql_with("subs") + "SELECT id, inn, row_number() OVER (ORDER BY since, id) AS row_id FROM subs",
)
def identity(t: Tables):
    rows = subs(t).select("id", "inn", "since")
    return row_identity(rows, ["since", "id"]).select("id", "inn", "row_id")


MONTHS_SQL = """WITH RECURSIVE s AS (SELECT o_orderkey AS id, o_orderpriority AS model, CAST(o_orderdate AS DATE) AS since,
    CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 300 AS INTEGER) AS upto FROM orders),
  m AS (SELECT id, model, since AS month, upto FROM s
    UNION ALL SELECT id, model, CAST(month + INTERVAL 1 MONTH AS DATE), upto FROM m WHERE month < upto) """


@query("recursive_months", MONTHS_SQL + "SELECT id, model, month FROM m")
def recursive_months(t: Tables):
    return month_rows(subs(t), "since", "upto", "month").select("id", F.col("priority").alias("model"), "month")


@query("active_per_month", MONTHS_SQL + "SELECT model, month, count(*) AS n_active FROM m GROUP BY model, month")
def active_months(t: Tables):
    return active_per_month(subs(t).withColumnRenamed("priority", "model"), "model", "since", "upto")
