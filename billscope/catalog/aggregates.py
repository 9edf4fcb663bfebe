"""Aggregations, text lists, pivots, data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from billscope.catalog.base import EVENTS_AS_OF, Tables, query
from billscope.catalog.views import bills, clients, lines, sql_with, tracker
from billscope.functions.text import chop_last, first_rule
from billscope.operators.aggregates import dynamic_pivot, net_of_excluded, pivot_by_name, quoted_list, string_agg
from billscope.operators.checks import require_allowed, row_count_flag, unknown_values, unmapped_values
from billscope.sources.readers import on_days

CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def sql_pivot(fn: str, column: str, field: str, values=CATEGORIES) -> str:
    return ", ".join(f"CAST({fn}(CASE WHEN {column} = '{v}' THEN {field} END) AS DOUBLE) AS \"{v}\"" for v in values)


def as_doubles(df, columns):
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


@query(
    "agg_group_sum",
    sql_with("lines") + "SELECT supp, cat, CAST(sum(cost) AS DOUBLE) AS total, CAST(sum(CAST(qty AS DECIMAL(19,4))) AS DOUBLE) AS quantity FROM lines GROUP BY supp, cat",
)
def agg_group_sum(t: Tables):
    grouped = lines(t).groupBy("supp", "cat").agg(
        F.sum("cost").alias("total"), F.round(F.sum(F.col("qty").cast("decimal(19,4)")), 2).alias("quantity")
    )
    return as_doubles(grouped, ["total", "quantity"])


@query(
    "agg_group_max",
    """SELECT user_id, max(event_type) AS event_type, max(props) AS props, max(value) AS value, max(CAST(ts AS DATE)) AS day FROM events GROUP BY user_id""",
)
def agg_group_max(t: Tables):
    values = {"event_type": F.col("event_type"), "props": F.col("props"), "value": F.col("value"), "day": F.to_date("ts")}
    return t.events.groupBy("user_id").agg(*[F.max(v).alias(n) for n, v in values.items()])


@query(
    "agg_wide_key",
    sql_with("bills", "lines")
    + """SELECT num, cid, bdate, b.status, b.priority, NULLIF(flag, 'R') AS flag, line_status, string_agg(cat, '; ' ORDER BY cat) AS tariffs,
         CAST(sum(cost) AS DOUBLE) AS total FROM bills b JOIN lines USING (num) GROUP BY num, cid, bdate, b.status, b.priority, NULLIF(flag, 'R'), line_status""",
)
def agg_wide_key(t: Tables):
    rows = bills(t).join(lines(t), "num").withColumn("flag", F.nullif("flag", F.lit("R")))
    keys = ["num", "cid", "bdate", "status", "priority", "flag", "line_status"]
    return as_doubles(string_agg(rows, keys, "cat", "; ", "tariffs", sums={"cost": "total"}), ["total"])


@query("agg_count", "SELECT l_suppkey AS supp, count(*) AS n_rows, count(NULLIF(l_returnflag, 'R')) AS n_kept FROM lineitem GROUP BY l_suppkey")
def agg_count(t: Tables):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("supp")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.nullif("l_returnflag", F.lit("R"))).alias("n_kept")
    )


@query(
    "agg_count_distinct",
    "SELECT l_suppkey AS supp, CAST(count(DISTINCT l_partkey) AS INTEGER) AS distribution FROM lineitem GROUP BY l_suppkey",
)
def agg_count_distinct(t: Tables):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("supp")).agg(F.countDistinct("l_partkey").cast("int").alias("distribution"))


@query(
    "scalar_subquery",
    sql_with("bills") + """SELECT num, CAST(summ AS DOUBLE) AS summ, (SELECT count(*) FROM bills WHERE bdate = DATE '1998-05-31') AS n_yesterday
      FROM bills WHERE summ > (SELECT max(summ) - 5000 FROM bills WHERE status = 'F')""",
)
def scalar_subquery(t: Tables):
    rows = bills(t)
    bound = rows.where(F.col("status") == "F").agg(F.max("summ") - 5000).scalar()
    yesterday = rows.where(F.col("bdate") == F.lit("1998-05-31").cast("date")).agg(F.count(F.lit(1))).scalar()
    return rows.where(F.col("summ") > bound).select("num", F.col("summ").cast("double").alias("summ"), yesterday.alias("n_yesterday"))


@query(
    "agg_having",
    sql_with("bills")
    + """SELECT cid, count(DISTINCT priority) AS n_priorities, CAST(sum(payed) AS DOUBLE) AS payed FROM bills GROUP BY cid
         HAVING count(DISTINCT priority) > 1 AND round(sum(payed), 0) > 1000000""",
)
def agg_having(t: Tables):
    grouped = bills(t).groupBy("cid").agg(F.countDistinct("priority").alias("n_priorities"), F.sum("payed").alias("payed"))
    return as_doubles(grouped.where((F.col("n_priorities") > 1) & (F.round("payed", 0) > 1000000)), ["payed"])


@query(
    "agg_string",
    sql_with("lines") + "SELECT num, string_agg(NULLIF(cat, 'PROMO'), '; ' ORDER BY cat) AS cats FROM lines GROUP BY num",
)
def agg_string(t: Tables):
    return string_agg(lines(t).withColumn("cat", F.nullif("cat", F.lit("PROMO"))), ["num"], "cat", "; ", "cats")


@query(
    "agg_concat_variable",
    """SELECT string_agg('[' || p_type || ']', ',' ORDER BY p_type) AS cols, left(string_agg(p_type || ',', '' ORDER BY p_type), -1) AS chopped
       FROM (SELECT DISTINCT p_type FROM part)""",
)
def agg_concat_variable(t: Tables):
    cols = quoted_list(t.part, "p_type", "cols")
    trailing = string_agg(t.part.select(F.concat("p_type", F.lit(",")).alias("v")).distinct(), [], "v", "", "v")
    return cols.select("cols", chop_last(trailing.scalar()).alias("chopped"))


@query(
    "agg_net_sum",
    sql_with("bills", "lines", j="SELECT num, summ, cat, cost FROM lines JOIN bills USING (num)")
    + "SELECT num, CAST(summ - sum(cost) AS DOUBLE) AS pure_summ FROM j WHERE cat IN (SELECT DISTINCT p_type FROM part WHERE p_size < 3 AND p_type LIKE '%M%') GROUP BY num, summ",
)
def agg_net_sum(t: Tables):
    excluded = t.part.where((F.col("p_size") < 3) & F.col("p_type").like("%M%")).select(F.col("p_type").alias("cat"))
    rows = lines(t).join(bills(t).select("num", "summ"), "num")
    net = net_of_excluded(rows, excluded, "num", "summ", "cat", "cost", "pure_summ")
    return net.select("num", F.col("pure_summ").cast("double").alias("pure_summ"))


@query(
    "agg_coalesce_group",
    sql_with("bills", "clients")
    + """SELECT inn, manager, coalesce(string_agg(priority, ', ' ORDER BY priority), 'none') AS segment
         FROM clients LEFT JOIN bills ON cid = inn AND summ > 300000 GROUP BY inn, manager""",
)
def agg_coalesce_group(t: Tables):
    big = bills(t).where(F.col("summ") > 300000).select(F.col("cid").alias("inn"), "priority")
    joined = clients(t).select("inn", "manager").join(big, "inn", "left")
    return string_agg(joined, ["inn", "manager"], "priority", ", ", "segment").withColumn("segment", F.coalesce("segment", F.lit("none")))


@query("pivot_static", sql_with("lines") + f"SELECT num, {sql_pivot('sum', 'cat', 'cost')} FROM lines GROUP BY num")
def pivot_static(t: Tables):
    return as_doubles(pivot_by_name(lines(t), ["num"], "cat", CATEGORIES, "cost"), CATEGORIES)


@query("pivot_dynamic", sql_with("lines") + f"SELECT shipped, {sql_pivot('max', 'cat', 'cost')} FROM lines GROUP BY shipped")
def pivot_dynamic(t: Tables):
    wide = dynamic_pivot(lines(t), ["shipped"], "cat", "cost", "max")
    return as_doubles(wide, [c for c in wide.columns if c != "shipped"])


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query("pivot_param", sql_with("bills") + f"SELECT cid, status, {sql_pivot('sum', 'priority', 'summ', PRIORITIES)} FROM bills GROUP BY cid, status")
def pivot_param(t: Tables):
    wide = dynamic_pivot(bills(t), ["cid", "status"], "priority", "summ")
    return as_doubles(wide, PRIORITIES)


RENAMES = ((("%large%", "medium%"), "SIZED"), (("STAND%",), "BASIC"))


@query(
    "chk_allowed_values",
    """WITH r AS (SELECT p_partkey, CASE WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'SIZED' WHEN p_type = 'STANDARD' THEN 'BASIC' ELSE p_type END AS cat FROM part)
       SELECT cat, count(*) AS n_parts, (SELECT count(DISTINCT cat) FROM r WHERE cat NOT IN ('SIZED', 'BASIC')) AS n_unknown FROM r GROUP BY cat""",
)
def chk_allowed_values(t: Tables):
    named = t.part.select(first_rule(F.col("p_type"), RENAMES, F.col("p_type")).alias("cat"))
    checked = require_allowed(named, "cat", ["SIZED", "BASIC", "ECONOMY", "PROMO", "SMALL"])
    unknown = unknown_values(named, "cat", ["SIZED", "BASIC"]).scalar()
    return checked.groupBy("cat").agg(F.count(F.lit(1)).alias("n_parts")).select("cat", "n_parts", unknown.alias("n_unknown"))


@query(
    "chk_unmapped",
    """SELECT action AS unmapped FROM (SELECT DISTINCT event_type AS action FROM events
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE lower(right(o_orderpriority, 3)) = right(event_type, 3)))""",
)
def chk_unmapped(t: Tables):
    used = tracker(t).select("action", F.right("action", F.lit(3)).alias("tail")).distinct()
    known = t.orders.select(F.lower(F.right("o_orderpriority", F.lit(3))).alias("tail"))
    mapped = used.join(known.distinct(), "tail", "left_semi").select("action")
    return unmapped_values(used, "action", mapped)


@query(
    "chk_empty_input",
    """SELECT count(*) AS n_rows, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS nothing_to_load FROM events
       WHERE event_type = 'signup' AND CAST(ts AS DATE) = DATE '2024-01-14' AND value < 0""",
)
def chk_empty_input(t: Tables):
    yesterday = on_days(t.events, "ts", EVENTS_AS_OF.replace(day=14))
    return row_count_flag(yesterday.where((F.col("event_type") == "signup") & (F.col("value") < 0)))


@query(
    "load_summary",
    """WITH y AS (SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-14')
       SELECT count(*) AS n_created, count(DISTINCT user_id) AS n_users,
         coalesce((SELECT string_agg('https://example.org/cards/' || user_id, ' <br> ' ORDER BY 'https://example.org/cards/' || user_id)
                   FROM y WHERE event_type = 'purchase' AND value > 30), 'no cards') AS cards FROM y""",
)
def load_summary(t: Tables):
    yesterday = on_days(t.events, "ts", EVENTS_AS_OF.replace(day=14))
    cards = yesterday.where((F.col("event_type") == "purchase") & (F.col("value") > 30)).select(
        F.concat(F.lit("https://example.org/cards/"), F.col("user_id").cast("string")).alias("url")
    )
    links = string_agg(cards, [], "url", " <br> ", "links").scalar()
    counts = yesterday.agg(F.count(F.lit(1)).alias("n_created"), F.countDistinct("user_id").alias("n_users"))
    return counts.select("n_created", "n_users", F.coalesce(links, F.lit("no cards")).alias("cards"))
