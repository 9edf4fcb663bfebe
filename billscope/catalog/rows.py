"""Projection, filters and predicates, sorting and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from billscope.catalog.base import AS_OF, EVENTS_AS_OF, Tables, query
from billscope.catalog.views import bills, sql_with, subs
from billscope.functions.text import matches_any
from billscope.operators.changes import override
from billscope.operators.joins import exists_from_date


@query(
    "project_alias",
    """SELECT o_orderkey AS num, o_custkey AS client, o_orderstatus AS status, '1' AS is_current, 8 AS task_type,
         CAST(NULL AS DATE) AS load_date, CAST(NULL AS VARCHAR) AS external_id FROM orders""",
)
def project_alias(t: Tables):
    return t.orders.select(
        F.col("o_orderkey").alias("num"),
        F.col("o_custkey").alias("client"),
        F.col("o_orderstatus").alias("status"),
        F.lit("1").alias("is_current"),
        F.lit(8).alias("task_type"),
        F.lit(None).cast("date").alias("load_date"),
        F.lit(None).cast("string").alias("external_id"),
    )


@query("filter_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 50000 AND 100000")
def filter_range(t: Tables):
    return t.orders.where(F.col("o_totalprice").between(50000, 100000)).select("o_orderkey", "o_totalprice")


@query(
    "filter_in_force",
    sql_with("subs")
    + """SELECT DISTINCT id, inn, since, upto, '1' AS current FROM subs WHERE DATE '1998-06-01' BETWEEN since AND upto
         UNION SELECT id, inn, since, upto, '0' AS current FROM subs WHERE since > DATE '1998-06-01'""",
)
def filter_in_force(t: Tables):
    day = F.lit(AS_OF)
    label = F.when(day.between(F.col("since"), F.col("upto")), "1").when(F.col("since") > day, "0")
    rows = subs(t).select("id", "inn", "since", "upto", label.alias("current"))
    return rows.where(F.col("current").isNotNull()).distinct()


@query(
    "filter_like_any",
    """SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'RED%' OR p_name ILIKE '%Bolt%' OR p_name ILIKE 'ol_ gear'""",
)
def filter_like_any(t: Tables):
    return t.part.where(matches_any(F.col("p_name"), ["RED%", "%Bolt%", "ol_ gear"])).select("p_partkey", "p_name")


@query(
    "filter_in_list",
    """SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('P')""",
)
def filter_in_list(t: Tables):
    kept = F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & ~F.col("o_orderstatus").isin("P")
    return t.orders.where(kept).select("o_orderkey", "o_orderpriority")


@query(
    "filter_null_guard",
    """WITH r AS (SELECT o_orderkey, NULLIF(o_orderstatus, 'P') AS status, CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS priority FROM orders)
       SELECT o_orderkey, status, priority FROM r WHERE status IS NOT NULL AND priority <> ''
       UNION ALL SELECT o_orderkey, status, priority FROM r WHERE status IS NULL AND priority = ''""",
)
def filter_null_guard(t: Tables):
    rows = t.orders.select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "").otherwise(F.col("o_orderpriority")).alias("priority"),
    )
    filled = F.col("status").isNotNull() & (F.col("priority") != "")
    return rows.where(filled | (F.col("status").isNull() & (F.col("priority") == "")))


@query(
    "filter_regex_flag",
    """SELECT p_partkey, CASE WHEN regexp_matches(p_name, 'r[eo]d') AND regexp_matches(p_name, 'ring|bolt') THEN 'both' ELSE 'first' END AS label
       FROM part WHERE regexp_matches(p_name, 'r[eo]d') AND NOT regexp_matches(p_name, 'gizmo$')""",
)
def filter_regex_flag(t: Tables):
    name = F.col("p_name")
    label = F.when(name.rlike("r[eo]d") & name.rlike("ring|bolt"), "both").otherwise("first")
    return t.part.where(name.rlike("r[eo]d") & ~name.rlike("gizmo$")).select("p_partkey", label.alias("label"))


@query(
    "filter_event",
    """SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events
       WHERE event_type = 'signup' AND value > 1 AND CAST(ts AS DATE) < DATE '2024-01-15'""",
)
def filter_event(t: Tables):
    before = t.events.where(F.col("ts") < F.lit(EVENTS_AS_OF))
    return before.where((F.col("event_type") == "signup") & (F.col("value") > 1)).select(
        "event_id", "user_id", F.to_date("ts").alias("day")
    )


@query(
    "filter_prefix_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS from_time FROM events WHERE strftime(ts, '%Y-%m-%dT%H:%M:%S') <= '2024-01-15'",
)
def filter_prefix_time(t: Tables):
    docs = t.events.select("event_id", F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("from_time")).alias("id"))
    return docs.where(F.col("id.from_time") <= "2024-01-15").select("event_id", F.col("id.from_time").alias("from_time"))


@query(
    "filter_correlated_date",
    sql_with("bills", c="SELECT c_custkey AS cid, CAST(DATE '1999-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS loaded FROM customer")
    + "SELECT cid, loaded FROM c WHERE EXISTS (SELECT 1 FROM bills b WHERE b.cid = c.cid AND b.payed > 0 AND b.bdate >= c.loaded)",
)
def filter_correlated_date(t: Tables):
    loaded = F.date_add(F.lit(dt.date(1999, 1, 1)), (F.col("c_custkey") % 1000).cast("int"))
    clients = t.customer.select(F.col("c_custkey").alias("cid"), loaded.alias("loaded"))
    return exists_from_date(clients, bills(t), "cid", "loaded", "bdate", F.col("payed") > 0)


@query("sort_rows", sql_with("bills") + "SELECT cid, num, bdate, year(bdate)::INTEGER AS y FROM bills ORDER BY year(bdate), month(bdate) DESC, num")
def sort_rows(t: Tables):
    rows = bills(t).select("cid", "num", "bdate", F.year("bdate").alias("y"))
    return rows.orderBy(F.year("bdate"), F.month("bdate").desc(), "num")


@query(
    "union_distinct",
    "SELECT o_custkey AS id, o_orderstatus AS tag FROM orders UNION SELECT l_suppkey, l_linestatus FROM lineitem",
)
def union_distinct(t: Tables):
    first = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("tag"))
    second = t.lineitem.select(F.col("l_suppkey").alias("id"), F.col("l_linestatus").alias("tag"))
    return first.unionByName(second).distinct()


@query(
    "union_all",
    "SELECT o_custkey AS id, o_orderstatus AS tag FROM orders UNION ALL SELECT l_suppkey, l_linestatus FROM lineitem",
)
def union_all(t: Tables):
    first = t.orders.select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("tag"))
    return first.unionByName(t.lineitem.select(F.col("l_linestatus").alias("tag"), F.col("l_suppkey").alias("id")))


@query(
    "override_union",
    sql_with("bills", r="SELECT cid, 'rolled' AS kind, CAST(sum(summ) AS DOUBLE) AS total FROM bills WHERE status = 'F' GROUP BY cid")
    + """SELECT * FROM r UNION SELECT cid, status AS kind, CAST(summ AS DOUBLE) AS total FROM bills WHERE cid NOT IN (SELECT cid FROM r)""",
)
def override_union(t: Tables):
    rows = bills(t)
    replacement = rows.where(F.col("status") == "F").groupBy("cid").agg(F.sum("summ").cast("double").alias("total"))
    base = rows.select("cid", F.col("status").alias("kind"), F.col("summ").cast("double").alias("total"))
    return override(base, replacement.withColumn("kind", F.lit("rolled")).select("cid", "kind", "total"), "cid")


@query("distinct_rows", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def distinct_rows(t: Tables):
    return t.events.select("user_id", "event_type", F.to_date("ts").alias("day")).distinct()


@query(
    "dedupe_by_key",
    "SELECT l_orderkey || '_' || l_linenumber AS receipt, min(l_partkey) AS part FROM lineitem GROUP BY ALL",
)
def dedupe_by_key(t: Tables):
    # which row survives a plain dropDuplicates is open, so the smallest part is chosen
    key = F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part")).select(key.alias("receipt"), "part")

