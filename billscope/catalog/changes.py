"""Table changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from billscope.catalog.base import AS_OF, Tables, query
from billscope.catalog.views import bills, lines, sql_with
from billscope.functions.text import matches_any, next_list_number, padded_number, stable_uuid
from billscope.functions.values import differs_or_missing
from billscope.operators.aggregates import pivot_by_name
from billscope.operators.changes import (
    delete_groups,
    delete_matching,
    delete_where,
    only_new,
    outbox,
    update_from,
    update_where_exists,
)
from billscope.operators.joins import exists_from_date


@query(
    "upd_rules",
    """WITH a AS (SELECT p_partkey, CASE WHEN p_name ILIKE '%bolt%' OR p_name ILIKE 'HOT%' THEN 'inner' ELSE p_name END AS n FROM part),
         b AS (SELECT p_partkey, CASE WHEN n ILIKE 'old%' THEN 'used' ELSE n END AS n FROM a),
         c AS (SELECT p_partkey, CASE WHEN n ILIKE 'use%' THEN 'worn' ELSE n END AS n FROM b)
       SELECT p_partkey, n AS name FROM c""",
)
def upd_rules(t: Tables):
    rows = t.part.select("p_partkey", F.col("p_name").alias("name"))
    # the third rule sees what the second has written, so they are applied one after the other
    for patterns, label in ((("%bolt%", "HOT%"), "inner"), (("old%",), "used"), (("use%",), "worn")):
        rows = rows.withColumn("name", F.when(matches_any(F.col("name"), patterns), label).otherwise(F.col("name")))
    return rows


@query(
    "upd_from_join",
    """WITH u AS (SELECT o_custkey AS inn, max(o_orderpriority) AS seg FROM orders WHERE o_totalprice > 250000 GROUP BY o_custkey),
         c AS (SELECT c_custkey AS inn, c_name, CASE WHEN c_acctbal < 1000 THEN NULL WHEN c_acctbal < 5000 THEN '5-LOW' ELSE c_mktsegment END AS segment FROM customer)
       SELECT c.inn, c.c_name AS name, CASE WHEN u.seg IS NOT NULL AND (c.segment <> u.seg OR c.segment IS NULL) AND u.seg <> '4-NOT SPECIFIED' THEN u.seg ELSE c.segment END AS segment
       FROM c LEFT JOIN u USING (inn)""",
)
def upd_from_join(t: Tables):
    old = F.when(F.col("c_acctbal") < 1000, None).when(F.col("c_acctbal") < 5000, "5-LOW").otherwise(F.col("c_mktsegment"))
    table = t.customer.select(F.col("c_custkey").alias("inn"), F.col("c_name").alias("name"), old.alias("segment"))
    news = t.orders.where(F.col("o_totalprice") > 250000).groupBy(F.col("o_custkey").alias("inn")).agg(F.max("o_orderpriority").alias("seg"))
    guard = lambda new: differs_or_missing(F.col("segment"), new["seg"]) & (new["seg"] != "4-NOT SPECIFIED")
    return update_from(table, news, "inn", {"segment": "seg"}, guard)


@query(
    "upd_if_exists",
    sql_with("bills", c="""SELECT c_custkey AS cid, CAST(DATE '1998-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS DATE) AS loaded,
        CASE WHEN c_acctbal < 0 THEN 0 END AS paid_bill FROM customer""")
    + """SELECT cid, loaded, CASE WHEN paid_bill IS NULL AND EXISTS (SELECT 1 FROM bills b WHERE b.cid = c.cid AND payed > 0 AND bdate >= loaded) THEN 1
         ELSE paid_bill END AS paid_bill FROM c""",
)
def upd_if_exists(t: Tables):
    loaded = F.date_add(F.lit("1998-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    table = t.customer.select(F.col("c_custkey").alias("cid"), loaded.alias("loaded"), F.when(F.col("c_acctbal") < 0, 0).alias("paid_bill"))
    paying = exists_from_date(table, bills(t), "cid", "loaded", "bdate", F.col("payed") > 0)
    return update_where_exists(table, paying, "cid", "paid_bill", F.lit(1), F.col("paid_bill").isNull())


@query(
    "upd_in_subquery",
    sql_with("bills", "lines")
    + """SELECT num, cid, CASE WHEN num IN (SELECT b.num FROM bills b JOIN lines USING (num) WHERE status = 'F' AND cost > 90000) THEN 'renewal' ELSE status END AS status FROM bills""",
)
def upd_in_subquery(t: Tables):
    table = bills(t).select("num", "cid", "status")
    costly = lines(t).where(F.col("cost") > 90000).select("num")
    return update_where_exists(table, costly, "num", "status", F.lit("renewal"), F.col("status") == "F")


def sql_uuid(text: str) -> str:
    digest = f"sha256({text})"
    return " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


@query(
    "upd_all_generated",
    f"""SELECT c_custkey AS inn, {sql_uuid("'client|' || c_custkey")} AS client_id, {sql_uuid("'lead|' || c_custkey")} AS create_pp_id FROM customer""",
)
def upd_all_generated(t: Tables):
    inn = F.col("c_custkey")
    return t.customer.select(
        inn.alias("inn"), stable_uuid(F.lit("client"), inn).alias("client_id"), stable_uuid(F.lit("lead"), inn).alias("create_pp_id")
    )


@query(
    "del_exists",
    sql_with("bills") + "SELECT c_custkey AS cid, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM bills WHERE cid = c_custkey AND summ = payed AND bdate > DATE '1998-06-01' - INTERVAL 1 YEAR)",
)
def del_exists(t: Tables):
    paid = bills(t).where((F.col("summ") == F.col("payed")) & (F.col("bdate") > F.add_months(F.lit(AS_OF), -12))).select("cid")
    return delete_matching(t.customer.select(F.col("c_custkey").alias("cid"), "c_name"), paid, "cid")


@query(
    "del_in_cond",
    sql_with("bills", d="SELECT cid FROM bills GROUP BY cid HAVING count(DISTINCT status) > 2", b="SELECT num, cid, NULLIF(status, 'O') AS status, priority FROM bills")
    + "SELECT num, cid, status, priority FROM b WHERE NOT (cid IN (SELECT cid FROM d) AND coalesce(status <> 'F', FALSE))",
)
def del_in_cond(t: Tables):
    rows = bills(t)
    several = rows.groupBy("cid").agg(F.countDistinct("status").alias("n")).where(F.col("n") > 2).select("cid", F.lit(True).alias("several"))
    table = rows.select("num", "cid", F.nullif("status", F.lit("O")).alias("status"), "priority").join(several, "cid", "left")
    # an unknown status is no reason to delete
    kept = delete_where(table, F.col("several") & (F.col("status") != "F"))
    return kept.select("num", "cid", "status", "priority")


@query(
    "del_having",
    sql_with("bills", "lines", f="SELECT num, CASE WHEN flag = 'R' THEN 0 ELSE cost END AS payed, cost FROM lines")
    + """SELECT num, cid, CAST(summ AS DOUBLE) AS summ FROM bills WHERE num NOT IN (SELECT num FROM f GROUP BY num
         HAVING sum(payed) = 0 OR (round(sum(payed), 0) < round(sum(cost), 0) AND sum(payed) > 0))""",
)
def del_having(t: Tables):
    payments = lines(t).select("num", "cost", F.when(F.col("flag") == "R", 0).otherwise(F.col("cost")).alias("payed"))
    refunded = (F.col("payed") == 0) | ((F.round("payed", 0) < F.round("recorded", 0)) & (F.col("payed") > 0))
    kept = delete_groups(bills(t), payments, "num", refunded, payed=F.sum("payed"), recorded=F.sum("cost"))
    return kept.select("num", "cid", F.col("summ").cast("double").alias("summ"))


SIZES = ["LARGE", "MEDIUM", "SMALL", "TINY"]


@query(
    "del_sentinel",
    sql_with("lines")
    + """SELECT supp, CAST(sum(CASE WHEN cat = 'LARGE' THEN cost END) AS DOUBLE) AS "LARGE", CAST(sum(CASE WHEN cat = 'MEDIUM' THEN cost END) AS DOUBLE) AS "MEDIUM",
         CAST(sum(CASE WHEN cat = 'SMALL' THEN cost END) AS DOUBLE) AS "SMALL", CAST(NULL AS DOUBLE) AS "TINY" FROM lines GROUP BY supp""",
)
def del_sentinel(t: Tables):
    """A declared column list yields columns for absent values too, so no helper rows come in or go out."""
    wide = pivot_by_name(lines(t), ["supp"], "cat", SIZES, "cost")
    return wide.select("supp", *[F.col(c).cast("double").alias(c) for c in SIZES])


@query(
    "insert_new_only",
    sql_with("bills") + "SELECT num, cid, CASE WHEN bdate < DATE '1998-06-01' THEN 'old' ELSE 'new' END AS origin FROM bills",
)
def insert_new_only(t: Tables):
    rows = bills(t).select("num", "cid", "bdate")
    target = rows.where(F.col("bdate") < F.lit(AS_OF)).select("num", "cid", F.lit("old").alias("origin"))
    return target.unionByName(only_new(rows.select("num", "cid", F.lit("new").alias("origin")), target, "num"))


@query(
    "outbox_state",
    sql_with("bills", k="SELECT CASE WHEN length(CAST(cid AS VARCHAR)) >= 5 THEN CAST(cid AS VARCHAR) ELSE lpad(CAST(cid AS VARCHAR), 5, '0') END || '_List' AS brief FROM bills WHERE status = 'F'")
    + f"""SELECT {sql_uuid("'task|1998-06-01'")} AS task_id, (SELECT CASE WHEN length(CAST(max(CAST(regexp_extract(brief, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR)) >= 5 THEN CAST(max(CAST(regexp_extract(brief, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR) ELSE lpad(CAST(max(CAST(regexp_extract(brief, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR), 5, '0') END FROM k) || '_List' AS list_id,
         1 AS state_id, 50 AS priority, count(*) AS n_comments FROM bills WHERE status = 'O'""",
)
def outbox_state(t: Tables):
    rows = bills(t)
    briefs = rows.where(F.col("status") == "F").select(
        F.concat(padded_number(F.col("cid")), F.lit("_List")).alias("brief")
    )
    number = briefs.select(next_list_number(F.col("brief"), "_List")).scalar()
    task = {"task_id": stable_uuid(F.lit("task"), F.lit("1998-06-01")), "list_id": number}
    header, body = outbox(rows.where(F.col("status") == "O").select("num", "cid"), task, 50)
    n_comments = body.agg(F.count(F.lit(1))).scalar()
    return header.withColumn("n_comments", n_comments)
