"""The driver tables in the shape the operators work on, for Spark and, as SQL text, for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope.catalog.base import Tables
from billscope.functions.values import money

SQL_VIEWS = {
    "bills": """SELECT o_orderkey AS num, o_custkey AS cid, CAST(o_orderdate AS DATE) AS bdate,
        CAST(o_totalprice AS DECIMAL(19,4)) AS summ,
        CAST(CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN o_totalprice / 2 ELSE 0 END AS DECIMAL(19,4)) AS payed,
        o_orderstatus AS status, o_orderpriority AS priority FROM orders""",
    "lines": """SELECT l_orderkey AS num, l_partkey AS part, l_linenumber AS line, l_suppkey AS supp,
        l_quantity AS qty, CAST(l_extendedprice AS DECIMAL(19,4)) AS cost, p_type AS cat, p_name AS txt,
        p_brand AS brand, l_returnflag AS flag, l_linestatus AS line_status, CAST(l_shipdate AS DATE) AS shipped
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "clients": "SELECT c_custkey AS inn, c_name AS name, c_mktsegment AS manager, c_nationkey AS nation FROM customer",
    "subs": """SELECT o_orderkey AS id, o_custkey AS inn, CAST(o_orderdate AS DATE) AS since,
        CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 300 AS INTEGER) AS upto,
        CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'base' WHEN o_orderpriority = '3-MEDIUM' THEN 'module' END AS fam,
        o_orderpriority AS priority, CAST(o_totalprice AS DECIMAL(19,4)) AS summ FROM orders""",
    "tracker": """SELECT event_id, user_id, event_type AS action, CAST(ts AS DATE) AS day, value, props FROM events""",
}


def sql_with(*names: str, **more: str) -> str:
    """``WITH`` clause over the named views and any further ones."""
    parts = [f"{n} AS ({SQL_VIEWS[n]})" for n in names] + [f"{n} AS ({body})" for n, body in more.items()]
    return "WITH " + ", ".join(parts) + " "


def bills(t: Tables) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    payed = F.when(status == "F", price).when(status == "P", price / 2).otherwise(F.lit(0.0))
    return t.orders.select(
        F.col("o_orderkey").alias("num"),
        F.col("o_custkey").alias("cid"),
        F.to_date("o_orderdate").alias("bdate"),
        money(price).alias("summ"),
        money(payed).alias("payed"),
        status.alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def lines(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("num"),
        F.col("l_partkey").alias("part"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("supp"),
        F.col("l_quantity").alias("qty"),
        money(F.col("l_extendedprice")).alias("cost"),
        F.col("p_type").alias("cat"),
        F.col("p_name").alias("txt"),
        F.col("p_brand").alias("brand"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("line_status"),
        F.to_date("l_shipdate").alias("shipped"),
    )


def clients(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("inn"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("manager"),
        F.col("c_nationkey").alias("nation"),
    )


def subs(t: Tables) -> DataFrame:
    since = F.to_date("o_orderdate")
    priority = F.col("o_orderpriority")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("inn"),
        since.alias("since"),
        F.date_add(since, (F.lit(30) + F.col("o_orderkey") % 300).cast("int")).alias("upto"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "base").when(priority == "3-MEDIUM", "module").alias("fam"),
        priority.alias("priority"),
        money(F.col("o_totalprice")).alias("summ"),
    )


def tracker(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", "user_id", F.col("event_type").alias("action"), F.to_date("ts").alias("day"), "value", "props"
    )


def receipts(t: Tables) -> DataFrame:
    """Nested receipts, built row by row: a line with its part and, where taxed, a service product."""
    cents = lambda amount: F.round(amount * 100).cast("long")
    product = lambda name, total, quantity: F.struct(
        name.alias("name"), cents(total).alias("sum"), quantity.cast("double").alias("quantity")
    )
    goods = product(F.col("p_name"), F.col("l_extendedprice"), F.col("l_quantity"))
    service = product(F.concat(F.lit("service "), F.col("p_name")), F.col("l_quantity") * 5, F.lit(1))
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.to_date("l_shipdate").alias("date"),
        F.lit("Receipt").alias("type"),
        F.col("l_suppkey").alias("cashbox_number"),
        F.struct(
            F.when(F.col("l_returnflag") == "R", "Return").otherwise("Sell").alias("calculation_type"),
            F.col("l_shipdate").alias("timestamp"),
            F.col("l_suppkey").alias("cashbox_number"),
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string")).alias("number"),
            F.col("l_linestatus").alias("client"),
            F.col("l_suppkey").cast("string").alias("client_inn"),
            F.when(F.col("l_tax") > 0, F.array(goods, service)).otherwise(F.array(goods)).alias("products"),
        ).alias("content"),
    )
