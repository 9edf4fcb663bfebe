"""Sources and sinks."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from billscope.catalog.base import AS_OF, EVENTS_AS_OF, Tables, query
from billscope.catalog.views import bills, lines, receipts, sql_with, tracker
from billscope.functions.dates import month_key, week_key
from billscope.functions.json import json_value
from billscope.operators.changes import only_new
from billscope.operators.windows import first_per_key
from billscope.session import cached, cut, scratch_path
from billscope.sources.readers import (
    CONTROL_CSV,
    first_candidate,
    on_days,
    period_from_path,
    read_control_csv,
    read_documents,
    typed_landing,
)
from billscope.sources.sinks import append_rows, csv_export, full_refresh


def table_name(name: str) -> str:
    """A catalog name that no other query uses."""
    return f"{name}_{uuid.uuid4().hex}"


@query("scan_ctrl_csv", "SELECT o_orderkey, o_custkey, NULLIF(o_orderstatus, 'P') AS o_orderstatus, o_orderpriority FROM orders")
def scan_ctrl_csv(t: Tables):
    root = scratch_path(t.spark, "drops")
    rows = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    kept = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    early = F.col("o_orderdate") < F.lit(AS_OF)
    rows.where(early).select(*kept).write.options(**CONTROL_CSV).csv(f"{root}/early")
    rows.where(~early).select(*kept).write.options(**CONTROL_CSV).csv(f"{root}/late")
    return read_control_csv(
        t.spark,
        [f"{root}/early", f"{root}/late"],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string",
    )


@query(
    "file_period_tag",
    """SELECT strftime(o_orderdate, '%Y') AS period, o_orderkey, o_custkey FROM orders""",
)
def file_period_tag(t: Tables):
    root = scratch_path(t.spark, "catalogs")
    named = t.orders.select("o_orderkey", "o_custkey", F.concat(F.year("o_orderdate"), F.lit("_x.csv")).alias("file"))
    named.write.partitionBy("file").options(**CONTROL_CSV).csv(root)
    rows = read_control_csv(t.spark, f"{root}/file=*_x.csv", "o_orderkey long, o_custkey long")
    return rows.select(period_from_path(r"(\d+)_x\.csv").alias("period"), "o_orderkey", "o_custkey")


@query(
    "scan_day_window",
    """SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events
       WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'""",
)
def scan_day_window(t: Tables):
    week = on_days(t.events, "ts", dt.date(2024, 1, 8), 7)
    return week.select("event_id", "user_id", "event_type", F.to_date("ts").alias("day"))


@query(
    "scan_yesterday",
    "SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' - 1",
)
def scan_yesterday(t: Tables):
    return on_days(t.events, "ts", EVENTS_AS_OF - dt.timedelta(days=1)).select("event_id", "user_id", "event_type")


@query(
    "period_keys",
    sql_with("bills")
    + """SELECT bdate, strftime(bdate, '%Y%W') AS week_key, strftime(bdate - INTERVAL 1 MONTH, '%Y%m') AS first_month,
         strftime((bdate + 6) - INTERVAL 1 MONTH, '%Y%m') AS last_month, count(*) AS n_bills FROM bills GROUP BY ALL""",
)
def period_keys(t: Tables):
    days = bills(t).groupBy("bdate").agg(F.count(F.lit(1)).alias("n_bills"))
    return days.select(
        "bdate",
        week_key(F.col("bdate")).alias("week_key"),
        month_key(F.col("bdate"), -1).alias("first_month"),
        month_key(F.date_add("bdate", 6), -1).alias("last_month"),
        "n_bills",
    )


@query(
    "scan_nested_docs",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE r_name END AS region, CASE WHEN c_acctbal < 0 THEN NULL ELSE n_name END AS city
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def scan_nested_docs(t: Tables):
    address = F.struct(F.struct(F.col("r_name").alias("Name")).alias("Region"), F.struct(F.col("n_name").alias("Name")).alias("City"))
    none = F.array().cast("array<struct<Region:struct<Name:string>,City:struct<Name:string>>>")
    located = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    path = scratch_path(t.spark, "documents")
    located.select("c_custkey", F.when(F.col("c_acctbal") < 0, none).otherwise(F.array(address)).alias("candidates")).write.json(path)
    docs = read_documents(
        t.spark, path, "c_custkey long, candidates array<struct<Region:struct<Name:string>,City:struct<Name:string>>>"
    )
    return first_candidate(docs, "candidates", "a").select(
        "c_custkey", F.col("a.Region.Name").alias("region"), F.col("a.City.Name").alias("city")
    )


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def scan_parquet(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "scan_remote_typed",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, event_type AS action, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         TRY_CAST(event_type AS INTEGER) AS not_a_number, CAST(ts AS DATE) AS event_date FROM events""",
)
def scan_remote_typed(t: Tables):
    return typed_landing(
        t.events,
        {
            "user_id": (F.col("user_id"), "string"),
            "action": (F.col("event_type"), "string"),
            "k": (json_value(F.col("props"), "k"), "int"),
            "not_a_number": (F.col("event_type"), "int"),
            "event_date": (F.col("ts"), "date"),
        },
        required=["event_date"],
        strict=["user_id"],
    )


@query("scan_table", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def scan_table(t: Tables):
    name = table_name("customer")
    full_refresh(t.customer, name, scratch_path(t.spark, "customer"))
    return t.spark.table(name).select("c_custkey", "c_name", "c_nationkey")


VALUES_SQL = "VALUES ('ECONOMY', 'cheap'), ('PROMO', 'cheap'), ('LARGE', 'bulky'), ('NONE', 'absent')"


@query(
    "values_rows",
    sql_with("lines", labels=f"SELECT * FROM ({VALUES_SQL}) AS v(cat, label)")
    + "SELECT label, count(num) AS n_lines FROM labels LEFT JOIN lines USING (cat) GROUP BY label",
)
def values_rows(t: Tables):
    labels = t.spark.sql(f"SELECT * FROM {VALUES_SQL} AS v(cat, label)")
    per_cat = lines(t).groupBy("cat").agg(F.count(F.lit(1)).alias("n"))
    return labels.join(per_cat, "cat", "left").groupBy("label").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"))


@query(
    "stage_table",
    """WITH staged AS (SELECT c_nationkey, o_orderkey, o_totalprice FROM customer JOIN orders ON c_custkey = o_custkey)
       SELECT n_name, count(*) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(19,4))) AS DOUBLE) AS total
       FROM staged JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def stage_table(t: Tables):
    staged = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"))
    return t.spark.sql(
        """WITH per_nation AS (SELECT c_nationkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(19,4))) AS total
                               FROM {staged} GROUP BY c_nationkey)
           SELECT n_name, n_orders, CAST(total AS DOUBLE) AS total
           FROM per_nation JOIN {nation} ON c_nationkey = n_nationkey""",
        staged=staged,
        nation=t.nation,
    )


@query(
    "reuse_cache",
    sql_with("bills", last="SELECT cid, max_by(num, (bdate, num)) AS last_num FROM bills GROUP BY cid")
    + """SELECT b.num, b.cid, l.last_num, m.n_clients FROM bills b LEFT JOIN last l USING (cid)
         LEFT JOIN (SELECT last_num, count(*) AS n_clients FROM last GROUP BY last_num) m ON m.last_num = b.num""",
)
def reuse_cache(t: Tables):
    rows = bills(t)
    last = first_per_key(rows, ["cid"], [("bdate", "desc"), ("num", "desc")], ["num"]).withColumnRenamed("num", "last_num")
    with cached(last):
        holders = last.groupBy("last_num").agg(F.count(F.lit(1)).alias("n_clients"))
        joined = rows.join(last, "cid", "left").join(holders.withColumnRenamed("last_num", "num"), "num", "left")
        return cut(joined.select("num", "cid", "last_num", "n_clients"), "reuse")


@query("append_rows", sql_with("bills") + "SELECT num, cid, bdate, CAST(summ AS DOUBLE) AS summ FROM bills")
def append(t: Tables):
    path = scratch_path(t.spark, "appended")
    rows = bills(t).select("num", "cid", "bdate", F.col("summ").cast("double").alias("summ"))
    append_rows(rows.where(F.col("bdate") < F.lit(AS_OF)), path)
    present = t.spark.read.schema(rows.schema).parquet(path)
    append_rows(only_new(rows, present, "num"), path)
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    "full_refresh",
    sql_with("bills") + "SELECT cid, count(*) AS n_bills, max(bdate) AS last_bill FROM bills WHERE status <> 'P' GROUP BY cid",
)
def refresh(t: Tables):
    name, folder = table_name("report"), scratch_path(t.spark, "report")
    report = lambda rows: rows.groupBy("cid").agg(F.count(F.lit(1)).alias("n_bills"), F.max("bdate").alias("last_bill"))
    full_refresh(report(bills(t)), name, folder)
    full_refresh(report(bills(t).where(F.col("status") != "P")), name, folder)
    return t.spark.table(name)


@query(
    "single_csv_export",
    sql_with("lines")
    + """SELECT shipped, 'say "' || cat || '", please' AS label, CAST(sum(cost) AS DOUBLE) AS total FROM lines GROUP BY shipped, cat""",
)
def single_csv_export(t: Tables):
    totals = lines(t).groupBy("shipped", "cat").agg(F.sum("cost").alias("total"))
    report = totals.select(
        "shipped", F.concat(F.lit('say "'), F.col("cat"), F.lit('", please')).alias("label"), F.col("total").cast("double").alias("total")
    )
    path = scratch_path(t.spark, "sales_1998-06-01.csv")
    csv_export(report, path, single_file=True)
    return t.spark.read.options(header=True, quote='"', escape='"').schema(report.schema).csv(path)


@query(
    "nested_project",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'Return' ELSE 'Sell' END AS calculation_type,
         p_name AS first_product, CAST(round(l_extendedprice * 100) AS BIGINT) AS first_sum
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def nested_project(t: Tables):
    number = F.split("content.number", "-")
    flat = receipts(t).withColumn("content", F.col("content").dropFields("client", "client_inn"))
    return flat.select(
        number[0].cast("long").alias("l_orderkey"),
        number[1].cast("int").alias("l_linenumber"),
        F.col("content.calculation_type").alias("calculation_type"),
        F.get("content.products", 0)["name"].alias("first_product"),
        F.get("content.products", 0)["sum"].alias("first_sum"),
    )


@query(
    "agg_max_by_raw_json",
    """WITH m AS (SELECT props, event_type, max(CAST(ts AS DATE)) AS day FROM events GROUP BY props, event_type)
       SELECT DISTINCT json_extract_string(props, '$.k') AS k, event_type AS action, day FROM m""",
)
def agg_max_by_raw_json(t: Tables):
    latest = tracker(t).groupBy("props", "action").agg(F.max("day").alias("day"))
    return latest.select(json_value(F.col("props"), "k").alias("k"), "action", "day").distinct()
