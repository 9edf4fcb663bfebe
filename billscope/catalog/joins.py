"""Joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from billscope.catalog.base import AS_OF, Tables, query
from billscope.catalog.views import sql_with, subs
from billscope.functions.values import not_below_zero
from billscope.operators.address import attribute_matches, exact_matches
from billscope.operators.aggregates import string_agg
from billscope.operators.dictionary import tag_matches
from billscope.operators.joins import add_lookup, add_presence, distinct_join, exists_in, not_exists_in, not_in
from billscope.operators.windows import in_sequence

CHAIN_SQL = """SELECT c_name, s_name || ' ' || n_name AS supplier_nation
  FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE c_mktsegment = 'BUILDING' AND c_nationkey = s_nationkey AND l_returnflag = 'A'"""


@query("join_inner_chain", CHAIN_SQL)
def join_inner_chain(t: Tables):
    customers = t.customer.where(F.col("c_mktsegment") == "BUILDING").withColumnRenamed("c_custkey", "o_custkey")
    items = t.lineitem.where(F.col("l_returnflag") == "A")
    return (
        customers.join(t.orders, "o_custkey")
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(t.supplier, (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")))
        .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("c_name", F.concat("s_name", F.lit(" "), "n_name").alias("supplier_nation"))
    )


@query(
    "join_comma",
    """SELECT c_custkey, o_orderkey FROM customer, orders WHERE o_custkey = c_custkey AND o_totalprice BETWEEN 50000 AND 100000""",
)
def join_comma(t: Tables):
    t.customer.createOrReplaceTempView("billscope_comma_customer")
    t.orders.createOrReplaceTempView("billscope_comma_orders")
    return t.spark.sql(
        """SELECT c_custkey, o_orderkey FROM billscope_comma_customer, billscope_comma_orders
           WHERE o_custkey = c_custkey AND o_totalprice BETWEEN 50000 AND 100000"""
    )


@query(
    "join_using_distinct",
    """SELECT DISTINCT c_name, c_mktsegment FROM customer, orders WHERE o_custkey = c_custkey AND o_totalprice BETWEEN 50000 AND 100000""",
)
def join_using_distinct(t: Tables):
    priced = t.orders.where(F.col("o_totalprice").between(50000, 100000)).select(F.col("o_custkey").alias("c_custkey"))
    return distinct_join(t.customer, priced, "c_custkey", ["c_name", "c_mktsegment"])


@query(
    "join_left_residual",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
       AND o_orderdate > TIMESTAMP '2000-01-01'""",
)
def join_left_residual(t: Tables):
    valid = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") > F.lit("2000-01-01").cast("date"))
    return t.customer.join(t.orders, (F.col("c_custkey") == F.col("o_custkey")) & valid, "left").select("c_custkey", "o_orderkey")


@query(
    "join_left_flag",
    """SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 1 ELSE 0 END AS enter
       FROM customer""",
)
def join_left_flag(t: Tables):
    seen = t.orders.where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return add_presence(t.customer.select("c_custkey"), seen, "c_custkey", "enter")


@query(
    "join_left_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, n_name AS city FROM lineitem
       LEFT JOIN (SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 0) ON l_suppkey = s_suppkey""",
)
def join_left_lookup(t: Tables):
    places = t.supplier.where(F.col("s_acctbal") > 0).join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    address = places.select(F.col("s_suppkey").alias("cashbox"), F.struct(F.col("n_name").alias("city")).alias("address"))
    lines_ = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("cashbox"))
    return add_lookup(lines_, address, "cashbox").select("l_orderkey", "l_linenumber", "l_partkey", F.col("address.city").alias("city"))


@query(
    "join_lower_key",
    """WITH d AS (SELECT upper(p_name) AS item, min(p_partkey) AS sku FROM part GROUP BY 1)
       SELECT l_orderkey, l_linenumber, l_partkey, sku FROM lineitem JOIN part ON l_partkey = p_partkey JOIN d ON lower(p_name) = lower(item)""",
)
def join_lower_key(t: Tables):
    items = t.part.groupBy(F.upper("p_name").alias("item")).agg(F.min("p_partkey").alias("sku"))
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return named.join(items, F.lower("p_name") == F.lower("item")).select("l_orderkey", "l_linenumber", "l_partkey", "sku")


@query(
    "semi_exists",
    """SELECT c_name, c_mktsegment FROM customer WHERE EXISTS (SELECT 1 FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       WHERE o_custkey = c_custkey AND o_totalprice BETWEEN 50000 AND 100000 AND l_returnflag = 'R')""",
)
def semi_exists(t: Tables):
    priced = t.orders.where(F.col("o_totalprice").between(50000, 100000)).select(F.col("o_custkey").alias("c_custkey"), "o_orderkey")
    returned = t.lineitem.where(F.col("l_returnflag") == "R").select(F.col("l_orderkey").alias("o_orderkey"))
    return exists_in(t.customer, exists_in(priced, returned, "o_orderkey"), "c_custkey").select("c_name", "c_mktsegment")


@query(
    "semi_in",
    """SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000
       UNION SELECT l_suppkey FROM lineitem WHERE l_quantity > 45)""",
)
def semi_in(t: Tables):
    big = t.orders.where(F.col("o_totalprice") > 400000).select(F.col("o_custkey").alias("c_custkey"))
    bulk = t.lineitem.where(F.col("l_quantity") > 45).select(F.col("l_suppkey").alias("c_custkey"))
    return exists_in(t.customer.select("c_custkey"), big.unionByName(bulk), "c_custkey")


@query(
    "anti_not_exists",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)",
)
def anti_not_exists(t: Tables):
    big = t.orders.where(F.col("o_totalprice") > 300000).select(F.col("o_custkey").alias("c_custkey"))
    return not_exists_in(t.customer.select("c_custkey", "c_name"), big, "c_custkey")


@query(
    "anti_not_in",
    """SELECT 'no null' AS list, c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
       UNION ALL SELECT 'null', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT NULLIF(o_custkey, 0) FROM orders)
       UNION ALL SELECT 'empty', c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice < 0)""",
)
def anti_not_in(t: Tables):
    customers = t.customer.select("c_custkey")
    priced = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    lists = {
        "no null": priced.where(F.col("o_totalprice") > 300000),
        "null": priced.select(F.nullif("c_custkey", F.lit(0)).alias("c_custkey")),
        "empty": priced.where(F.col("o_totalprice") < 0),
    }
    parts = [not_in(customers, rows, "c_custkey").withColumn("list", F.lit(name)) for name, rows in lists.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).select("list", "c_custkey")


@query(
    "join_like_dict",
    """WITH w AS (SELECT unnest(string_split(lower(text), ' ')) AS word FROM conversations),
         frequent AS (SELECT word FROM w WHERE regexp_full_match(word, '[a-z]{6,8}') GROUP BY word HAVING count(*) > 2),
         tags AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS tag FROM part UNION SELECT DISTINCT lower(lang) FROM documents UNION SELECT word FROM frequent
           UNION SELECT left(word, 2) || '%' || right(word, 2) FROM frequent WHERE word LIKE 'w%' UNION SELECT '%' || right(word, 4) FROM frequent WHERE word LIKE 'w%')
       SELECT doc_id, tag FROM documents JOIN tags ON lower(text) LIKE '%#' || tag || '%' OR lower(text) LIKE '% ' || tag || '%' OR lower(text) LIKE tag || '%'""",
)
def join_like_dict(t: Tables):
    word, two, four = F.col("tag"), F.lit(2), F.lit(4)
    said = t.conversations.select(F.explode(F.split(F.lower("text"), " ")).alias("tag")).where(word.rlike("^[a-z]{6,8}$"))
    frequent = said.groupBy("tag").agg(F.count("*").alias("n")).where("n > 2").select("tag")
    parts = (
        t.part.select(F.explode(F.split("p_name", " ")).alias("tag")),
        t.documents.select(F.lower("lang").alias("tag")),
        frequent,
        frequent.where(word.like("w%")).select(F.concat(F.left(word, two), F.lit("%"), F.right(word, two)).alias("tag")),
        frequent.where(word.like("w%")).select(F.concat(F.lit("%"), F.right(word, four)).alias("tag")),
    )
    tags = reduce(lambda a, b: a.unionByName(b), parts).distinct()
    return tag_matches(t.documents, "doc_id", "text", tags, "tag")


@query(
    "join_address_match",
    """WITH reg AS (SELECT s_suppkey AS register, s_suppkey AS inn, lower(substr(n_name, 8)) AS house, lower(n_name) AS street, lower(r_name) AS district,
             lower(n_name) AS city, lower(r_name) AS region FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
           cat AS (SELECT c_custkey AS entry, c_custkey % 1000 AS inn, lower(r_name || ', ' || n_name || ', ' || c_mktsegment) AS full_address,
             lower(n_name) AS city_text, lower(c_mktsegment) AS district_text FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
       SELECT 'inn' AS kind, CAST(register AS VARCHAR) AS needle, entry FROM reg JOIN cat ON reg.inn = cat.inn AND contains(full_address, house)
         AND contains(full_address, street) AND contains(full_address, district)
       UNION SELECT 'district', district, entry FROM (SELECT DISTINCT district FROM reg) JOIN cat ON contains(city_text, district)
       UNION SELECT 'city', city, entry FROM (SELECT DISTINCT city FROM reg) JOIN cat ON contains(city_text, city) OR contains(full_address, city) OR contains(district_text, city)
       UNION SELECT 'region', region, entry FROM (SELECT DISTINCT region FROM reg) JOIN cat ON contains(full_address, region) OR contains(city_text, region)""",
)
def join_address_match(t: Tables):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    registers = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("register"),
        F.col("s_suppkey").alias("inn"),
        F.lower(F.substring("n_name", 8, 10)).alias("house"),
        F.lower("n_name").alias("street"),
        F.lower("r_name").alias("district"),
        F.lower("n_name").alias("city"),
        F.lower("r_name").alias("region"),
    )
    catalog = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("entry"),
        (F.col("c_custkey") % 1000).alias("inn"),
        F.lower(F.concat_ws(", ", "r_name", "n_name", "c_mktsegment")).alias("full_address"),
        F.lower("n_name").alias("city_text"),
        F.lower("c_mktsegment").alias("district_text"),
    )
    exact = exact_matches(registers, catalog, []).select(F.lit("inn").alias("kind"), F.col("register").cast("string").alias("needle"), "entry")
    return exact.unionByName(attribute_matches(registers, catalog, []))


@query(
    "join_period_consistent",
    """SELECT l_orderkey, l_linenumber, l_partkey, strftime(o_orderdate, '%Y%m') AS period FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE strftime(l_shipdate, '%Y%m') = strftime(o_orderdate, '%Y%m')""",
)
def join_period_consistent(t: Tables):
    shipped = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyyMM").alias("period"))
    ordered = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "yyyyMM").alias("period"))
    return shipped.join(ordered, ["l_orderkey", "period"]).select("l_orderkey", "l_linenumber", "l_partkey", "period")


@query(
    "join_next_in_seq",
    sql_with("subs", numbered="SELECT *, row_number() OVER (PARTITION BY inn, fam ORDER BY since, id) AS s FROM subs")
    + """SELECT c.id, c.inn, c.fam, n.id AS next_id, n.since AS next_since, CAST(date_diff('day', c.upto, n.since) AS INTEGER) AS defer
         FROM numbered c LEFT JOIN numbered n ON n.inn = c.inn AND n.fam = c.fam AND n.s = c.s + 1""",
)
def join_next_in_seq(t: Tables):
    rows = subs(t)
    known = F.col("inn").isNotNull() & F.col("fam").isNotNull()
    linked = in_sequence(rows.where(known), ["inn", "fam"], ["since", "id"], following={"id": "next_id", "since": "next_since"})
    linked = linked.drop("row_number").unionByName(rows.where(~known), allowMissingColumns=True)  # no client or family, no successor
    return linked.select("id", "inn", "fam", "next_id", "next_since", F.date_diff("next_since", "upto").alias("defer"))


RUNNING = """SELECT id, inn, priority, coalesce(fam, 'other') AS fam, summ, since, upto,
  CASE WHEN DATE '1998-06-01' BETWEEN since AND upto THEN '1' ELSE '0' END AS cur FROM subs
  WHERE DATE '1998-06-01' BETWEEN since AND upto OR since > DATE '1998-06-01'"""


def running(t: Tables):
    day = F.lit(AS_OF)
    label = F.when(day.between(F.col("since"), F.col("upto")), "1").otherwise("0")
    rows = subs(t).where(day.between(F.col("since"), F.col("upto")) | (F.col("since") > day))
    return rows.withColumns({"cur": label, "fam": F.coalesce("fam", F.lit("other"))})


@query(
    "join_self_rollup",
    sql_with("subs", r=RUNNING)
    + """SELECT d.id, d.inn, d.cur, string_agg(s.priority, '; ' ORDER BY s.priority) AS tariffs, CAST(sum(s.summ) AS DOUBLE) AS summ_plan
         FROM r d JOIN r s ON d.inn = s.inn AND d.cur = s.cur WHERE d.fam ILIKE '%BASE%' GROUP BY d.id, d.inn, d.cur""",
)
def join_self_rollup(t: Tables):
    rows = running(t)
    totals = string_agg(rows, ["inn", "cur"], "priority", "; ", "tariffs", sums={"summ": "_sum"})
    base = rows.where(F.col("fam").ilike("%BASE%")).select("id", "inn", "cur")
    return base.join(totals, ["inn", "cur"]).select("id", "inn", "cur", "tariffs", F.col("_sum").cast("double").alias("summ_plan"))


@query(
    "join_self_pairs",
    sql_with("subs", r=RUNNING, g="SELECT inn, cur, fam, sum(summ) AS plan, max(upto) AS upto FROM r GROUP BY inn, cur, fam")
    + """SELECT p1.inn, p1.fam AS fam_1, p2.fam AS fam_2, CAST(CASE WHEN p1.plan - p2.plan < 0 THEN 0 ELSE p1.plan - p2.plan END AS DOUBLE) AS sum_plan,
         coalesce(p2.upto, p1.upto) AS plan_date FROM g p1, g p2 WHERE p1.inn = p2.inn AND p1.cur = '1' AND p2.cur = '0'""",
)
def join_self_pairs(t: Tables):
    # one row per client, flag and family first: at most three rows of a client meet three
    grouped = running(t).groupBy("inn", "cur", "fam").agg(F.sum("summ").alias("plan"), F.max("upto").alias("upto"))
    now = grouped.where(F.col("cur") == "1").select("inn", F.col("fam").alias("fam_1"), F.col("plan").alias("_now"), F.col("upto").alias("_upto"))
    later = grouped.where(F.col("cur") == "0").select("inn", F.col("fam").alias("fam_2"), F.col("plan").alias("_later"), "upto")
    return now.join(later, "inn").select(
        "inn",
        "fam_1",
        "fam_2",
        not_below_zero(F.col("_now") - F.col("_later")).cast("double").alias("sum_plan"),
        F.coalesce("upto", "_upto").alias("plan_date"),
    )
