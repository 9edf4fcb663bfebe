"""Scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from billscope.catalog.base import Tables, query
from billscope.catalog.changes import sql_uuid
from billscope.catalog.views import bills, receipts, sql_with
from billscope.functions.dates import month_key, week_of_year
from billscope.functions.json import json_string, json_value
from billscope.functions.text import (
    UTM_PARTS,
    chop_last,
    concat_skip_null,
    first_rule,
    labelled_lines,
    next_list_number,
    padded_number,
    normalise,
    stable_uuid,
    through_marker,
    utm_payload,
)
from billscope.functions.values import flag, not_below_zero
from billscope.plans.prolongation import FAMILY_RULES
from billscope.plans.roles import ROLE_MARKER


@query(
    "fn_case_map",
    """SELECT p_partkey, CASE WHEN p_name ILIKE 'Red%' OR p_name ILIKE 'blue%' THEN 'colour' WHEN p_name ILIKE '%RING' THEN 'ring' ELSE p_name END AS kind,
         CASE WHEN p_name ILIKE '%gear' THEN 'gear' END AS maybe FROM part""",
)
def fn_case_map(t: Tables):
    name = F.col("p_name")
    rules = ((("Red%", "blue%"), "colour"), (("%RING",), "ring"))
    return t.part.select("p_partkey", first_rule(name, rules, name).alias("kind"), first_rule(name, ((("%gear",), "gear"),)).alias("maybe"))


@query(
    "fn_iif_clamp",
    sql_with("bills", d="SELECT num, CASE WHEN priority = '5-LOW' THEN NULL ELSE summ - payed - payed END AS diff FROM bills")
    + "SELECT num, CAST(CASE WHEN diff < 0 THEN 0 ELSE diff END AS DOUBLE) AS clamped FROM d",
)
def fn_iif_clamp(t: Tables):
    diff = F.when(F.col("priority") != "5-LOW", F.col("summ") - F.col("payed") - F.col("payed"))
    return bills(t).select("num", not_below_zero(diff).cast("double").alias("clamped"))


@query(
    "fn_iif_flag",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f, CASE WHEN NULLIF(o_orderstatus, 'P') <> 'F' THEN 1 ELSE 0 END AS not_f,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'mass' ELSE o_orderpriority END AS renamed FROM orders""",
)
def fn_iif_flag(t: Tables):
    return t.orders.select(
        "o_orderkey",
        flag(F.col("o_orderstatus") == "F").alias("is_f"),
        flag(F.nullif("o_orderstatus", F.lit("P")) != "F").alias("not_f"),
        F.when(F.col("o_orderpriority") == "5-LOW", "mass").otherwise(F.col("o_orderpriority")).alias("renamed"),
    )


@query(
    "fn_null_default",
    "SELECT o_orderkey, coalesce(NULLIF(o_orderstatus, 'P'), '') AS status, coalesce(NULLIF(o_custkey, 1), o_orderkey, 0) AS key FROM orders",
)
def fn_null_default(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("")).alias("status"),
        F.coalesce(F.nullif("o_custkey", F.lit(1)), "o_orderkey", F.lit(0)).alias("key"),
    )


@query(
    "fn_concat",
    """WITH c AS (SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'BUILDING') AS seg FROM customer)
       SELECT c_custkey, c_name || ' ' || seg AS poisoned, concat(c_name, ' ', seg) AS skipped, concat_ws('_', coalesce(seg, ''), c_name, '') AS joined FROM c""",
)
def fn_concat(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return rows.select(
        "c_custkey",
        F.concat("c_name", F.lit(" "), "seg").alias("poisoned"),
        concat_skip_null(F.col("c_name"), F.lit(" "), F.col("seg")).alias("skipped"),
        F.concat_ws("_", F.coalesce("seg", F.lit("")), "c_name", F.lit("")).alias("joined"),
    )


def _utm_sql() -> str:
    pieces = []
    for i, (_, parameter) in enumerate(UTM_PARTS):
        value = f"CASE (o_orderkey + {i}) % 3 WHEN 0 THEN '' WHEN 1 THEN o_orderpriority END"
        joiner = "" if i == 0 else "&"
        pieces.append(f"CASE WHEN {value} <> '' THEN '{joiner}{parameter}=' || {value} ELSE '' END")
    return "SELECT o_orderkey, '{\"UTM\":\"' || " + " || ".join(pieces) + " || '\"}' AS payload FROM orders"


@query("fn_utm_payload", _utm_sql())
def fn_utm_payload(t: Tables):
    def part(i: int):
        turn = (F.col("o_orderkey") + i) % 3
        return F.when(turn == 0, "").when(turn == 1, F.col("o_orderpriority"))

    return t.orders.select("o_orderkey", utm_payload({name: part(i) for i, (name, _) in enumerate(UTM_PARTS)}).alias("payload"))


@query(
    "fn_comment_text",
    r"""SELECT o_orderkey, 'Meet the client.\nName: ' || coalesce(NULLIF(o_orderstatus, 'P'), '') || '\nDate: ' || strftime(o_orderdate, '%Y-%m-%d') || '\n' AS comment FROM orders""",
)
def fn_comment_text(t: Tables):
    fields = [("Name", F.nullif("o_orderstatus", F.lit("P"))), ("Date", F.to_date("o_orderdate"))]
    return t.orders.select("o_orderkey", labelled_lines("Meet the client.", fields).alias("comment"))


@query(
    "fn_lower_replace",
    "SELECT p_partkey, lower(replace('Берёзовая Ёлка ' || upper(p_name), 'ё', 'е')) AS street FROM part",
)
def fn_lower_replace(t: Tables):
    return t.part.select("p_partkey", normalise(F.concat(F.lit("Берёзовая Ёлка "), F.upper("p_name"))).alias("street"))


@query(
    "fn_substring",
    """SELECT c_custkey, left(c_name, 2) AS head, left(c_name, length(c_name) - 1) AS chopped, length(c_name) AS len,
         repeat('0', 3) || c_mktsegment AS padded, instr(c_name, '#') AS at FROM customer""",
)
def fn_substring(t: Tables):
    return t.customer.select(
        "c_custkey",
        F.substring("c_name", 0, 2).alias("head"),
        chop_last(F.col("c_name")).alias("chopped"),
        F.length("c_name").cast("long").alias("len"),
        F.concat(F.repeat(F.lit("0"), 3), F.col("c_mktsegment")).alias("padded"),
        F.instr("c_name", "#").cast("long").alias("at"),
    )


MARKED_SQL = f"""CASE p_size % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || ' {ROLE_MARKER} ' || p_type WHEN 2 THEN lower('{ROLE_MARKER}') || p_name END"""


@query(
    "fn_prefix_before_marker",
    f"""WITH m AS (SELECT p_partkey, {MARKED_SQL} AS note FROM part)
        SELECT p_partkey, left(note, CAST(instr(lower(note), lower('{ROLE_MARKER}')) AS INTEGER) + 1) AS head FROM m""",
)
def fn_prefix_before_marker(t: Tables):
    turn = F.col("p_size") % 4
    note = (
        F.when(turn == 0, F.col("p_name"))
        .when(turn == 1, F.concat("p_name", F.lit(f" {ROLE_MARKER} "), "p_type"))
        .when(turn == 2, F.concat(F.lit(ROLE_MARKER.lower()), "p_name"))
    )
    return t.part.select("p_partkey", through_marker(note, ROLE_MARKER).alias("head"))


@query(
    "fn_contains",
    """SELECT p_partkey FROM part WHERE p_name IS NOT NULL AND contains(p_name, lower(p_type)) OR contains(p_brand, CAST(p_size AS VARCHAR))""",
)
def fn_contains(t: Tables):
    name_hit = F.col("p_name").isNotNull() & F.col("p_name").contains(F.lower("p_type"))
    return t.part.where(name_hit | F.col("p_brand").contains(F.col("p_size").cast("string"))).select("p_partkey")


@query(
    "fn_regex",
    r"""SELECT p_partkey, regexp_extract(p_brand, 'Brand#(\d+)', 1) AS brand_no, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked,
          regexp_matches('Акувью ' || p_name, 'а[кk]ув.?[юу] .*(ring|rod)', 'i') AS is_lens FROM part""",
)
def fn_regex(t: Tables):
    return t.part.select(
        "p_partkey",
        F.regexp_extract("p_brand", r"Brand#(\d+)", 1).alias("brand_no"),
        F.regexp_replace("p_name", "[aeiou]", "_").alias("masked"),
        F.lower(F.concat(F.lit("Акувью "), "p_name")).rlike("а[кk]ув.?[юу] .*(ring|rod)").alias("is_lens"),
    )


@query(
    "fn_json_string",
    """SELECT event_id, event_type AS action, '' AS strict_k, '' AS missing, json_extract_string(props, '$.k') AS k,
         'say "' || event_type || '"' AS quoted FROM events""",
)
def fn_json_string(t: Tables):
    document = F.concat(
        F.lit('{"action": "'), "event_type", F.lit('", "quoted": "say \\"'), "event_type", F.lit('\\"", "k": 5}')
    )
    rows = t.events.select("event_id", "props", document.alias("doc"))
    doc = F.col("doc")
    return rows.select(
        "event_id",
        json_string(doc, "action").alias("action"),
        json_string(doc, "k").alias("strict_k"),
        json_string(doc, "absent").alias("missing"),
        json_value(F.col("props"), "k").alias("k"),
        json_string(doc, "quoted").alias("quoted"),
    )


@query(
    "fn_explode",
    """WITH x AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS number, p_name, l_extendedprice, l_quantity, l_tax FROM lineitem JOIN part ON l_partkey = p_partkey)
       SELECT number, p_name AS name, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM x
       UNION ALL SELECT number, 'service ' || p_name, CAST(round(l_quantity * 5 * 100) AS BIGINT) FROM x WHERE l_tax > 0""",
)
def fn_explode(t: Tables):
    rows = receipts(t).select(F.col("content.number").alias("number"), F.explode("content.products").alias("p"))
    return rows.select("number", F.col("p.name").alias("name"), F.col("p.sum").alias("cents"))


@query(
    "fn_array_first",
    """SELECT p_partkey, CASE WHEN p_size < 10 THEN NULL ELSE string_split(p_name, ' ')[1] END AS first_word FROM part""",
)
def fn_array_first(t: Tables):
    words = F.when(F.col("p_size") < 10, F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return t.part.select("p_partkey", F.get(words, 0).alias("first_word"))


@query(
    "fn_date_parts",
    sql_with("bills")
    + """SELECT num, CAST(year(bdate + 1) AS INTEGER) AS y, CAST(month(bdate + 1) AS INTEGER) AS m,
         CAST(floor((dayofyear(bdate) - 1 + dayofweek(date_trunc('year', bdate))) / 7) + 1 AS INTEGER) AS week_sunday,
         CAST(floor((dayofyear(bdate) - 1 + isodow(date_trunc('year', bdate)) - 1) / 7) + 1 AS INTEGER) AS week_monday FROM bills""",
)
def fn_date_parts(t: Tables):
    day = F.col("bdate")
    after = F.date_add(day, 1)
    return bills(t).select(
        "num",
        F.year(after).alias("y"),
        F.month(after).alias("m"),
        week_of_year(day, 7).alias("week_sunday"),
        week_of_year(day, 1).alias("week_monday"),
    )


@query(
    "fn_date_add",
    sql_with("bills")
    + """SELECT num, bdate - 1 AS yesterday, CAST(bdate + INTERVAL 1 MONTH AS DATE) AS next_month, CAST(bdate - INTERVAL 1 MONTH AS DATE) AS last_month,
         CAST(bdate - INTERVAL 1 YEAR AS DATE) AS last_year FROM bills""",
)
def fn_date_add(t: Tables):
    return bills(t).select(
        "num",
        F.date_sub("bdate", 1).alias("yesterday"),
        F.add_months("bdate", 1).alias("next_month"),
        F.add_months("bdate", -1).alias("last_month"),
        F.add_months("bdate", -12).alias("last_year"),
    )


@query(
    "fn_date_diff",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def fn_date_diff(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    days = F.date_diff(F.to_date("l_shipdate"), F.to_date("o_orderdate"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", days.alias("days"))


@query(
    "fn_date_format",
    sql_with("bills")
    + """SELECT num, strftime(bdate, '%d.%m.%Y') AS shown, strftime(bdate - INTERVAL 1 MONTH, '%Y%m') AS last_month,
         CAST(strptime(strftime(bdate, '%Y%m%d'), '%Y%m%d') AS DATE) AS parsed FROM bills""",
)
def fn_date_format(t: Tables):
    return bills(t).select(
        "num",
        F.date_format("bdate", "dd.MM.yyyy").alias("shown"),
        month_key(F.col("bdate"), -1).alias("last_month"),
        F.to_date(F.date_format("bdate", "yyyyMMdd"), "yyyyMMdd").alias("parsed"),
    )


@query(
    "fn_round",
    """WITH c AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
       SELECT o_orderkey, CAST((cents + 50) // 100 AS DOUBLE) / 100 AS hundredth, CAST((cents + 50) // 100 AS DOUBLE) AS whole FROM c""",
)
def fn_round(t: Tables):
    price = F.col("o_totalprice").cast("decimal(19,4)")
    return t.orders.select(
        "o_orderkey", F.round(price / 100, 2).cast("double").alias("hundredth"), F.round(price, 0).cast("double").alias("whole")
    )


@query(
    "fn_cast",
    """SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS digit, TRY_CAST(o_orderpriority AS INTEGER) AS bad,
         CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey AS VARCHAR) AS text FROM orders""",
)
def fn_cast(t: Tables):
    return t.orders.select(
        "o_orderkey",
        F.left("o_orderpriority", F.lit(1)).cast("int").alias("digit"),
        F.col("o_orderpriority").try_cast("int").alias("bad"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("text"),
    )


@query("fn_uuid", f"SELECT o_orderkey, {sql_uuid(chr(39) + 'row|' + chr(39) + ' || o_orderkey || ' + chr(39) + '|' + chr(39) + ' || o_orderstatus')} AS id FROM orders")
def fn_uuid(t: Tables):
    return t.orders.select("o_orderkey", stable_uuid(F.lit("row"), F.col("o_orderkey"), F.col("o_orderstatus")).alias("id"))


@query("fn_url", "SELECT user_id, event_id, 'https://example.org/cards/' || event_id AS url FROM events")
def fn_url(t: Tables):
    return t.events.select("user_id", "event_id", F.concat(F.lit("https://example.org/cards/"), F.col("event_id").cast("string")).alias("url"))


TARIFF_SQL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Базовый ' || o_orderpriority WHEN o_orderpriority = '3-MEDIUM' THEN 'модуль ' || o_orderstatus ELSE 'Прочее' END"


@query(
    "fn_first_tariff_family",
    f"""WITH s AS (SELECT o_orderkey, {TARIFF_SQL} AS tariff FROM orders)
        SELECT o_orderkey, CASE WHEN tariff ILIKE 'базовый%' THEN 'Базовый' WHEN tariff ILIKE 'модуль %' THEN 'Модуль' END AS family FROM s""",
)
def fn_first_tariff_family(t: Tables):
    priority = F.col("o_orderpriority")
    tariff = (
        F.when(priority.isin("1-URGENT", "2-HIGH"), F.concat(F.lit("Базовый "), priority))
        .when(priority == "3-MEDIUM", F.concat(F.lit("модуль "), F.col("o_orderstatus")))
        .otherwise("Прочее")
    )
    return t.orders.select("o_orderkey", first_rule(tariff, FAMILY_RULES).alias("family"))


@query(
    "fn_next_list_number",
    """SELECT o_orderstatus, CASE WHEN length(CAST(max(o_custkey) + 1 AS VARCHAR)) >= 5 THEN CAST(max(o_custkey) + 1 AS VARCHAR) ELSE lpad(CAST(max(o_custkey) + 1 AS VARCHAR), 5, '0') END || '_List' AS list_id FROM orders GROUP BY o_orderstatus""",
)
def fn_next_list_number(t: Tables):
    brief = F.concat(padded_number(F.col("o_custkey")), F.lit("_List"))
    return t.orders.groupBy("o_orderstatus").agg(next_list_number(brief, "_List").alias("list_id"))
