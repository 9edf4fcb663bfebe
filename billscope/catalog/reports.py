"""The report jobs on inputs derived from the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from billscope.catalog.base import AS_OF, PARAMS, Tables, query
from billscope.catalog.changes import sql_uuid
from billscope.catalog.report_inputs import report_input, report_inputs, sql_inputs
from billscope.catalog.views import receipts
from billscope.functions.text import UTM_PARTS
from billscope.plans.active_report import DISPLAY, active_report
from billscope.plans.brick_distribution import brick_distribution
from billscope.plans.daily_sales import CategoryRule, daily_sales
from billscope.plans.months_active import months_active
from billscope.plans.prolongation import prolongation
from billscope.plans.revenue import CATEGORIES, OTHER_CATEGORIES, revenue
from billscope.plans.segmentation import segmentation
from billscope.plans.trial import trial
from billscope.plans.user_map import user_inn_map

DATE = "DATE '1998-06-01'"


def doubles(df):
    """Money as double, the type the oracle compares."""
    return df.withColumns({n: F.col(n).cast("double") for n, kind in df.dtypes if kind.startswith("decimal")})


# --- daily sales -----------------------------------------------------------------------------------------

SALES_RULES = (
    CategoryRule("red ring", ("red|hot", "ring|bolt")),
    CategoryRule("red", ("red|hot",), ("ring|bolt", "service")),
)
FIRST_SHIP, SHIP_DAYS = dt.date(1995, 1, 1), 3650

DAILY_SQL = """WITH r AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date, l_suppkey AS cashbox, l_orderkey, l_linenumber, l_partkey, l_linestatus AS client,
    p_name, l_extendedprice, l_quantity, l_tax, l_shipdate FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R'),
  one AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY cashbox, l_orderkey, l_linenumber, l_partkey, l_shipdate ORDER BY l_extendedprice) = 1),
  p AS (SELECT date, cashbox, client, lower(p_name) AS name, CAST(l_quantity AS DECIMAL(19,4)) AS q, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM one
    UNION ALL SELECT date, cashbox, client, 'service ' || lower(p_name), 1, CAST(round(l_quantity * 5 * 100) AS BIGINT) FROM one WHERE l_tax > 0),
  c AS (SELECT *, CASE WHEN regexp_matches(name, 'red|hot') AND regexp_matches(name, 'ring|bolt') THEN 'red ring'
    WHEN regexp_matches(name, 'red|hot') AND NOT regexp_matches(name, 'ring|bolt') AND NOT regexp_matches(name, 'service') THEN 'red' END AS category FROM p),
  a AS (SELECT s_suppkey AS cashbox, 'R' || left(CAST(n_nationkey AS VARCHAR), 1) AS region_code, r_name AS region_name, n_name AS city_name, n_name || '_h' || s_suppkey || '_' || s_suppkey AS spot
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_acctbal > 0)
  SELECT date, client, region_code, region_name, city_name, coalesce(spot, '__' || c.cashbox) AS sales_point_id, category, name AS product_name,
    CAST(sum(q) AS DOUBLE) AS quantity, CAST(sum(cents) AS DOUBLE) / 100 AS sum_rub
  FROM c LEFT JOIN a USING (cashbox) WHERE category IS NOT NULL GROUP BY ALL"""


def registers(t: Tables):
    """Two address documents per register; the later one counts."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.supplier.where(F.col("s_acctbal") > 0).join(places, F.col("s_nationkey") == F.col("n_nationkey"))
    part = lambda *fields: F.struct(*fields)
    address = F.struct(
        part(F.concat(F.lit("R"), F.col("n_nationkey").cast("string")).alias("code"), F.col("r_name").alias("name")).alias("region"),
        part(F.col("n_name").alias("name")).alias("city"),
        part(F.col("n_name").alias("guid")).alias("street"),
        F.concat(F.lit("h"), F.col("s_suppkey").cast("string")).alias("house"),
    )
    current = rows.select(F.col("s_suppkey").alias("cashbox_number"), F.lit("2024-01-02").alias("from_time"), address.alias("address"))
    return current.unionByName(current.withColumn("from_time", F.lit("2023-12-31")))


@query("pipe_daily_sales", DAILY_SQL)
def pipe_daily_sales(t: Tables):
    return daily_sales(receipts(t), registers(t), FIRST_SHIP + dt.timedelta(days=SHIP_DAYS), SHIP_DAYS, SALES_RULES)


# --- weekly distribution ---------------------------------------------------------------------------------

BRICK_SQL = """WITH sku AS (SELECT upper(p_name) AS item, min(p_partkey) AS sku FROM part GROUP BY 1),
  week AS (SELECT sku FROM sku WHERE item NOT LIKE 'COLD%'),
  sold AS (SELECT DISTINCT strftime(CAST(l_shipdate AS DATE) - INTERVAL 1 MONTH, '%Y%m') AS period, l_suppkey AS register, sku
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN sku ON lower(item) = lower(p_name) JOIN week USING (sku) WHERE l_returnflag <> 'R'
    UNION SELECT DISTINCT strftime(CAST(l_shipdate AS DATE) - INTERVAL 1 MONTH, '%Y%m'), l_suppkey, sku FROM lineitem JOIN part ON l_partkey = p_partkey
      JOIN sku ON lower(item) = 'service ' || lower(p_name) JOIN week USING (sku) WHERE l_returnflag <> 'R' AND l_tax > 0),
  reg AS (SELECT s_suppkey AS register, CAST(s_suppkey AS VARCHAR) AS inn, lower(CASE WHEN s_acctbal > 0 THEN n_name END) AS city, CASE WHEN s_acctbal < 5000 THEN lower(r_name) END AS region,
    lower(r_name) AS district, lower(n_name) AS street, lower('h' || s_suppkey % 3) AS house
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  cat AS (SELECT c_custkey AS entry, CAST(c_custkey AS VARCHAR) AS inn, lower(r_name || ', ' || n_name || ', h' || c_custkey % 3) AS full_address,
    lower(n_name) AS city_text, lower(c_mktsegment) AS district_text, strftime(DATE '1995-01-01' + to_months(CAST(c_custkey % 70 AS INTEGER)), '%Y%m') AS period,
    'b' || c_nationkey AS brick FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal > -900),
  hits AS (SELECT DISTINCT register, entry, period, brick FROM reg JOIN cat ON
      (reg.inn = cat.inn AND contains(full_address, house) AND contains(full_address, street) AND contains(full_address, district))
      OR contains(city_text, district) OR contains(city_text, city) OR contains(full_address, city) OR contains(district_text, city)
      OR contains(full_address, region) OR contains(city_text, region))
  SELECT brick, sku AS sku_id, CAST(count(DISTINCT entry) AS INTEGER) AS distribution FROM sold JOIN hits USING (register, period) GROUP BY brick, sku"""


@query("pipe_brick_distribution", BRICK_SQL)
def pipe_brick_distribution(t: Tables):
    items = t.part.groupBy(F.upper("p_name").alias("check_item")).agg(F.min("p_partkey").alias("sku_id"))
    week_skus = items.where(~F.col("check_item").like("COLD%")).select("sku_id")
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = lambda column: F.struct(column.alias("name"))
    house = F.concat(F.lit("H"), (F.col("s_suppkey") % 3).cast("string"))
    candidate = F.struct(
        named(F.when(F.col("s_acctbal") < 5000, F.col("r_name"))).alias("region"),
        named(F.when(F.col("s_acctbal") > 0, F.col("n_name"))).alias("city"),
        named(F.col("r_name")).alias("district"),
        named(F.col("n_name")).alias("street"),
        house.alias("house"),
    )
    identity = lambda time: F.struct(F.col("s_suppkey").alias("cashbox_number"), F.lit(time).alias("from_time"))
    documents = t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        identity("1994-12-31").alias("cashbox_id"),
        F.col("s_suppkey").cast("string").alias("client_id"),
        F.array(candidate).alias("address_candidates"),
    )
    too_new = documents.withColumn("cashbox_id", F.struct(F.col("cashbox_id.cashbox_number").alias("cashbox_number"), F.lit("1999-01-01").alias("from_time")))
    month = F.date_format(F.add_months(F.lit(dt.date(1995, 1, 1)), (F.col("c_custkey") % 70).cast("int")), "yyyyMM")
    entries = t.customer.where(F.col("c_acctbal") > -900).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    catalog = entries.select(
        F.col("c_custkey").alias("entry"),
        month.alias("period"),
        F.col("c_custkey").cast("string").alias("inn"),
        F.concat(F.concat_ws(", ", "r_name", "n_name"), F.lit(", h"), (F.col("c_custkey") % 3).cast("string")).alias("full_address"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("district"),
    )
    bricks = t.customer.select(
        F.col("c_custkey").alias("entry"), month.alias("period"), F.concat(F.lit("b"), F.col("c_nationkey").cast("string")).alias("brick")
    )
    return brick_distribution(
        receipts(t), items, week_skus, documents.unionByName(too_new), catalog, bricks, FIRST_SHIP, SHIP_DAYS
    )


# --- months, users ---------------------------------------------------------------------------------------

MONTHS_SQL = """WITH RECURSIVE m AS (SELECT l_linestatus || l_returnflag || ' ' || p_type AS model, CAST(l_shipdate AS DATE) AS month,
    CAST(l_shipdate AS DATE) + p_size * 7 AS upto FROM lineitem JOIN part ON l_partkey = p_partkey
    UNION ALL SELECT model, CAST(month + INTERVAL 1 MONTH AS DATE), upto FROM m WHERE month < upto)
  SELECT model, month, count(*) AS n_active FROM m GROUP BY model, month"""


@query("pipe_months_active", MONTHS_SQL)
def pipe_months_active(t: Tables):
    started = F.to_date("l_shipdate")
    rows = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat("l_linestatus", "l_returnflag", F.lit(" "), "p_type").alias("model"),
        started.alias("registered"),
        F.date_add(started, F.col("p_size") * 7).alias("fiscal_end"),
    )
    return months_active(rows)


@query(
    "pipe_user_inn_map",
    sql_inputs("tracker")
    + """SELECT DISTINCT json_extract_string(custom_variables, '$.organizationInn') AS inn, portal_user_id FROM in_tracker
         WHERE portal_user_id <> '00000000-0000-0000-0000-000000000000' AND json_extract_string(custom_variables, '$.organizationInn') <> ''""",
)
def pipe_user_inn_map(t: Tables):
    return user_inn_map(report_input(t, "tracker"))


# --- renewal ---------------------------------------------------------------------------------------------

RENEWAL_INPUTS = ("subscriptions", "clients", "bills", "bill_lines", "all_revenue", "segmentation", "all_categories", "offers", "activities", "org_registry")
ROLE_SQL = """SELECT inn, activity_id, arg_min(label, place) AS role
  FROM in_offers JOIN in_activities USING (activity_id)
  JOIN (VALUES (1, 'производ', 'Производитель'), (2, 'опт', 'Оптовик'), (3, 'розн', 'Розница'), (4, 'импорт', 'Импорт')) AS rule(place, stem, label)
    ON contains(lower(left(description, CAST(position('кто клиенты:' IN lower(description)) + 1 AS INTEGER))), stem)
  GROUP BY inn, activity_id"""
ROLE_LISTS = f"SELECT inn, array_to_string(list_sort(list(DISTINCT role)), '; ') AS role FROM ({ROLE_SQL}) GROUP BY inn"
# a subscription's successor is the next row of its client and family; everything else is looked up from there
RENEWAL_STEPS = {
    "held": """SELECT DISTINCT c.inn, ifnull(c.kpp, '') AS kpp, b.num, b.bill_date, s.tariff_name, s.since, s.up_to,
        CASE WHEN starts_with(lower(s.tariff_name), 'базовый') THEN 'Базовый' WHEN starts_with(lower(s.tariff_name), 'модуль ') THEN 'Модуль' END AS family
        FROM in_bills b JOIN in_subscriptions s USING (bill_id) JOIN in_clients c USING (client_id) WHERE s.is_real = 1""",
    "chain": """SELECT *, CASE WHEN family IS NOT NULL AND inn IS NOT NULL THEN lead({'num': num, 'tariff': tariff_name, 'billed': bill_date, 'start': since})
        OVER (PARTITION BY family, inn ORDER BY since, num, tariff_name, up_to, kpp, bill_date) END AS after FROM held""",
    "renewal": "SELECT *, CAST(after.start - up_to AS INTEGER) AS gap, coalesce(after.start - up_to < 180, FALSE) AS renewed FROM chain",
    "corrected": """SELECT r.num, r.inn, r.pay_date, r.segment, if(k.num IS NOT NULL AND r.revenue_type = 'подключение', 'продление', r.revenue_type) AS revenue_type
        FROM in_all_revenue r LEFT JOIN (SELECT DISTINCT after.num AS num FROM renewal WHERE renewed) k ON k.num = r.num""",
    "refused": """SELECT inn, min(reject_reason) AS reject_reason FROM (SELECT inn, reject_reason, reject_date, max(reject_date) OVER (PARTITION BY inn) AS latest
        FROM in_offers WHERE reject_reason IS NOT NULL) WHERE reject_date = latest AND inn IN (SELECT inn FROM renewal WHERE NOT renewed) GROUP BY inn""",
    "money": """SELECT num, sum(payed) FILTER (tariff_name = 'Базовый') AS basic, sum(payed) FILTER (tariff_name = 'Модуль') AS module
        FROM in_bill_lines SEMI JOIN (SELECT bill_id FROM in_subscriptions WHERE is_real = 1) USING (bill_id) GROUP BY num""",
    "role_list": ROLE_LISTS,
}


@query(
    "pipe_prolongation",
    sql_inputs(*RENEWAL_INPUTS, **RENEWAL_STEPS)
    + """SELECT DISTINCT CAST(year(x.up_to + 1) AS INTEGER) AS renewal_year, CAST(month(x.up_to + 1) AS INTEGER) AS renewal_month, x.inn, x.kpp, ifnull(role_list.role, '') AS role,
        coalesce(nullif(g.segment, 'нераспределен'), c.product_group, '') AS product_group, x.num, CAST(CASE x.family WHEN 'Базовый' THEN basic WHEN 'Модуль' THEN module END AS DOUBLE) AS tariff_sum,
        line.code, x.tariff_name, x.since, x.up_to, CAST(x.renewed AS INTEGER) AS prolong, x.gap AS defer, ifnull(x.after.tariff, '') AS next_tariff,
        if(x.renewed, x.after.num, NULL) AS next_num, if(x.renewed, x.after.billed, NULL) AS next_bill_date,
        CAST(paid.pay_date - if(x.renewed, x.after.billed, NULL) AS INTEGER) AS days_to_pay, if(x.renewed, x.after.start, NULL) AS next_since,
        org.status, refused.reject_reason, DATE '1998-06-01' AS date_load
      FROM renewal x JOIN in_bill_lines line USING (num) LEFT JOIN money USING (num) LEFT JOIN role_list ON role_list.inn = x.inn LEFT JOIN refused ON refused.inn = x.inn
      LEFT JOIN in_org_registry org ON org.inn = x.inn LEFT JOIN in_segmentation g ON g.inn = x.inn LEFT JOIN in_all_categories c ON c.inn = x.inn
      LEFT JOIN corrected paid ON x.renewed AND paid.num = x.after.num""",
)
def pipe_prolongation(t: Tables):
    return doubles(prolongation(report_inputs(t, *RENEWAL_INPUTS), PARAMS, "Mark")["report"])


@query(
    "pipe_prolongation_revenue",
    sql_inputs(*RENEWAL_INPUTS, **RENEWAL_STEPS) + "FROM corrected",
)
def pipe_prolongation_revenue(t: Tables):
    return prolongation(report_inputs(t, *RENEWAL_INPUTS), PARAMS, "Mark")["all_revenue"]


# --- revenue ---------------------------------------------------------------------------------------------

REVENUE_INPUTS = ("bill_lines", "payments", "payment_lines", "other_lines", "offer_links", "offers", "activities", "segmentation", "all_revenue")


def _sums(categories):
    return ", ".join(f"sum(CASE WHEN category = '{c}' THEN cost END) AS \"{c}\"" for c in categories)


REVENUE_STEPS = {
    "w": """SELECT num, inn, cost, CASE WHEN price_set_name ILIKE 'Внедрение%' THEN 'Внедрение' WHEN price_set_name ILIKE 'Сопровождение%' THEN 'Сопровождение'
        WHEN price_set_name ILIKE 'Модуль Оборудование тариф%' THEN 'Модуль Оборудование' ELSE price_set_name END AS category FROM in_bill_lines c
        WHERE price_set_name <> 'Тест-драйв 7 дней' AND num NOT IN (SELECT num FROM in_all_revenue)
        AND EXISTS (SELECT 1 FROM in_payment_lines pc JOIN in_payments p ON p.payment_id = pc.payment_id WHERE p.bill_id = c.bill_id AND pc.bill_line_id = c.bill_line_id
          AND p.pay_date BETWEEN DATE '1995-06-01' AND DATE '1998-06-01')""",
    "act": f"SELECT num, min(inn) AS inn, {_sums(CATEGORIES)} FROM w GROUP BY num",
    "act2": f"""SELECT num, {_sums(OTHER_CATEGORIES)} FROM (SELECT num, cost, CASE WHEN price_set_name ILIKE 'Доставка%' THEN 'доставка и бамперы' ELSE price_set_name END AS category FROM in_other_lines) GROUP BY num""",
    "ext": "SELECT bill_num AS num, string_agg(external_id, '; ' ORDER BY external_id) AS ext FROM in_offer_links JOIN in_offers USING (offer_id) WHERE external_id IS NOT NULL GROUP BY bill_num",
    "rev": f"""SELECT num, inn, revenue_type, pay_date, segment, {', '.join(f'NULL AS "{c}"' for c in CATEGORIES + OTHER_CATEGORIES)}, NULL AS external_ids FROM in_all_revenue
        UNION ALL SELECT num, inn, NULL, NULL, 'нераспределен', {', '.join(f'"{c}"' for c in CATEGORIES)}, {', '.join(f'coalesce("{c}", 0)' for c in OTHER_CATEGORIES)}, coalesce(ext, '')
        FROM act LEFT JOIN act2 USING (num) LEFT JOIN ext USING (num)""",
}


@query(
    "pipe_revenue",
    sql_inputs(*REVENUE_INPUTS, **REVENUE_STEPS)
    + f"""SELECT r.num, r.inn, r.revenue_type, r.pay_date, CASE WHEN s.segment <> r.segment AND s.segment <> 'нераспределен' THEN s.segment ELSE r.segment END AS segment,
          {', '.join(f'CAST(r."{c}" AS DOUBLE) AS "{c}"' for c in CATEGORIES + OTHER_CATEGORIES)}, r.external_ids FROM rev r LEFT JOIN in_segmentation s ON s.inn = r.inn
          WHERE r.num NOT IN (SELECT num FROM in_bill_lines GROUP BY num HAVING sum(payed) = 0)
          AND r.num NOT IN (SELECT num FROM in_bill_lines GROUP BY num HAVING round(sum(payed), 0) < round(sum(cost), 0) AND sum(payed) > 0)""",
)
def pipe_revenue(t: Tables):
    return doubles(revenue(report_inputs(t, *REVENUE_INPUTS), PARAMS)["all_revenue"])


@query(
    "pipe_revenue_roles",
    sql_inputs(*REVENUE_INPUTS, **REVENUE_STEPS)
    + f"FROM ({ROLE_LISTS}) SEMI JOIN (SELECT inn FROM w UNION ALL SELECT inn FROM in_all_revenue) USING (inn)",
)
def pipe_revenue_roles(t: Tables):
    return revenue(report_inputs(t, *REVENUE_INPUTS), PARAMS)["roles"]


# --- segmentation ----------------------------------------------------------------------------------------

SEGMENT_INPUTS = ("tracker", "tag_catalog", "segmentation", "bill_lines", "payment_lines", "payments", "offers", "activities")
# groups used in the service win over tags in notes; a client has one or the other
SEGMENT_STEPS = {
    "seen": """SELECT DISTINCT custom_variables ->> '$.organizationInn' AS inn, custom_variables ->> '$.productGroup' AS product_group
        FROM in_tracker WHERE portal_user_id <> '00000000-0000-0000-0000-000000000000'""",
    "by_service": """SELECT inn, array_to_string(list_sort(list(segment)), ', ') AS label FROM in_tag_catalog JOIN seen ON tags = product_group WHERE inn <> '' GROUP BY inn""",
    "joined": """SELECT inn, min(pay_date) AS pay_date, arg_min(manager_name, (pay_date, manager_name)) AS manager_name
        FROM in_payments JOIN in_payment_lines USING (payment_id) JOIN in_bill_lines USING (bill_line_id)
        WHERE contains(lower(price_set_name), 'базовый') AND payed > 1 AND inn NOT IN (SELECT inn FROM in_segmentation) GROUP BY inn""",
    "open_clients": """SELECT inn FROM joined UNION SELECT inn FROM in_segmentation WHERE coalesce(segment, 'нераспределен') = 'нераспределен'
        EXCEPT SELECT inn FROM by_service""",
    "by_note": """SELECT inn, array_to_string(list_sort(list(DISTINCT segment)), ', ') AS label FROM in_offers SEMI JOIN open_clients USING (inn) JOIN in_activities USING (activity_id)
        JOIN (SELECT DISTINCT lower(tags) AS tag, segment FROM in_tag_catalog) ON concat(' ', lower(description)) LIKE concat('% ', tag, '%') OR lower(description) LIKE concat('%#', tag, '%')
        GROUP BY inn""",
    "labels": "FROM by_service UNION ALL FROM by_note",
    "fresh": """SELECT CAST((dayofyear(pay_date) + dayofweek(make_date(year(pay_date), 1, 1)) + 6) // 7 AS INTEGER) AS week_num, ifnull(label, 'нераспределен') AS segment,
        inn, manager_name, pay_date FROM joined LEFT JOIN labels USING (inn)""",
}


@query(
    "pipe_segmentation",
    sql_inputs(*SEGMENT_INPUTS, **SEGMENT_STEPS)
    + """SELECT week_num, ifnull(label, segment) AS segment, inn, manager_name, pay_date, tip FROM in_segmentation LEFT JOIN labels USING (inn)
      UNION ALL SELECT week_num, segment, inn, manager_name, pay_date,
        CASE WHEN contains(segment, ',') THEN 'мультиотрасль' ELSE replace(segment, 'нераспределен', 'неизвестно') END FROM fresh""",
)
def pipe_segmentation(t: Tables):
    return segmentation(report_inputs(t, *SEGMENT_INPUTS), PARAMS)["segmentation"]


@query(
    "pipe_segmentation_unmapped",
    sql_inputs(*SEGMENT_INPUTS, **SEGMENT_STEPS)
    + "SELECT DISTINCT product_group AS unmapped FROM seen ANTI JOIN in_tag_catalog ON tags = product_group WHERE inn <> '' AND product_group <> ''",
)
def pipe_segmentation_unmapped(t: Tables):
    return segmentation(report_inputs(t, *SEGMENT_INPUTS), PARAMS)["unmapped"]


# --- active report ---------------------------------------------------------------------------------------

ACTIVE_INPUTS = ("subscriptions", "clients", "bills", "agents", "org_registry", "payer_links", "tracker", "bill_lines", "segmentation")
_SHOWN = ", ".join(DISPLAY)
_KEYS = ", ".join(c for c in DISPLAY if c not in ("tariff", "summ_plan"))
# a client's bill appears once with the list of its tariffs; totals are summed once per client and period flag
ACTIVE_STEPS = {
    "running": f"""SELECT DISTINCT client_id, agent_id, bill_id, tariff_name, since, up_to, if(since > {DATE}, '0', '1') AS current
        FROM in_subscriptions WHERE is_real = 1 AND (since > {DATE} OR up_to >= {DATE})""",
    "holders": f"""SELECT payer_id, in_agents.code AS hold FROM in_payer_links LEFT JOIN in_agents ON in_agents.code = center_code
        WHERE product_id = 'Mark' AND expiration_date > {DATE}""",
    "seats": """SELECT client_id, agent_id, bill_id, since, up_to, current, array_to_string(list_sort(list(tariff_name)), '; ') AS tariff FROM running GROUP BY ALL""",
    "visits": f"""SELECT custom_variables ->> '$.organizationInn' AS inn,
          max(event_date) FILTER (action NOT IN ('Переход в раздел', 'Отправка в архив') AND category NOT IN ('Сотрудники', 'Настройки')) AS last_date
        FROM in_tracker WHERE event_date < {DATE} AND site_id = 'main' GROUP BY 1""",
    "once": """SELECT bill_id, any_value(doc_sum) - sum(cost) AS pure_sum FROM in_bill_lines WHERE regexp_matches(price_set_name, '^(Внедрение|Доставка|Пакет для обработки)')
        AND bill_id IN (SELECT bill_id FROM running) GROUP BY bill_id""",
    "shown": f"""SELECT DISTINCT c.inn, ifnull(c.kpp, '') AS kpp, o.short_name, o.role, o.revenue_last_known, a.agent_name, replace(a.center_segment, 'Остальные', 'Масс') AS center_segment,
          a.department, b.bill_date, b.payed, strftime(b.pay_date, '%d.%m.%Y') AS pay_date, strftime(seats.since, '%d.%m.%Y') AS since, strftime(seats.up_to, '%d.%m.%Y') AS up_to, tariff,
          CAST(v.inn IS NOT NULL AS INTEGER) AS enter, v.last_date, o.status, g.segment AS product_group, ifnull(once.pure_sum, b.bill_sum) AS summ_plan,
          strftime(seats.up_to + 1, '%d.%m.%Y') AS plan_date, bill_id, a.code AS agent_code, seats.since AS since_date, seats.up_to AS up_to_date, current, h.hold
        FROM seats JOIN in_bills b USING (bill_id) JOIN in_agents a USING (agent_id) JOIN in_clients c USING (client_id)
        LEFT JOIN holders h ON h.payer_id = client_id LEFT JOIN once USING (bill_id) LEFT JOIN visits v ON v.inn = c.inn AND v.inn <> ''
        LEFT JOIN in_org_registry o ON o.inn = c.inn AND o.kpp = ifnull(c.kpp, '') LEFT JOIN in_segmentation g ON g.inn = c.inn""",
    "own": """FROM shown WHERE coalesce(agent_code = hold, TRUE) OR inn NOT IN (SELECT inn FROM shown GROUP BY inn HAVING min(hold) <> max(hold))""",
    "totals": "SELECT inn, current, array_to_string(list_sort(list(tariff)), '; ') AS tariff, sum(summ_plan) AS summ_plan FROM own GROUP BY inn, current",
    "based": f"SELECT {_SHOWN} FROM (SELECT DISTINCT {_KEYS} FROM own WHERE contains(lower(tariff), 'базовый')) JOIN totals USING (inn, current)",
    "report": f"SELECT {_SHOWN} FROM based UNION SELECT {_SHOWN} FROM shown ANTI JOIN based USING (inn)",
}


@query(
    "pipe_active_report",
    sql_inputs(*ACTIVE_INPUTS, **ACTIVE_STEPS)
    + f"SELECT * REPLACE (CAST(revenue_last_known AS DOUBLE) AS revenue_last_known, CAST(payed AS DOUBLE) AS payed, CAST(summ_plan AS DOUBLE) AS summ_plan) FROM report",
)
def pipe_active_report(t: Tables):
    return doubles(active_report(report_inputs(t, *ACTIVE_INPUTS), PARAMS)["report"])


@query(
    "pipe_active_upcoming",
    sql_inputs(*ACTIVE_INPUTS, **ACTIVE_STEPS)
    + """SELECT inn, CAST(greatest(now.summ_plan - later.summ_plan, 0) AS DOUBLE) AS sum_plan, ifnull(later.plan_date, now.plan_date) AS plan_date, now.bill_id,
         later.tariff AS tariff_2, later.since_date AS since_2, later.up_to_date AS up_to_2 FROM report now JOIN report later USING (inn) WHERE now.current > later.current""",
)
def pipe_active_upcoming(t: Tables):
    return doubles(active_report(report_inputs(t, *ACTIVE_INPUTS), PARAMS)["upcoming"])


# --- trial -----------------------------------------------------------------------------------------------

TRIAL_INPUTS = (
    "trial_orgs", "load_log", "prospect_sales", "client_bills", "trial_events", "subscriptions", "clients", "org_registry", "prospect_cards", "tasks", "offers",
)
_J = lambda key: f"json_extract_string(variables, '$.{key}')"
_UTM = {"utm_source": "utmSource", "utm_medium": "utmMedium", "utm_type": "utmType"}  # parts that the events hold
_PARTS = ", ".join(f"nullif('{part}=' || {_J(key)}, '{part}=')" for part, key in _UTM.items())
# every update of the trial table is a lookup; payload parts come from a list without its empty members
TRIAL_STEPS = {
    "trials": """SELECT inn, create_pp_id, ifnull(t.pp_id, l.response) AS pp_id, ifnull(t.kp_id, s.offer_id) AS kp_id,
          CASE WHEN t.pp_id IS NULL AND l.response IS NOT NULL THEN CAST(l.date AS DATE) ELSE t.load_to_crm_date END AS loaded, t.paid_bill
        FROM in_trial_orgs t LEFT JOIN in_load_log l ON l.object_id = t.create_pp_id LEFT JOIN in_prospect_sales s ON s.sale_id = ifnull(t.pp_id, l.response)""",
    "paid": "SELECT inn, max(pay_date) AS last_paid FROM in_client_bills WHERE bill_payed > 0 GROUP BY inn",
    "trial_table": """SELECT trials.inn, create_pp_id, pp_id, kp_id, loaded AS load_to_crm_date, ifnull(paid_bill, if(last_paid >= loaded, 1, NULL)) AS paid_bill FROM trials LEFT JOIN paid USING (inn)""",
    "signed": f"""SELECT {_J('inn')} AS inn, max({_J('userId')}) AS user_id, max({_J('contactPerson')}) AS user_name, max({_J('phone')}) AS phone, any_value(client_date) AS event_date
        FROM in_trial_events WHERE client_date + 1 = {DATE} AND (topic, category, action) = ('Site', 'Trial', 'sign_up') GROUP BY 1""",
    "parts": f"""SELECT DISTINCT {_J('userId')} AS user_id, concat('{{"UTM":"', array_to_string(list_filter([{_PARTS}], lambda x: x IS NOT NULL), '&'), '"}}') AS payload,
          {_J('utmSource')} AS source FROM in_trial_events WHERE client_date + 1 = {DATE} AND (category, action) = ('Campaign', 'campaign_parts')""",
    "clients_now": f"""SELECT inn FROM in_client_bills WHERE bill_payed = bill_sum AND pay_date > {DATE} - INTERVAL 12 MONTH
        UNION ALL SELECT inn FROM in_clients JOIN in_subscriptions USING (client_id) WHERE is_real = 1 AND since <= {DATE} AND up_to >= {DATE} AND starts_with(lower(tariff_name), 'отчетность ')""",
    "office": """SELECT inn, arg_min({'kpp': kpp, 'region_code': region_code, 'city': ct, 'addr': addr, 'short_name': short_name}, (-is_head, kpp)) AS o FROM in_org_registry GROUP BY inn""",
    "written": r"""SELECT DISTINCT inn, o.kpp, o.region_code, o.city, o.addr, o.short_name, event_date,
          CASE WHEN source = '' AND payload <> '{"UTM":""}' THEN replace(payload, '{"UTM":"', '{"UTM":"&') ELSE ifnull(payload, '{"UTM":""}') END AS specific_data,
          concat('Клиент создал орзанизацию. Познакомьте клиента с сервисом и выставьте счет.\n', 'ФИО: ', user_name, '\nТелефон: ', phone, '\nЭлектронная почта: \nДата регистрации: ', event_date, '\n') AS comment
        FROM signed JOIN office USING (inn) LEFT JOIN parts USING (user_id) WHERE inn NOT IN (SELECT inn FROM clients_now) AND inn NOT IN (SELECT inn FROM trials)""",
    "prepared": f"""SELECT *, {sql_uuid("concat_ws('|', 'client', inn, specific_data, comment)")} AS client_id, {sql_uuid("concat_ws('|', 'lead', inn, specific_data, comment)")} AS create_pp_id FROM written""",
    "cards": "SELECT inn, arg_min(card_id, (temperature, -epoch_us(CAST(created AS TIMESTAMP)), card_id)) AS pp_id FROM in_prospect_cards WHERE state = 1 OR state = 3 GROUP BY inn",
    "known": "SELECT DISTINCT comment, create_pp_id, pp_id FROM prepared JOIN cards USING (inn)",
    "new_leads": "FROM prepared ANTI JOIN known USING (create_pp_id)",
}


def run_trial(t: Tables):
    inputs = report_inputs(t, *TRIAL_INPUTS)
    inputs["events"] = inputs.pop("trial_events")
    return trial(inputs, PARAMS)


@query("pipe_trial_onboarding", sql_inputs(*TRIAL_INPUTS, **TRIAL_STEPS) + "SELECT *, row_number() OVER (ORDER BY inn, create_pp_id) AS row_id FROM new_leads")
def pipe_trial_onboarding(t: Tables):
    return run_trial(t)["leads"]


@query("pipe_trial_orgs", sql_inputs(*TRIAL_INPUTS, **TRIAL_STEPS) + "FROM trial_table")
def pipe_trial_orgs(t: Tables):
    return run_trial(t)["trial_orgs"]


@query(
    "pipe_trial_outbox",
    sql_inputs(*TRIAL_INPUTS, **TRIAL_STEPS)
    + f"""SELECT {sql_uuid(f"'task|1998-06-01|{PARAMS.list_name}'")} AS task_id, (SELECT CASE WHEN length(CAST(max(CAST(regexp_extract(brief_id, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR)) >= 5 THEN CAST(max(CAST(regexp_extract(brief_id, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR) ELSE lpad(CAST(max(CAST(regexp_extract(brief_id, '^[0-9]+') AS BIGINT)) + 1 AS VARCHAR), 5, '0') END FROM in_tasks) || '_List' AS list_id,
          '{PARAMS.list_name}' AS base_name, pp_id, comment FROM known""",
)
def pipe_trial_outbox(t: Tables):
    return run_trial(t)["comments"]


@query(
    "pipe_trial_summary",
    sql_inputs(*TRIAL_INPUTS, **TRIAL_STEPS)
    + f"""SELECT CAST(count(DISTINCT create_pp_id) AS VARCHAR) AS created_yesterday,
          ifnull(array_to_string(list_sort(list('https://example.org/cards/' || activity_id) FILTER (activity_id IS NOT NULL)), ' <br> '), 'не было карточек') AS cards,
          (SELECT count(*) FROM new_leads) AS n_leads, if((SELECT count(*) FROM new_leads) > 0, '', 'Новых созданных организаций по Триалу нет') AS note
        FROM trial_table LEFT JOIN (SELECT sale_id, activity_id FROM in_prospect_sales JOIN in_offers USING (offer_id)) ON sale_id = pp_id WHERE load_to_crm_date + 1 = {DATE}""",
)
def pipe_trial_summary(t: Tables):
    return run_trial(t)["summary"]
