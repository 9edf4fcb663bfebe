"""Report inputs derived from the driver tables.

Each input is one SELECT that reads the same in Spark and in the oracle's SQL; ``{name}`` stands for a
driver table.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame

from billscope.catalog.base import Tables

TARIFF = """CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Базовый ' || o_orderpriority
  WHEN o_orderpriority = '3-MEDIUM' THEN 'Модуль ' || o_orderstatus ELSE 'Отчетность ' || o_orderpriority END"""
PAYED = "CASE o_orderstatus WHEN 'F' THEN o_totalprice WHEN 'P' THEN o_totalprice / 2 ELSE 0 END"
VARIABLES = """'{{"organizationInn":"' || CASE WHEN value < 2 THEN '' ELSE CAST(user_id AS STRING) END || '","productGroup":"' || event_type || '"}}'"""

INPUTS = {
    "subscriptions": f"""SELECT o_custkey AS client_id, o_custkey % 10 AS agent_id, o_orderkey AS bill_id, {TARIFF} AS tariff_name,
        CAST(o_orderdate AS DATE) AS since, CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 300 AS INT) AS up_to,
        CASE WHEN o_totalprice > 2000 THEN 1 ELSE 0 END AS is_real FROM {{orders}}""",
    "clients": """SELECT c_custkey AS client_id, CAST(c_custkey AS STRING) AS inn,
        CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS kpp FROM {customer}""",
    "bills": f"""SELECT o_orderkey AS bill_id, o_orderkey AS num, CAST(o_orderdate AS DATE) - 5 AS bill_date,
        CAST(o_totalprice AS DECIMAL(19,4)) AS bill_sum, CAST({PAYED} AS DECIMAL(19,4)) AS payed,
        CAST(o_orderdate AS DATE) + 10 AS pay_date FROM {{orders}}""",
    "bill_lines": """SELECT o_orderkey AS num, o_orderkey AS bill_id, o_orderkey * 10 + l_linenumber AS bill_line_id, CAST(o_custkey AS STRING) AS inn,
        CASE p_type WHEN 'ECONOMY' THEN 'Базовый' WHEN 'PROMO' THEN 'Внедрение ' || p_name WHEN 'LARGE' THEN 'Сопровождение года'
          WHEN 'SMALL' THEN 'Модуль Оборудование тариф ' || p_brand WHEN 'MEDIUM' THEN 'Пакет' ELSE 'Тест-драйв 7 дней' END AS price_set_name,
        CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'LARGE') THEN 'Базовый' ELSE 'Модуль' END AS tariff_name,
        CAST(l_extendedprice AS DECIMAL(19,4)) AS cost, CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS DECIMAL(19,4)) AS payed,
        CAST(o_totalprice AS DECIMAL(19,4)) AS doc_sum, l_returnflag || l_linestatus AS manager_name, 'c' || CAST(l_suppkey % 3 AS STRING) AS code
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey""",
    "other_lines": """SELECT l_orderkey AS num, CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN 'Железо' WHEN l_quantity > 25 THEN 'Доставка по городу' ELSE 'допы др проектов' END AS price_set_name,
        CAST(l_extendedprice AS DECIMAL(19,4)) AS cost FROM {lineitem} WHERE l_linestatus = 'O'""",
    "payments": "SELECT o_orderkey AS payment_id, o_orderkey AS bill_id, CAST(o_orderdate AS DATE) + 10 AS pay_date FROM {orders}",
    "payment_lines": "SELECT DISTINCT l_orderkey * 10 + l_linenumber AS bill_line_id, l_orderkey AS payment_id FROM {lineitem} WHERE l_returnflag <> 'N'",
    "all_revenue": """SELECT o_orderkey AS num, CAST(o_custkey AS STRING) AS inn, CASE WHEN o_orderstatus = 'F' THEN 'подключение' ELSE 'прочее' END AS revenue_type,
        CAST(o_orderdate AS DATE) + 10 AS pay_date, CASE WHEN o_totalprice > 200000 THEN 'нераспределен' ELSE 'BUILDING' END AS segment
        FROM {orders} WHERE o_orderdate < TIMESTAMP '1997-06-01'""",
    "segmentation": """SELECT 1 AS week_num, CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 1000 THEN 'нераспределен' ELSE c_mktsegment END AS segment,
        CAST(c_custkey AS STRING) AS inn, 'AF' AS manager_name, DATE '1995-01-02' AS pay_date, c_mktsegment AS tip FROM {customer} WHERE c_acctbal < 5000""",
    "all_categories": "SELECT CAST(c_custkey AS STRING) AS inn, lower(c_mktsegment) AS product_group FROM {customer} WHERE c_acctbal > 4000 OR c_acctbal < 500",
    "offers": """SELECT o_orderkey AS offer_id, CAST(floor(o_orderkey / 8) AS BIGINT) AS activity_id, CAST(o_custkey AS STRING) AS inn,
        CASE WHEN o_orderstatus = 'F' THEN 'ext ' || o_orderpriority END AS external_id, 'Mark' AS crm_product,
        CASE WHEN o_orderpriority = '5-LOW' THEN 'дорого ' || o_orderstatus END AS reject_reason, CAST(o_orderdate AS DATE) AS reject_date FROM {orders}""",
    "offer_links": "SELECT l_orderkey AS bill_num, l_orderkey AS offer_id FROM {lineitem}",
    "activities": """SELECT p_partkey AS activity_id, CASE p_size % 5 WHEN 0 THEN 'Клиент #' || p_name WHEN 1 THEN 'клиент ' || upper(p_name)
          WHEN 2 THEN p_name || ' опт Кто клиенты: розница' WHEN 3 THEN 'Производство Кто клиенты: ' || p_name END AS description FROM {part}""",
    "org_registry": """SELECT CAST(c_custkey AS STRING) AS inn, CAST(c_nationkey AS STRING) AS kpp, 1 AS is_head, 'R' || CAST(c_nationkey AS STRING) AS region_code,
          'city ' || CAST(c_nationkey AS STRING) AS ct, 'addr ' || c_name AS addr, c_name AS short_name, 'role ' || c_mktsegment AS role,
          CAST(c_acctbal AS DECIMAL(19,4)) AS revenue_last_known, CASE WHEN c_acctbal < 1000 THEN 'ликвидация' ELSE 'действует' END AS status FROM {customer}
        UNION ALL SELECT CAST(c_custkey AS STRING), CAST(c_nationkey + 100 AS STRING), 0, 'R0', 'branch', 'addr', c_name, 'branch',
          CAST(0 AS DECIMAL(19,4)), CASE WHEN c_acctbal < 1000 THEN 'ликвидация' ELSE 'действует' END FROM {customer} WHERE c_acctbal > 2000""",
    "agents": """SELECT s_suppkey AS agent_id, 'A' || CAST(s_suppkey AS STRING) AS code, s_name AS agent_name,
        CASE WHEN s_acctbal < 3000 THEN 'Остальные' ELSE 'Крупные' END AS center_segment, 'D' || CAST(s_nationkey AS STRING) AS department FROM {supplier}""",
    "payer_links": """SELECT c_custkey AS payer_id, DATE '1999-01-01' AS expiration_date, 'Mark' AS product_id, 'A' || CAST(c_custkey % 10 AS STRING) AS center_code FROM {customer} WHERE c_acctbal > 3000
        UNION ALL SELECT c_custkey, DATE '1999-01-01', 'Mark', 'A' || CAST((c_custkey + 1) % 10 AS STRING) FROM {customer} WHERE c_acctbal > 7000
        UNION ALL SELECT c_custkey, DATE '1998-01-01', 'Mark', 'A5' FROM {customer}""",
    "tracker": f"""SELECT {VARIABLES} AS custom_variables, CASE WHEN value < 5 THEN '00000000-0000-0000-0000-000000000000' ELSE 'u' || CAST(user_id AS STRING) END AS portal_user_id,
        CASE WHEN value < 40 THEN 'main' ELSE 'other' END AS site_id, CASE event_type WHEN 'error' THEN 'Настройки' ELSE event_type END AS category,
        CASE event_type WHEN 'view' THEN 'Переход в раздел' ELSE event_type END AS action, CAST(ts AS DATE) - 9360 AS event_date FROM {{events}}""",
    "tag_catalog": """SELECT DISTINCT event_type AS tags, 'seg ' || left(event_type, 1) AS segment FROM {events} WHERE event_type <> 'error'
        UNION SELECT DISTINCT upper(substr(p_name, 1, instr(p_name, ' ') - 1)), 'seg ' || left(p_name, 2) FROM {part}""",
    "trial_orgs": """SELECT CAST(c_custkey AS STRING) AS inn, 'pp-' || CAST(c_custkey AS STRING) AS create_pp_id, CASE WHEN c_acctbal > 8000 THEN 'card-' || CAST(c_custkey AS STRING) END AS pp_id,
        CAST(NULL AS BIGINT) AS kp_id, CASE WHEN c_acctbal > 8000 THEN DATE '1998-05-31' - CAST(c_custkey % 3 AS INT) END AS load_to_crm_date,
        CASE WHEN c_acctbal > 9500 THEN 0 END AS paid_bill FROM {customer} WHERE c_acctbal > 7000""",
    "load_log": """SELECT 'pp-' || CAST(c_custkey AS STRING) AS object_id, CASE WHEN c_nationkey > 3 THEN 'card-' || CAST(c_custkey AS STRING) END AS response,
        TIMESTAMP '1998-05-31 10:00:00' AS date FROM {customer} WHERE c_acctbal > 6000""",
    "prospect_sales": "SELECT 'card-' || CAST(c_custkey AS STRING) AS sale_id, c_custkey AS offer_id FROM {customer} WHERE c_nationkey < 20",
    "client_bills": f"""SELECT CAST(o_custkey AS STRING) AS inn, CAST({PAYED} AS DECIMAL(19,4)) AS bill_payed, CAST(o_totalprice AS DECIMAL(19,4)) AS bill_sum,
        CAST(o_orderdate AS DATE) + 10 AS pay_date FROM {{orders}} WHERE o_orderdate < TIMESTAMP '1998-06-01'""",
    "trial_events": """SELECT '{{"inn":"' || CAST(user_id AS STRING) || '","userId":"u' || CAST(user_id AS STRING) || '","contactPerson":"Name ' || CAST(event_id AS STRING)
          || '","phone":"+7' || CAST(event_id AS STRING) || '","city":"City","utmSource":"' || CASE WHEN value < 5 THEN '' ELSE 'mail' END
          || '","utmMedium":"' || event_type || '","utmType":"t' || CAST(user_id AS STRING) || '"}}' AS variables,
        CASE WHEN event_type IN ('signup', 'view') THEN 'Site' ELSE 'Other' END AS topic, CASE WHEN event_type IN ('signup', 'view') THEN 'Trial' ELSE 'Campaign' END AS category,
        CASE WHEN event_type IN ('signup', 'view') THEN 'sign_up' ELSE 'campaign_parts' END AS action,
        DATE '1998-05-31' - CAST(event_id % 3 AS INT) AS client_date FROM {events}""",
    "prospect_cards": """SELECT 'c' || CAST(o_orderkey AS STRING) AS card_id, CAST(o_custkey AS STRING) AS inn, CAST(left(o_orderpriority, 1) AS INT) AS temperature,
        o_orderdate AS created, CASE WHEN o_custkey % 3 = 0 THEN 2 ELSE CAST(1 + o_orderkey % 4 AS INT) END AS state FROM {orders}""",
    "tasks": "SELECT CASE WHEN length(CAST(o_custkey AS STRING)) >= 5 THEN CAST(o_custkey AS STRING) ELSE lpad(CAST(o_custkey AS STRING), 5, '0') END || '_List' AS brief_id FROM {orders} WHERE o_orderstatus = 'F'",
}


def table_names(text: str) -> list[str]:
    return sorted({field for _, field, _, _ in Formatter().parse(text) if field})


def report_input(t: Tables, name: str) -> DataFrame:
    text = INPUTS[name]
    return t.spark.sql(text, **{table: getattr(t, table) for table in table_names(text)})


def report_inputs(t: Tables, *names: str) -> dict[str, DataFrame]:
    return {name: report_input(t, name) for name in names}


def sql_inputs(*names: str, **steps: str) -> str:
    """``WITH`` clause of report inputs (named ``in_…``) followed by the steps of an oracle."""
    inputs = [f"in_{n} AS ({INPUTS[n].format(**{table: table for table in table_names(INPUTS[n])})})" for n in names]
    return "WITH " + ", ".join(inputs + [f"{n} AS ({body})" for n, body in steps.items()]) + " "
