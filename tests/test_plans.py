import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from billscope.params import ReportParams
from billscope.plans import active_report as active
from billscope.plans.active_report import in_force_or_future, without_foreign_holders
from billscope.plans.brick_distribution import brick_distribution
from billscope.plans.daily_sales import LENS_RULES, category, daily_sales
from billscope.plans.months_active import months_active
from billscope.plans.prolongation import renewals
from billscope.plans.revenue import CATEGORIES, CATEGORY_RULES, category_columns
from billscope.plans.roles import client_roles
from billscope.plans.segmentation import client_type

D = dt.date


def test_months_active_sample(spark):
    rows = [("модель1", "2", D(2017, 6, 1), D(2018, 6, 1)), ("модель1", "1", D(2017, 1, 1), D(2018, 1, 1))]
    got = months_active(spark.createDataFrame(rows, "model string, register_id string, registered date, fiscal_end date"))
    counts = {r["month"]: r["n_active"] for r in got.collect()}
    month = lambda n: D(2017 + n // 12, n % 12 + 1, 1)
    want = {month(n): 1 + (5 <= n <= 12) for n in range(0, 18)}
    assert counts == want and len(counts) == 18 and sum(counts.values()) == 26


CHAIN = "inn string, kpp string, num long, tariff_name string, since date, up_to date, bill_date date, family string"


def test_renewal_rule(spark):
    end = D(2020, 1, 1)
    after = lambda days: end + dt.timedelta(days=days)
    rows = []
    for n, (inn, gap) in enumerate([("a", 179), ("b", 180), ("c", -10), ("d", None)]):
        rows.append((inn, "", n * 10, "Базовый 1", D(2019, 1, 1), end, D(2018, 12, 1), "Базовый"))
        if gap is not None:
            rows.append((inn, "", n * 10 + 1, "Базовый 2", after(gap), after(900), after(gap - 3), "Базовый"))
    rows.append(("a", "", 90, "Модуль 1", D(2019, 5, 1), D(2019, 6, 1), end, "Модуль"))  # another family in between
    rows.append(("a", "", 91, "Прочее", D(2019, 5, 2), D(2019, 6, 1), end, None))
    rows.append(("a", "", 92, "Прочее", D(2019, 5, 3), D(2019, 6, 1), end, None))
    rows.append((None, "", 93, "Базовый", D(2019, 5, 3), D(2019, 6, 1), end, "Базовый"))
    rows.append((None, "", 94, "Базовый", D(2019, 5, 4), D(2019, 6, 1), end, "Базовый"))
    got = {r["num"]: r for r in renewals(spark.createDataFrame(rows, CHAIN), 180).collect()}
    assert len(got) == len(rows)
    assert (got[0]["prolong"], got[0]["defer"], got[0]["next_num"], got[0]["next_tariff"]) == (1, 179, 1, "Базовый 2")
    # not renewed: bill, date and start are blank, tariff and gap stay
    assert (got[10]["prolong"], got[10]["defer"], got[10]["next_num"], got[10]["next_tariff"], got[10]["next_since"]) == (0, 180, None, "Базовый 2", None)
    assert (got[20]["prolong"], got[20]["defer"]) == (1, -10)
    for lone in (30, 90, 91, 92, 93, 94):
        assert (got[lone]["prolong"], got[lone]["defer"], got[lone]["next_tariff"]) == (0, None, "")


def test_lens_categories(spark):
    names = ["acuvue oasys", "Акувью".lower(), "акkувю", "раствор акувью ревиталенс", "acuvue revitalens", "вода", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(category(F.col("n"), LENS_RULES)).collect()]
    assert got[0] == got[1] == "ACUVUE®" and got[3] == got[4] == "ACUVUE® RevitaLens" and got[5] is None and got[6] is None


RECEIPTS = """date date, type string, content struct<calculation_type:string, timestamp:string, cashbox_number:string, number:string,
  client:string, client_inn:string, products:array<struct<name:string, sum:long, quantity:double>>>"""
REGISTERS = """cashbox_number string, from_time string, address struct<region:struct<code:string,name:string>, city:struct<name:string>,
  street:struct<guid:string>, house:string>"""


def receipt(number="1", kind="Sell", day=D(2023, 7, 21), products=(("Acuvue 1", 12345, 1.0),), box="k1", top="Receipt"):
    return (day, top, (kind, f"{day} 10:00:00", box, number, "cl", "77", [tuple(p) for p in products]))


def test_daily_sales(spark):
    receipts = [
        receipt(),
        receipt(),  # the same receipt again
        receipt("2", products=(("ACUVUE 1", 100, 2.5), ("water", 100, 1.0))),
        receipt("3", kind="Return"),
        receipt("4", top="Bill"),
        receipt("5", day=D(2023, 7, 20)),
        receipt("6", box="unknown"),
        receipt(None),
        receipt(None, products=(("acuvue 1", 1, 7.0),)),  # ids with a NULL part count as one receipt
    ]
    address = lambda city: (("77001", "Москва"), (city,), ("guid",), None)
    registers = [("k1", "2023-01-01", address("old")), ("k1", "2023-05-01", address("new"))]
    got = daily_sales(spark.createDataFrame(receipts, RECEIPTS), spark.createDataFrame(registers, REGISTERS), D(2023, 7, 22))
    rows = {(r["city_name"], r["sales_point_id"]): r for r in got.collect()}
    assert set(rows) == {("new", "guid__77"), (None, "__77")}
    known = rows[("new", "guid__77")]
    assert known["region_code"] == "77" and known["product_name"] == "acuvue 1" and known["date"] == D(2023, 7, 21)
    assert known["quantity"] in (1 + 2.5 + 1, 1 + 2.5 + 7)


def test_brick_distribution_equals_brute_force(spark):
    rng = random.Random(5)
    cities, regions = ["omsk", "om", "perm", "tomsk"], ["ural", "ur", None]
    boxes = [(f"k{i}", str(i % 7), rng.choice(cities + [None]), rng.choice(regions), rng.choice(["north", None])) for i in range(15)]
    document = lambda box, inn, city, region, district, time: (
        (box, time), inn, [((region,), (city,), (district,), ("Мирная Ёлка",), "H1"), ((None,), (None,), (None,), (None,), None)],
    )
    documents = [document(*b, "2023-01-01") for b in boxes] + [document(b[0], "0", "perm", "ural", None, "2022-01-01") for b in boxes[:5]]
    names = ["Aspirin", "Cream", "Drops", "Gel"]
    sales = {(rng.choice(boxes)[0], rng.choice(names), rng.choice([D(2023, 7, 29), D(2023, 7, 31), D(2023, 8, 1)])) for _ in range(40)}
    receipts = [receipt(str(i), day=day, box=box, products=((name, 1, 1.0),)) for i, (box, name, day) in enumerate(sorted(sales))]
    entries = []
    for i in range(60):
        text = f"{rng.choice(cities)}, Мирная ёлка h1, north {rng.choice(['ural', 'x'])}" if i % 2 else rng.choice(["nowhere", "Мирная елка H1 north"])
        entries.append((i, rng.choice(["202306", "202307"]), str(i % 7), text, rng.choice([None, "Omsk", "Uralsk", "none"]), rng.choice([None, "Permskiy"])))
    catalog = spark.createDataFrame(entries, "entry long, period string, inn string, full_address string, city string, district string")
    bricks = [(i, p, f"b{i % 3}") for i, *_ in entries for p in ("202306", "202307")]
    skus = {n: k for k, n in enumerate(names)}
    got = brick_distribution(
        spark.createDataFrame(receipts, RECEIPTS).withColumn("cashbox_number", F.col("content.cashbox_number")),
        spark.createDataFrame([(n.upper(), k) for n, k in skus.items()], "check_item string, sku_id int"),
        spark.createDataFrame([(0,), (1,), (2,)], "sku_id int"),
        spark.createDataFrame(documents, """cashbox_id struct<cashbox_number:string, from_time:string>, client_id string, address_candidates
          array<struct<region:struct<name:string>, city:struct<name:string>, district:struct<name:string>, street:struct<name:string>, house:string>>"""),
        catalog,
        spark.createDataFrame(bricks, "entry long, period string, brick string"),
        D(2023, 7, 29),
    )
    inside = lambda needle, text: needle is not None and text is not None and needle in text
    found = set()
    for box, name, day in sales:
        _, inn, city, region, district = next(b for b in boxes if b[0] == box)
        for e, period, entry_inn, address, town, area in entries:
            low = [None if v is None else v.lower() for v in (address, town, area)]
            exact = inn == entry_inn and all(inside(n, low[0]) for n in ("h1", "мирная ёлка", district))
            loose = inside(district, low[1]) or any(inside(city, t) for t in low) or any(inside(region, t) for t in low[:2])
            if (exact or loose) and period == ("202306" if day.month == 7 else "202307") and skus[name] < 3:
                found.add((f"b{e % 3}", skus[name], e))
    want = {}
    for brick, sku, _ in found:
        want[brick, sku] = want.get((brick, sku), 0) + 1
    assert {(r["brick"], r["sku_id"]): r["distribution"] for r in got.collect()} == want and want


def test_revenue_categories(spark):
    rows = [(1, "внедрение срочное", 5.0), (1, "Инструктаж", 2.0), (1, "Базовый", 1.0), (2, "Пакет", 3.0), (2, None, 4.0)]
    df = spark.createDataFrame(rows, "num int, price_set_name string, cost double")
    got = {r["num"]: r for r in category_columns(df, CATEGORY_RULES, CATEGORIES).collect()}
    assert float(got[1]["Внедрение"]) == 7 and float(got[1]["Базовый"]) == 1 and got[1]["Пакет"] is None and float(got[2]["Пакет"]) == 3


def test_roles_look_before_the_marker_only(spark):
    activities = [(1, "Опт и розница Кто клиенты: импорт"), (2, "Кто клиенты: производство"), (3, None), (4, "розница без метки")]
    offers = [("a", 1), ("a", 1), ("b", 2), ("c", 3), ("d", 4), ("x", 1)]
    got = client_roles(
        spark.createDataFrame(offers, "inn string, activity_id int"),
        spark.createDataFrame(activities, "activity_id int, description string"),
        spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "inn string"),
    )
    assert [tuple(r) for r in got.collect()] == [("a", "Оптовик")]


def test_client_type(spark):
    df = spark.createDataFrame([("a, b",), ("нераспределен",), ("обувь",)], "s string")
    assert [r[0] for r in df.select(client_type(F.col("s"))).collect()] == ["мультиотрасль", "неизвестно", "обувь"]


def test_in_force_edges(spark):
    rows = [(1, D(2020, 1, 1), D(2020, 1, 31), 1), (2, D(2020, 2, 1), D(2020, 3, 1), 1), (3, D(2019, 1, 1), D(2020, 1, 30), 1), (4, D(2020, 1, 1), D(2021, 1, 1), 0), (5, D(2020, 2, 5), None, 1)]
    df = spark.createDataFrame(rows, "bill_id int, since date, up_to date, is_real int").selectExpr("0 client_id", "0 agent_id", "bill_id", "'t' tariff_name", "since", "up_to", "is_real")
    got = {r["bill_id"]: r["current"] for r in in_force_or_future(df, D(2020, 1, 31)).collect()}
    assert got == {1: "1", 2: "0", 5: "0"}


def test_foreign_holders(spark):
    rows = [("a", "h1", "h1"), ("a", "h2", "h1"), ("a", None, "h1"), ("b", "h9", "h1")]
    df = spark.createDataFrame(rows, "inn string, hold string, agent_code string")
    got = sorted((tuple(r)[:2] for r in without_foreign_holders(df).collect()), key=str)
    assert got == sorted([("a", "h1"), ("a", None), ("b", "h9")], key=str)


def test_yesterday():
    assert ReportParams(as_of=D(2024, 1, 1)).yesterday == D(2023, 12, 31)


@pytest.fixture
def plain_plans(spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_rows_of_the_active_report_are_not_exchanged_by_all_their_columns(spark, plain_plans):
    made = {name: "string" for name in [*active.DISPLAY, "hold"]} | {"summ_plan": "decimal(19,4)"}
    rows = spark.createDataFrame([], ", ".join(f"{name} {kind}" for name, kind in made.items()))
    keys = re.findall(r"Exchange hashpartitioning\((.*)\), ENSURE", active.rolled_up(rows)._jdf.queryExecution().executedPlan().toString())
    assert keys and not any("agent_name#" in key for key in keys)


def test_wide_rows_of_the_active_report_are_exchanged_by_client_and_bill_only(spark, plain_plans):
    kinds = {
        "subscriptions": "client_id long, agent_id long, bill_id long, tariff_name string, since date, up_to date, is_real int",
        "clients": "client_id long, inn string, kpp string",
        "bills": "bill_id long, bill_date date, bill_sum decimal(19,4), payed decimal(19,4), pay_date date",
        "agents": "agent_id long, code string, agent_name string, center_segment string, department string",
        "org_registry": "inn string, kpp string, short_name string, role string, revenue_last_known decimal(19,4), status string",
        "payer_links": "payer_id long, expiration_date date, product_id string, center_code string",
        "tracker": "custom_variables string, site_id string, category string, action string, event_date date",
        "bill_lines": "bill_id long, price_set_name string, doc_sum decimal(19,4), cost decimal(19,4)",
        "segmentation": "inn string, segment string",
    }
    detail = active.detail_rows({name: spark.createDataFrame([], kind) for name, kind in kinds.items()}, ReportParams(as_of=D(2020, 1, 1)))
    keys = re.findall(r"Exchange hashpartitioning\((.*)\), ENSURE", detail._jdf.queryExecution().executedPlan().toString())
    assert keys and not any("bill_sum#" in key or "short_name#" in key for key in keys)


def test_tasks_read_16_mb_unless_the_session_names_another_size(spark):
    from billscope.session import TASK_INPUT, tune

    key, wanted = TASK_INPUT
    before = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert tune(spark).conf.get(key) == wanted == "16m"
        spark.conf.set(key, "8m")
        assert tune(spark).conf.get(key) == "8m"
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
