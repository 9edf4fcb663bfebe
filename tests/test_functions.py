import calendar
import datetime as dt

import pytest
from pyspark.sql import functions as F

from billscope.functions.dates import month_key, month_steps, monday_week, week_key, week_of_year
from billscope.functions.json import json_string, json_value, with_texts
from billscope.functions.text import (
    UTM_PARTS,
    chop_last,
    concat_skip_null,
    first_rule,
    labelled_lines,
    next_list_number,
    normalise,
    stable_uuid,
    through_marker,
    utm_payload,
)
from billscope.functions.values import differs_or_missing, flag, money_or_zero, not_below_zero
from billscope.sources.periods import days_of_week, month_before, month_keys_of_week, week_file_key


def one(spark, column, **values):
    """The value of an expression over a single row."""
    schema = ", ".join(f"{k} {'date' if isinstance(v, dt.date) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("r")).first()[0]


def add_month(day):
    year, month = divmod(day.year * 12 + day.month, 12)
    last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(day.day, last))


def recursion(start, end):
    days = [start]
    while end is not None and days[-1] < end:
        days.append(add_month(days[-1]))
    return days


@pytest.mark.parametrize(
    "start, end",
    [
        (dt.date(2017, 1, 31), dt.date(2017, 6, 30)),
        (dt.date(2016, 1, 31), dt.date(2017, 4, 15)),
        (dt.date(2017, 5, 31), dt.date(2018, 5, 31)),
        (dt.date(2017, 1, 1), dt.date(2018, 1, 1)),
        (dt.date(2017, 1, 15), dt.date(2017, 3, 20)),
        (dt.date(2017, 1, 30), dt.date(2017, 2, 28)),
        (dt.date(2017, 3, 1), dt.date(2017, 1, 1)),
        (dt.date(2017, 3, 31), dt.date(2017, 3, 31)),
        (dt.date(2017, 12, 29), dt.date(2024, 3, 1)),
    ],
)
def test_month_steps_equal_the_recursion(spark, start, end):
    assert one(spark, month_steps(F.col("a"), F.col("b")), a=start, b=end) == recursion(start, end)


def test_month_steps_without_end(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), None)], "a date, b date")
    assert df.select(month_steps(F.col("a"), F.col("b"))).first()[0] == [dt.date(2020, 1, 1)]


@pytest.mark.parametrize("year", range(2015, 2022))
def test_week_numbers(spark, year):
    days = [dt.date(year, 1, 1), dt.date(year, 1, 2), dt.date(year, 1, 7), dt.date(year, 12, 31)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    rows = df.select("d", monday_week(F.col("d")).alias("w"), week_key(F.col("d")).alias("k"), week_of_year(F.col("d"), 7).alias("s"), week_of_year(F.col("d"), 1).alias("m")).collect()
    for r in rows:
        assert r["w"] == int(r["d"].strftime("%W")) and r["k"] == r["d"].strftime("%Y%W") == week_file_key(r["d"])
        for name, first in (("s", 7), ("m", 1)):
            starts = sum((dt.date(year, 1, 1) + dt.timedelta(days=n)).isoweekday() == first for n in range(1, r["d"].timetuple().tm_yday))
            assert r[name] == 1 + starts


def test_period_helpers():
    assert month_before(dt.date(2023, 1, 31)) == "202212" and month_before(dt.date(2023, 7, 31)) == "202306"
    assert month_keys_of_week(dt.date(2023, 7, 22)) == ["202306"]
    assert month_keys_of_week(dt.date(2023, 7, 30)) == ["202306", "202307"]
    assert len(days_of_week(dt.date(2023, 7, 22))) == 7


def test_month_key(spark):
    assert one(spark, month_key(F.col("d"), -1), d=dt.date(2023, 3, 31)) == "202302"


@pytest.mark.parametrize(
    "text, want",
    [
        ('{"k": "v"}', "v"),
        ('{"a":1,"k":"v w"}', "v w"),
        ('{"k": 5}', ""),
        ('{"x": "y"}', ""),
        ('{"k": ""}', ""),
        ('broken "k": "v" text', "v"),
        ('{"k": "say \\"hi\\""}', 'say "hi"'),
    ],
)
def test_json_string(spark, text, want):
    assert one(spark, json_string(F.col("t"), "k"), t=text) == want


def test_texts_of_one_parse(spark):
    rows = ['{"k": "v", "it\'s": "q", "n": 5, "o": {"k": "deep"}, "e": ""}', 'broken "k": "w"', None, "[1]", '{"k": null}', '{"k": "é\\u0041"}']
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    got = with_texts(df, "t", {"a": "k", "b": "it's", "c": "n", "d": "o", "e": "e", "f": "none"})
    assert [tuple(r)[1:] for r in got.collect()] == [
        ("v", "q", "", "", "", ""), ("w", "", "", "", "", ""), ("",) * 6, ("",) * 6, ("",) * 6, ("éA", "", "", "", "", ""),
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_month_steps_of_every_month_end(spark):
    days = [dt.date(y, m, d) for y in (1896, 1999, 2000, 2023, 2024) for m in range(1, 13) for d in (28, 29, 30, 31) if d <= calendar.monthrange(y, m)[1]]
    df = spark.createDataFrame([(d, dt.date(d.year + 9, 3, 30)) for d in days], "a date, b date")
    for r in df.select("a", "b", month_steps(F.col("a"), F.col("b")).alias("s")).collect():
        assert r["s"] == recursion(r["a"], r["b"]), r["a"]


def test_json_of_null_and_numbers(spark):
    df = spark.createDataFrame([(None, '{"k": 69}')], "n string, t string")
    assert tuple(df.select(json_string(F.col("n"), "k"), json_value(F.col("n"), "k"), json_value(F.col("t"), "k")).first()) == ("", "", "69")


def test_null_rules_of_concatenation(spark):
    df = spark.createDataFrame([("a", None)], "a string, n string")
    row = df.select(concat_skip_null(F.col("a"), F.col("n")), F.concat("a", "n")).first()
    assert tuple(row) == ("a", None)


def test_flags_and_clamps(spark):
    df = spark.createDataFrame([(-1, 0, None)], "a int, b int, n int")
    got = df.select(
        not_below_zero(F.col("a")), not_below_zero(F.col("b")), not_below_zero(F.col("n")), flag(F.col("n") > 1), flag(F.col("b") == 0),
        differs_or_missing(F.col("n"), F.col("a")), differs_or_missing(F.col("a"), F.col("n")),
    ).first()
    assert tuple(got) == (0, 0, None, 0, 1, True, None)
    assert float(df.select(money_or_zero(F.col("n"))).first()[0]) == 0.0


def test_through_marker(spark):
    marker = "Кто клиенты:"
    assert one(spark, through_marker(F.col("t"), marker), t="опт Кто клиенты: все") == "опт Кт"
    assert one(spark, through_marker(F.col("t"), marker), t="КТО КЛИЕНТЫ: все") == "КТ"
    assert one(spark, through_marker(F.col("t"), marker), t="опт") == "о"
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(through_marker(F.col("t"), marker)).first()[0] is None


def test_rules_are_case_insensitive_and_ordered(spark):
    rules = ((("базов%",), "base"), (("%модуль%", "б%"), "module"))
    assert one(spark, first_rule(F.col("t"), rules), t="БАЗОВЫЙ 1") == "base"
    assert one(spark, first_rule(F.col("t"), rules), t="Бета") == "module"
    assert one(spark, first_rule(F.col("t"), rules), t="x") is None
    assert one(spark, first_rule(F.col("t"), rules, F.col("t")), t="x") == "x"


def test_normalise_replaces_small_letter_only(spark):
    assert one(spark, normalise(F.col("t")), t="Берёзовая Ёлка") == "березовая ёлка"


def test_chop_last(spark):
    assert one(spark, chop_last(F.col("t")), t="a,b,") == "a,b" and one(spark, chop_last(F.col("t")), t="") == ""


def payload(spark, **given):
    columns = {name: F.lit(given.get(name)).cast("string") for name, _ in UTM_PARTS}
    return spark.range(1).select(utm_payload(columns)).first()[0]


def test_payload_edges(spark):
    assert payload(spark) == '{"UTM":""}'
    assert payload(spark, utm_source="", utm_medium="cpc") == '{"UTM":"&utm_medium=cpc"}'
    assert payload(spark, utm_source="ya", utm_from=None, utm_type="b") == '{"UTM":"utm_source=ya&utm_type=b"}'


def test_comment_has_literal_backslash_n(spark):
    got = one(spark, labelled_lines("Hi", [("Name", F.lit(None)), ("Day", F.lit("x"))]), t="")
    assert got == "Hi\\nName: \\nDay: x\\n"


def test_ids_are_stable_and_distinct(spark):
    df = spark.range(100).select(stable_uuid(F.lit("a"), F.col("id")).alias("u"))
    first, second = [r[0] for r in df.collect()], [r[0] for r in df.repartition(7).collect()]
    assert sorted(first) == sorted(second) and len(set(first)) == 100
    assert all(len(u) == 36 and u.count("-") == 4 for u in first)


def test_next_list_number(spark):
    df = spark.createDataFrame([("00007_List",), ("00012_Other",), ("00003_List",)], "b string")
    assert df.select(next_list_number(F.col("b"), "_List")).first()[0] == "00008_List"
    assert df.where("b = ''").select(next_list_number(F.col("b"), "_List")).first()[0] == "00001_List"
    wide = spark.createDataFrame([("99998_List",), ("99999_List",), ("x_List",)], "b string")
    assert wide.select(next_list_number(F.col("b"), "_List")).first()[0] == "100000_List"
    wider = wide.unionAll(spark.createDataFrame([("100000_List",), ("1234567_List",)], "b string"))
    assert wider.select(next_list_number(F.col("b"), "_List")).first()[0] == "1234568_List"
