import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from billscope.operators.windows import (
    first_per_key,
    in_sequence,
    keep_latest,
    order_struct,
    row_identity,
    running_first,
)
from billscope.session import cut_buckets

SCHEMA = "inn string, family string, id long, since date, tariff string"


def skewed_rows(seed, n=900):
    """A third of the rows in one group, many of them on one day; NULL keys and NULL dates among the rest."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = rng.random() < 0.4
        inn = "hot" if hot else rng.choice(["a", "b", "c", None])
        family = "base" if hot else rng.choice(["base", "module", None])
        day = None if rng.random() < 0.05 else dt.date(2020, 1, 1) + dt.timedelta(days=rng.choice([5, 5, 5, rng.randrange(400)]))
        rows.append((inn, family, i, day, rng.choice("xyz")))
    return rows


def naive(df, keys):
    window = Window.partitionBy(*keys).orderBy("since", "id")
    return df.withColumn("s", F.row_number().over(window)).withColumn("next_id", F.lead("id").over(window)).withColumn(
        "next_tariff", F.lead("tariff").over(window)
    )


@pytest.fixture(params=[1, 3, 17])
def parts(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_in_sequence_equals_plain_windows(spark, parts):
    df = spark.createDataFrame(skewed_rows(parts), SCHEMA).repartition(5)
    keys = ["inn", "family"]
    got = in_sequence(df, keys, ["since", "id"], number="s", following={"id": "next_id", "tariff": "next_tariff"})
    assert sorted(map(repr, got.collect())) == sorted(map(repr, naive(df, keys).collect()))


def test_row_identity_is_dense(spark, parts):
    df = spark.createDataFrame(skewed_rows(9), SCHEMA)
    got = row_identity(df, ["since", "id"], "n").orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(1, 901))
    known = [(r["since"] or dt.date.min, r["id"]) for r in got]
    assert known == sorted(known)


@pytest.mark.parametrize("share", ["key", "day", "constant"])
def test_hot_groups_lie_in_many_tasks(spark, share):
    rows = spark.range(2000).select(
        F.when((F.col("id") % 10 == 0) & (F.lit(share) == "key"), F.col("id").cast("string")).otherwise("hot").alias("inn"),
        F.date_add(F.lit(dt.date(2020, 1, 1)), F.when(F.lit(share) == "key", F.col("id") % 7).otherwise(0).cast("int")).alias("since"),
        "id",
    )
    got = in_sequence(rows, ["inn"], ["since", "id"], following={"id": "next_id"})
    tasks = got.where("inn = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 1800
    window = Window.partitionBy("inn").orderBy("since", "id")
    want = rows.withColumn("row_number", F.row_number().over(window).cast("long")).withColumn("next_id", F.lead("id").over(window))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_rows_are_exchanged_once(spark):
    rows = spark.range(3000).select((F.col("id") % 40).alias("inn"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    got = in_sequence(rows, ["inn"], ["id"], following={"v": "next"})
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # the rows come from the buckets to the window without an exchange; those in the plan are of the parts' totals
    over_rows = plan[plan.index("Window [row_number()") :]
    buckets = over_rows[: over_rows.index("BroadcastQueryStage")]
    assert "Bucketed: true" in plan and "ShuffleQueryStage" not in buckets and "Exchange" not in buckets


def test_buckets_hold_one_part_each(spark):
    placed = cut_buckets(spark.range(0, 7000).repartitionByRange(7, "id"), 7, "_part", "t")
    held = placed.select("_part", F.spark_partition_id().alias("task")).distinct().collect()
    assert len(held) == 7 and len({r["task"] for r in held}) == 7


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert in_sequence(empty, ["inn"], ["since", "id"], following={"id": "next_id"}).collect() == []


def test_keep_latest_keeps_ties_and_null_keys(spark):
    rows = [("a", "2020"), ("a", "2021"), ("a", "2021"), ("b", None), (None, "2019"), (None, "2018")]
    df = spark.createDataFrame(rows, "k string, t string")
    got = sorted(map(tuple, keep_latest(df, ["k"], "t").collect()), key=str)
    assert got == sorted([("a", "2021"), ("a", "2021"), (None, "2019")], key=str)


def test_first_per_key_order(spark):
    rows = [("a", 1, dt.date(2020, 1, 1), "x"), ("a", 1, dt.date(2021, 1, 1), "y"), ("a", 2, None, "z"), ("b", None, None, "n"), ("b", 5, None, "m")]
    df = spark.createDataFrame(rows, "k string, temperature int, created date, v string")
    got = first_per_key(df, ["k"], [("temperature", "asc"), ("created", "desc")], ["v"])
    # NULL is the smallest value: first in ascending order, last in descending order
    assert dict(map(tuple, got.collect())) == {"a": "y", "b": "n"}
    down = first_per_key(df, ["k"], [("created", "desc"), ("v", "asc")], ["v"])
    assert dict(map(tuple, down.collect())) == {"a": "y", "b": "m"}


def test_descending_text_is_refused(spark):
    with pytest.raises(ValueError):
        order_struct(spark.createDataFrame([("a",)], "v string"), [("v", "desc")])


def test_running_first_equals_window(spark):
    rows = [("a", dt.date(2020, 1, 2), "m"), ("a", dt.date(2020, 1, 1), "z"), ("a", dt.date(2020, 1, 1), "k"), ("b", dt.date(2021, 1, 1), None)]
    df = spark.createDataFrame(rows, "inn string, pay_date date, manager string")
    window = Window.partitionBy("inn").orderBy("pay_date", "manager")
    want = df.select("inn", F.min("pay_date").over(window).alias("pay_date"), F.first("manager").over(window).alias("manager")).distinct()
    assert sorted(map(repr, running_first(df, ["inn"], "pay_date", "manager").collect())) == sorted(map(repr, want.collect()))
