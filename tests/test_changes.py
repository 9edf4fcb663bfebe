import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from billscope.functions.values import differs_or_missing
from billscope.operators.aggregates import count_distinct, dense_ids, dynamic_pivot, pivot_by_name, quoted_list, string_agg
from billscope.operators.changes import (
    delete_groups,
    delete_where,
    only_new,
    outbox,
    override,
    update_from,
    update_where_exists,
)
from billscope.operators.checks import landed_summary, require_allowed, require_rows, unknown_values, unmapped_values


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark):
    return spark.createDataFrame([("a", "x"), ("b", None), ("c", "z"), (None, "n")], "k string, v string")


def test_update_from_sets_different_and_missing(spark, table):
    news = spark.createDataFrame([("a", "x2"), ("b", "y2"), ("c", "z"), ("d", "q"), ("a", "x2")], "k string, w string")
    got = update_from(table, news, "k", {"v": "w"}, lambda new: differs_or_missing(F.col("v"), new["w"]))
    assert rows(got) == sorted([("a", "x2"), ("b", "y2"), ("c", "z"), (None, "n")], key=str)


def test_update_guard_that_is_unknown_keeps_the_row(spark, table):
    news = spark.createDataFrame([("a", "x2"), ("b", "y2")], "k string, w string")
    got = update_from(table, news, "k", {"v": "w"}, lambda new: F.col("v") != new["w"])
    assert rows(got) == sorted([("a", "x2"), ("b", None), ("c", "z"), (None, "n")], key=str)


def test_ambiguous_update_fails(spark, table):
    news = spark.createDataFrame([("a", "1"), ("a", "2")], "k string, w string")
    with pytest.raises(PySparkException, match="ambiguous"):
        update_from(table, news, "k", {"v": "w"}, lambda new: F.lit(True)).collect()


def test_update_where_exists(spark, table):
    keys = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    got = update_where_exists(table, keys, "k", "v", F.lit("new"), F.col("v").isNull())
    assert rows(got) == sorted([("a", "x"), ("b", "new"), ("c", "z"), (None, "n")], key=str)


def test_delete_keeps_rows_with_unknown_condition(table):
    assert rows(delete_where(table, F.col("v") == "x")) == sorted([("b", None), ("c", "z"), (None, "n")], key=str)


def test_delete_groups(spark, table):
    facts = spark.createDataFrame([("a", 1), ("a", -1), ("c", 5)], "k string, m int")
    got = delete_groups(table, facts, "k", F.col("total") == 0, total=F.sum("m"))
    assert rows(got) == sorted([("b", None), ("c", "z"), (None, "n")], key=str)


def test_second_insert_is_a_no_op(spark, table):
    new = spark.createDataFrame([("a", "1"), ("e", "2")], "k string, v string")
    once = table.unionByName(only_new(new, table, "k"))
    assert only_new(new, once, "k").count() == 0 and once.count() == 5


def test_override(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, n int")
    assert rows(override(base, spark.createDataFrame([("a", 9)], "k string, n int"), "k")) == [("a", 9), ("b", 2)]


def test_outbox_without_rows_has_no_header(spark):
    some = spark.createDataFrame([("c1",), ("c2",)], "card string")
    header, body = outbox(some, {"task_id": F.lit("t")}, 50)
    assert rows(header) == [("t", 1, 50)] and body.count() == 2
    header, body = outbox(some.where("card = ''"), {"task_id": F.lit("t")}, 50)
    assert header.count() == 0


def test_string_agg_sorts_keeps_copies_and_skips_null(spark):
    df = spark.createDataFrame([("a", "y", 1), ("a", "x", 2), ("a", "y", 3), ("a", None, 4), ("b", None, 5), (None, "q", 6)], "k string, v string, n int")
    got = string_agg(df, ["k"], "v", "; ", "list", sums={"n": "total"})
    assert rows(got) == sorted([("a", "x; y; y", 10), ("b", None, 5), (None, "q", 6)], key=str)
    assert string_agg(df.where("k = 'z'"), [], "v", ";", "list").first()[0] is None


def test_pivots(spark):
    df = spark.createDataFrame([(1, "x", 2), (1, "x", 3), (1, "other", 9), (2, "y", 4)], "num int, cat string, cost int")
    assert rows(pivot_by_name(df, ["num"], "cat", ["x", "y", "absent"], "cost")) == [(1, 5, None, None), (2, None, 4, None)]
    found = dynamic_pivot(df, ["num"], "cat", "cost")
    assert found.columns == ["num", "other", "x", "y"]
    assert rows(found.select("num", "x", "y")) == rows(pivot_by_name(df, ["num"], "cat", ["x", "y"], "cost"))
    assert quoted_list(df, "cat", "cols").first()[0] == "[other],[x],[y]"


def test_allowed_values(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "c string")
    assert require_allowed(df, "c", ["a", "b"]).count() == 3
    assert unknown_values(df, "c", ["a"]).first()[0] == 1
    with pytest.raises(PySparkException, match="outside the allowed list: b"):
        require_allowed(df, "c", ["a"]).collect()


def test_unmapped_and_empty_input(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "g string")
    known = spark.createDataFrame([("c",)], "g string")
    assert sorted(r[0] for r in unmapped_values(df, "g", known).collect()) == ["a", "b"]
    assert unmapped_values(known, "g", df).collect() == []
    with pytest.raises(ValueError, match="nothing"):
        require_rows(df.where("g = 'z'"), "nothing")


def test_landed_summary_counts_in_one_pass(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",), ("x",)], "v string")
    rows, seen = landed_summary(df, "v", ["a", "b"])
    assert seen == {"n": 5, "n_missing": 1, "n_outside": 1} and rows.count() == 5
    with pytest.raises(ValueError, match="nothing"):
        require_rows(df.where("v = 'q'"), "nothing")


def test_distinct_counts_by_bitmaps(spark):
    """One key holds most rows; numbers reach into several bitmaps and lie on their borders."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 == 7, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.when(F.col("id") % 97 > 0, (F.col("id") * 7919) % 40_000).alias("number"),
    )
    edges = spark.createDataFrame([("edge", n) for n in (0, 32_767, 32_768, 32_769, 65_535, 65_536, 65_536)] + [("none", None)], "k string, number long")
    df = rows.unionByName(edges)
    want = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.countDistinct("number").alias("n")).collect()}
    assert {r["k"]: r["n"] for r in count_distinct(df, ["k"], "number", "n").collect()} == want
    texts = df.select("k", F.concat(F.lit("v"), F.col("number")).alias("v"))
    ids = dense_ids(texts, "v", "number")
    assert sorted(r["number"] for r in ids.collect()) == list(range(ids.count()))
    assert {r["k"]: r["n"] for r in count_distinct(texts.join(ids, "v", "left"), ["k"], "number", "n").collect()} == want
