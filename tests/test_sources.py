import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from billscope.session import RunTables, cut, cut_counted, scratch_path, shared_dir
from billscope.sources.readers import CONTROL_CSV, first_candidate, on_days, period_from_path, read_control_csv, typed_landing
from billscope.sources.sinks import append_rows, csv_export, expire_versions, full_refresh, replace_days


def test_control_csv_round_trip(spark):
    root = scratch_path(spark, "t")
    df = spark.createDataFrame([("a, b\n;", 1), (None, 2)], "item string, sku int")
    df.write.options(**CONTROL_CSV).csv(f"{root}/202306_bricks.csv")
    df.write.options(**CONTROL_CSV).csv(f"{root}/202307_bricks.csv")
    got = read_control_csv(spark, [f"{root}/202306_bricks.csv", f"{root}/202307_bricks.csv"])
    assert dict(got.dtypes) == {"item": "string", "sku": "int"}
    tagged = got.withColumn("period", period_from_path(r"(\d+)_bricks\.csv")).collect()
    assert sorted((r["period"], r["sku"]) for r in tagged) == [("202306", 1), ("202306", 2), ("202307", 1), ("202307", 2)]
    assert {r["item"] for r in tagged} == {"a, b\n;", None}


def test_on_days_prunes_partitions(spark):
    path = scratch_path(spark, "days")
    df = spark.createDataFrame([(dt.date(2023, 7, d), d) for d in range(20, 31)], "date date, n int")
    df.write.partitionBy("date").parquet(path)
    week = on_days(spark.read.parquet(path), "date", dt.date(2023, 7, 22), 7)
    assert sorted(r["n"] for r in week.collect()) == list(range(22, 29))
    plan = week._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_typed_landing(spark):
    df = spark.createDataFrame([("5", "2024-01-01"), ("x", "2024-01-02")], "n string, d string")
    spec = {"n": (F.col("n"), "int"), "d": (F.col("d"), "date")}
    assert [tuple(r) for r in typed_landing(df, spec, required=["d"]).collect()] == [(5, dt.date(2024, 1, 1)), (None, dt.date(2024, 1, 2))]
    with pytest.raises(PySparkException):
        typed_landing(df, spec, strict=["n"]).collect()
    with pytest.raises(PySparkException, match="n is missing"):
        typed_landing(df, spec, required=["n"]).collect()


def test_first_candidate_of_empty_array(spark):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "k int, c array<string>")
    got = first_candidate(df, "c", "a")
    assert got.columns == ["k", "a"] and {tuple(r) for r in got.collect()} == {(1, "x"), (2, None), (3, None)}


def test_full_refresh_may_read_its_own_target(spark):
    folder, name = scratch_path(spark, "target"), "refresh_own"
    full_refresh(spark.range(8), name, folder)
    full_refresh(spark.table(name).where("id > 2"), name, folder)
    assert sorted(r["id"] for r in spark.table(name).collect()) == [3, 4, 5, 6, 7]
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("step", ["write", "switch"])
def test_a_failed_refresh_leaves_the_old_table(spark, monkeypatch, step):
    folder, name = scratch_path(spark, "target"), f"refresh_fails_{step}"
    full_refresh(spark.range(3), name, folder)
    rows = spark.range(9)
    if step == "write":
        rows = rows.withColumn("id", F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")))
    else:
        ask = type(spark).sql
        monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(ValueError("lost")) if "ALTER" in text else ask(self, text, *a, **k))
    with pytest.raises(Exception):
        full_refresh(rows, name, folder)
    monkeypatch.undo()
    assert sorted(r["id"] for r in spark.table(name).collect()) == [0, 1, 2]
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("single", [True, False])
def test_csv_export_is_one_file_where_asked(spark, single):
    path = scratch_path(spark, "out.csv")
    df = spark.range(40).repartition(4).select("id", F.lit('q"uote, comma').alias("text"))
    csv_export(df, path, single_file=single)
    back = spark.read.options(header=True, escape='"').csv(path)
    assert back.count() == 40 and {r["text"] for r in back.collect()} == {'q"uote, comma'}
    assert (len(back.inputFiles()) == 1) == single


def test_run_tables_go_with_their_owner(spark):
    with RunTables(spark) as tables:
        kept = cut(spark.range(3), "step")
        assert kept.inputFiles()[0].replace("file://", "").startswith(tables.path.replace("file://", ""))
        rows = kept.collect()
    assert len(rows) == 3
    with pytest.raises(PySparkException):
        spark.read.parquet(tables.path).count()


def test_shared_dir_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def day_rows(spark, *rows):
    return spark.createDataFrame([(dt.date(2024, 1, d), n) for d, n in rows], "day date, n int")


def test_a_rerun_replaces_its_days_only(spark):
    path = scratch_path(spark, "by_day")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    replace_days(day_rows(spark, (1, 10), (2, 20), (2, 21), (3, 30)), path, "day", days)
    replace_days(day_rows(spark, (4, 40)), path, "day")
    for _ in range(2):  # the second run doubles nothing; the third day has no rows any more
        replace_days(day_rows(spark, (2, 22)), path, "day", days[1:])
    read = spark.read.schema("n int, day date").parquet(path)
    assert sorted((r["day"].day, r["n"]) for r in read.collect()) == [(1, 10), (2, 22), (4, 40)]
    one = on_days(read, "day", dt.date(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(PySparkException, match="day outside the run"):
        replace_days(day_rows(spark, (5, 50)), path, "day", days)


def test_old_versions_expire(spark):
    folder, table = scratch_path(spark, "versions"), "billscope_expiring"
    for n in range(3):
        full_refresh(day_rows(spark, (1, n)), table, folder)
    assert expire_versions(table, folder, spark) == 2 and expire_versions(table, folder, spark) == 0
    assert [r["n"] for r in spark.table(table).collect()] == [2]
    spark.sql(f"DROP TABLE {table}")


def test_a_partitioned_table_is_not_refreshed(spark):
    spark.sql(f"CREATE TABLE billscope_parted (n int, day date) USING parquet PARTITIONED BY (day) LOCATION '{scratch_path(spark, 'parted')}'")
    with pytest.raises(ValueError, match="partitioned"):
        full_refresh(day_rows(spark, (1, 1)), "billscope_parted", scratch_path(spark, "x"))
    spark.sql("DROP TABLE billscope_parted")


def test_counts_come_from_the_write(spark):
    rows, seen = cut_counted(spark.range(1000), "counted", big=F.count(F.when(F.col("id") > 900, 1)))
    assert seen == {"n": 1000, "big": 99} and rows.count() == 1000
    assert cut_counted(spark.range(0).where("id > 5"), "none")[1]["n"] == 0
