"""Run registered queries next to their SQL in DuckDB and compare names, types and rows.

python -m tests.compare [scale] [query …]
"""

from __future__ import annotations

import decimal
import sys
import time
from pathlib import Path

import duckdb

TESTDATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


def oracle(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql) -> str | None:
    """None when both agree, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    duck_types = {d[0]: str(d[1]) for d in found.description}
    for name, kind in df.dtypes:
        if SPARK_TO_DUCK.get(kind, kind) != duck_types[name]:
            return f"type of {name}: {kind} != {duck_types[name]}"
    expected = rows_of(names, found.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(expected) != len(actual):
        return f"rows {len(actual)} != {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"row {got} != {want}"
    return None


def session():
    from pyspark.sql import SparkSession

    from billscope.catalog.base import with_folder

    spark = (
        SparkSession.builder.master("local[8]")
        .appName("billscope-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return with_folder(spark)


def main(argv: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry

    scale, wanted = (argv[0] if argv else "sf0.001"), argv[1:]
    sf_dir = f"{TESTDATA}/{scale}"
    spark, con = session(), oracle(sf_dir)
    queries, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, sqls[name]) if name in sqls else f"no oracle, {df.count()} rows"
            n = "" if problem else f"{len(con.execute(sqls[name]).fetchall())} rows"
        except Exception as error:  # report and go on with the next query
            problem, n = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {n} {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
