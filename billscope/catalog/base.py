"""Registry and the tables a query reads."""

from __future__ import annotations

import datetime as dt
import tempfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from billscope.params import ReportParams
from billscope.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = dt.date(1998, 6, 1)
EVENTS_AS_OF = dt.date(2024, 1, 15)
PARAMS = ReportParams(as_of=AS_OF, first_pay_date=dt.date(1995, 6, 1))


class Tables:
    """Lazy access to the Parquet tables of one scale factor; each is opened once."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        setattr(self, name, table)
        return table


def with_folder(spark: SparkSession) -> SparkSession:
    """Local runs without a checkpoint folder (tests, benchmark) get a temporary one; clusters name theirs."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and context.getCheckpointDir() is None and context.master.startswith("local["):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="billscope-"))
    return spark


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name`` together with the SQL it must agree with."""

    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(tune(with_folder(spark)), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
