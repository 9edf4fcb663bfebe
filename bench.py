"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and the cores.
With query names as arguments only those run.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from billscope.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "pipe_daily_sales",
    "pipe_brick_distribution",
    "pipe_prolongation",
    "pipe_revenue",
    "pipe_segmentation",
    "pipe_active_report",
    "pipe_trial_onboarding",
    "pipe_months_active",
    "pipe_user_inn_map",
    "semi_exists",
    "anti_not_in",
    "join_next_in_seq",
    "join_self_rollup",
    "join_like_dict",
    "join_address_match",
    "win_keep_latest",
    "win_first_value",
    "row_identity",
    "agg_string",
    "agg_count_distinct",
    "pivot_static",
    "recursive_months",
    "fn_utm_payload",
    "full_refresh",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    names = list(QUERIES) if names == ["all"] else names
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("billscope-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
