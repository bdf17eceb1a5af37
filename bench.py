"""Time the headline operators and print one JSON line.

The raw tables are derived from $BENCH_SF_DIR and written once; every layer then reads the
written one below it, as a build does. A write step is timed after one warm-up; each query runs to
a discarding sink: one warm-up, then the median of three runs, building the plan included.
"""

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from marginfold.operators import checks, fact, reports, staging, views  # noqa: E402
from marginfold.plans.build import build_analytics, build_staging  # noqa: E402
from marginfold.plans.mart import Mart  # noqa: E402
from marginfold.schemas import RAW_COLUMNS  # noqa: E402
from marginfold.session import configured  # noqa: E402
from marginfold.sources.layers import Layer  # noqa: E402
from marginfold.sources.scratch import scratch_folder  # noqa: E402
from marginfold.sources.tpch import write_raw_layer  # noqa: E402

RUNS = 3


def timed(action):
    start = time.perf_counter()
    result = action()
    return time.perf_counter() - start, result


def second_of_two(action):
    """A write step, timed after one warm-up."""
    action()
    return timed(action)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    spark = (
        configured(SparkSession.builder.master(f"local[{cpus}]"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="marginfold-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    root = scratch_folder(spark)
    seconds = {}
    seconds["write_raw_layer"], _ = second_of_two(lambda: write_raw_layer(spark, folder, root))
    raw = Layer(spark, root, "raw", list(RAW_COLUMNS))
    seconds["write_staging_layer"], stage = second_of_two(lambda: build_staging(spark, root))
    seconds["write_analytics_layer"], built = second_of_two(lambda: build_analytics(stage, root))
    lines = built["fact_order_items"]
    orders, payments = stage["stg_orders"], stage["stg_order_payments"]
    funnel = stage["stg_channel_summary"]

    steps = {
        "stage_orders": lambda: staging.stage_orders(raw["orders"]),
        "stage_order_items": lambda: staging.stage_order_items(raw["order_items"], orders, raw["products"]),
        "stage_payments": lambda: staging.stage_payments(raw["order_payments"], orders),
        "fact_order_items": lambda: fact.fact_order_items(
            stage["stg_order_items"], orders, stage["stg_customers"], payments, funnel
        ),
        "summary_by_month": lambda: reports.summary_by_month(lines),
        "category_profitability": lambda: reports.category_profitability(lines),
        "loss_making_orders": lambda: reports.loss_making_orders(lines),
        "customer_profitability": lambda: reports.customer_profitability(lines),
        "cac_by_channel": lambda: reports.cac_by_channel(lines, funnel),
        "profit_waterfall": lambda: reports.profit_waterfall(lines),
        "reconcile_revenue": lambda: checks.reconcile_revenue(raw["order_items"], raw["orders"], lines),
        "reconcile_fee": lambda: checks.reconcile_fee(lines, payments),
        "reconcile_discount": lambda: checks.reconcile_discount(lines, orders),
        "check_cascade": lambda: checks.check_cascade(lines),
        "check_fact_integrity": lambda: checks.check_fact_integrity(lines),
        "sanity_summary": lambda: checks.sanity_summary(lines),
        "fact_explorer": lambda: views.fact_explorer(lines),
        "waterfall_from_raw_layer": lambda: Mart(raw).rpt_profit_waterfall,
    }
    for name, build in steps.items():
        runs = [timed(lambda: build().write.format("noop").mode("overwrite").save())[0] for _ in range(1 + RUNS)]
        seconds[name] = statistics.median(runs[1:])

    seconds = {name: round(value, 3) for name, value in seconds.items()}
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
