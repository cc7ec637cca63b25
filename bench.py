"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``queries`` are seconds per registered query, over raw and current-state tables that were stored before (``prepare``).
``comparisons`` (with --compare) set our way of doing something against the obvious other way, on the same input.
"""

from __future__ import annotations

import base64
import json
import os
import sys
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.functions import decimal_from_base64  # noqa: E402
from tidemark.operators import latest_changes, parse_envelope  # noqa: E402
from tidemark.operators.checks import CHECKS, run_suite  # noqa: E402
from tidemark.plans.marts import build_staging  # noqa: E402
from tidemark.plans.run import silver_table  # noqa: E402
from tidemark.schemas import ORDERS, TOPICS  # noqa: E402
from tidemark.session import local_session, work_path  # noqa: E402
from tidemark.streaming.apply import apply_batch  # noqa: E402
from workloads import domain, logs, stores  # noqa: E402
from workloads.queries import REGISTRY  # noqa: E402

HEADLINE = [
    "bronze_land_orders",
    "bronze_land_topics",
    "decode_decimal",
    "cdc_latest",
    "cdc_merge",
    "cdc_stream_apply",
    "cdc_history",
    "silver_orders",
    "silver_order_items",
    "silver_clickstream",
    "clickstream_incremental",
    "clickstream_stream_dedup",
    "dim_date",
    "fact_orders",
    "fact_clickstream",
    "dq_suite",
    "reconcile_order_totals",
    "bq1_revenue_day",
    "bq1_revenue_month",
    "bq2_top_products",
    "bq2_trend",
    "bq3_funnel_users",
    "bq3_funnel_ordered",
    "bq3_stream_counts",
    "bq4_time_to_convert",
    "bq4_sessions",
    "bq5_delivery_by_city",
    "bq6_cancel_stage",
    "bq7_payment_methods",
    "full_run",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def alternate(actions: dict[str, Callable[[], object]], rounds: int = 4) -> dict[str, float]:
    """Best time of each action, taken in turns and without the first round, so that none profits from its place."""
    times = [{name: timed(action) for name, action in actions.items()} for _ in range(rounds)]
    return {name: min(t[name] for t in times[1:]) for name in actions}


def compare(spark, sf_dir: str) -> dict[str, float]:
    out: dict[str, float] = {}
    orders = stores.silver(spark, sf_dir, "orders")
    path = work_path(spark, "wire")
    coded = logs.decimal_to_base64(F.col("total_amount")).alias("x")
    orders.select("id", coded, F.explode(F.sequence(F.lit(1), F.lit(20)))).write.parquet(path)
    wire = spark.read.parquet(path)

    @F.udf("double")
    def by_row(text):
        return int.from_bytes(base64.b64decode(text), "big", signed=True) / 100

    out |= alternate(
        {
            "decode_builtin": lambda: drain(wire.select(decimal_from_base64(F.col("x"), 14))),
            "decode_python_udf": lambda: drain(wire.select(by_row("x").cast("decimal(14,2)"))),
        }
    )

    bronze = stores.bronze_of(spark, sf_dir, "orders")
    changes = parse_envelope(bronze, ORDERS, before=()).select("row_key", "op", "after", "partition", "offset")
    last = F.max_by(F.struct("op", "after", "partition"), "offset").alias("last")
    whole = F.max("offset").over(Window.partitionBy("row_key")).alias("m")
    out |= alternate(
        {
            "latest_row_number": lambda: drain(latest_changes(bronze, ORDERS)),
            "latest_max_by": lambda: drain(changes.groupBy("row_key").agg(last)),
            "latest_whole_window": lambda: drain(changes.select("*", whole).filter("m = offset")),
        }
    )

    target = silver_table(spark, work_path(spark, "silver"), ORDERS, 64)
    apply_batch(bronze, ORDERS, target)
    few = bronze.filter("offset % 6400 < 8")  # the changes of 1 in 800 orders
    out |= alternate(
        {
            "merge_few_changes": lambda: apply_batch(few, ORDERS, target),
            "rebuild_from_all": lambda: apply_batch(
                bronze, ORDERS, silver_table(spark, work_path(spark, "silver"), ORDERS, 64)
            ),
        }
    )

    staging = build_staging(stores.all_silver(spark, sf_dir))
    rowwise = [c for c in CHECKS if c.table in staging and c.kind in ("not_null", "accepted_values")]
    out |= alternate(
        {
            "row_checks_fused": lambda: drain(run_suite(staging, rowwise)),
            "row_checks_one_by_one": lambda: [drain(run_suite(staging, [c])) for c in rowwise],
        }
    )
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    stores.ensure_work_folder(spark)
    wanted = [a for a in sys.argv[1:] if not a.startswith("-")] or HEADLINE

    def prepare() -> None:
        for name in domain.SILVER:
            stores.silver_path(spark, sf_dir, name)
        for topic in TOPICS:
            stores.topic_path(spark, sf_dir, topic)
            stores.bronze(spark, sf_dir, topic)

    prepared = timed(prepare)
    seconds = {name: timed(lambda: drain(REGISTRY[name](spark, sf_dir))) for name in wanted}
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "prepare": prepared,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if "--compare" in sys.argv:
        line["comparisons"] = compare(spark, sf_dir)
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
