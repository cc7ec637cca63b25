"""The jobs, for spark-submit:

    spark-submit tidemark/jobs.py land   --lake s3a://lake --servers broker:9092
    spark-submit tidemark/jobs.py silver --lake s3a://lake
    spark-submit tidemark/jobs.py stream --lake s3a://lake --limit 100
    spark-submit tidemark/jobs.py gold   --lake s3a://lake
    spark-submit tidemark/jobs.py check  --lake s3a://lake
    spark-submit tidemark/jobs.py export --lake s3a://lake --out s3a://exports --files 1
    spark-submit tidemark/jobs.py run    --lake s3a://lake --servers broker:9092

``stream`` does what ``silver`` does by micro-batches, from where its checkpoints stand. Topics are read from Kafka, or with ``--inbox`` from files of Kafka-shaped rows, one folder per topic.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Sequence
from datetime import date

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.checks import CHECKS, run_suite
from tidemark.plans.marts import FIRST_DAY, LAST_DAY, MARTS, published_marts, star_models
from tidemark.plans.models import resolve, sql_models
from tidemark.plans.run import ChecksFailed, read_silver, refresh_silver, run_lakehouse, silver_sources, silver_table
from tidemark.plans.staging import STAGING
from tidemark.schemas import CDC_TABLES, CLICK_TOPIC, TOPICS, TableSpec
from tidemark.session import configure, side_by_side
from tidemark.sources.bronze import bronze_table, stream_bronze
from tidemark.sources.export import export_tables, exported
from tidemark.sources.topics import read_topic
from tidemark.streaming.apply import apply_cdc_stream
from tidemark.streaming.clicks import refine_clickstream_stream
from tidemark.streaming.landing import land_topics


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Lakehouse jobs")
    parser.add_argument("job", choices=["land", "silver", "stream", "gold", "check", "export", "run"])
    parser.add_argument("--lake", required=True, help="folder that holds bronze, silver and gold")
    parser.add_argument("--servers", help="Kafka bootstrap servers")
    parser.add_argument("--inbox", help="folder with one sub-folder of message files per topic")
    parser.add_argument("--buckets", type=int, default=64, help="hash buckets of a current-state table")
    parser.add_argument("--first", type=date.fromisoformat, default=FIRST_DAY, help="first day of the date dimension")
    parser.add_argument("--last", type=date.fromisoformat, default=LAST_DAY, help="last day of the date dimension")
    parser.add_argument("--limit", type=int, help="messages (Kafka) or files to a micro-batch, for land, stream and run")
    parser.add_argument("--models", help="folder of further .sql models to build beside the star schema, for gold")
    parser.add_argument("--database", help="database that shows the star schema, for gold and check")
    parser.add_argument("--out", help="export folder")
    parser.add_argument("--files", type=int, help="files per exported table")
    return parser.parse_args(argv)


def topics(spark: SparkSession, args: argparse.Namespace) -> dict[str, DataFrame]:
    if args.inbox:
        return {t: read_topic(spark, t, fmt="parquet", path=f"{args.inbox.rstrip('/')}/{t}", limit=args.limit) for t in TOPICS}
    return {t: read_topic(spark, t, servers=args.servers, limit=args.limit) for t in TOPICS}


def stream_silver(spark: SparkSession, bronze: str, silver: str, buckets: int, limit: int | None) -> None:
    """Apply and refine what the raw tables hold beyond the checkpoints, all tables at the same time."""

    def table(spec: TableSpec) -> Callable[[], None]:
        target = silver_table(spark, silver, spec, buckets)
        rows = stream_bronze(spark, f"{bronze}/{spec.topic}", limit)
        return lambda: apply_cdc_stream(rows, spec, target, f"{silver}/_checkpoints/{spec.name}").awaitTermination()

    def clicks() -> None:
        rows = stream_bronze(spark, f"{bronze}/{CLICK_TOPIC}", limit)
        refine_clickstream_stream(spark, rows, f"{silver}/clickstream", f"{silver}/_checkpoints/clickstream").awaitTermination()

    side_by_side({"clickstream": clicks, **{name: table(spec) for name, spec in CDC_TABLES.items()}})


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = arguments(argv)
    spark = configure(spark or SparkSession.builder.appName(f"tidemark-{args.job}").getOrCreate())
    lake = args.lake.rstrip("/")
    bronze, silver, gold = f"{lake}/bronze", f"{lake}/silver", f"{lake}/gold"
    match args.job:
        case "land":
            land_topics(topics(spark, args), bronze)
        case "silver":
            raw = {t: bronze_table(spark, f"{bronze}/{t}") for t in TOPICS}
            for name, changes in refresh_silver(spark, raw, silver, args.buckets).items():
                print(name, changes)
        case "stream":
            stream_silver(spark, bronze, silver, args.buckets, args.limit)
        case "gold":
            models = star_models(args.first, args.last)
            further = sql_models(args.models) if args.models else []
            tables = resolve(silver_sources(silver, args.buckets).openers(spark), models + further)
            wanted = (*MARTS, *(model.name for model in further))
            published_marts(spark, gold, args.database, args.buckets).publish({name: tables[name] for name in wanted})
        case "check":
            staging = resolve(silver_sources(silver, args.buckets).openers(spark), star_models(), STAGING)
            marts = published_marts(spark, gold, args.database, args.buckets).read()
            report = run_suite({**staging, **marts}, CHECKS).orderBy("check_name").collect()
            for line in report:
                print("pass" if line["passed"] else "FAIL", line["check_name"], line["violations"])
            return 0 if all(line["passed"] for line in report) else 1
        case "export":
            if not args.out:
                raise SystemExit("export needs --out")
            for name, rows in export_tables(read_silver(spark, silver, args.buckets), args.out, args.files).items():
                print(name, rows, exported(spark, args.out).path(name))
        case "run":
            try:
                run_lakehouse(
                    spark, topics(spark, args), lake, first=args.first, last=args.last, buckets=args.buckets
                )
            except ChecksFailed as failure:
                print(failure)
                return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
