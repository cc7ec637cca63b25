import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.operators import run_suite
from tidemark.operators.checks import CHECKS
from tidemark.plans.marts import build_marts, build_staging, published_marts
from tidemark.plans.run import ChecksFailed, run_lakehouse, silver_table
from tidemark.schemas import BRONZE_SCHEMA, CLICK_SILVER_SCHEMA, CLICK_TOPIC, ORDERS, TOPICS, USERS
from tidemark.sources import bronze_table, read_bronze, read_topic, stream_bronze
from tidemark.sources.progress import Marks, Progress
from tidemark.streaming import (
    apply_cdc_stream,
    compact_state,
    deliveries,
    first_deliveries,
    keep_state,
    land_topic,
    land_topics,
    read_state,
    stage_counts,
    write_stream,
)
from tidemark.streaming.apply import apply_batch, refresh_table
from workloads import stores


def test_topic_options(spark):
    with pytest.raises(ValueError, match="servers"):
        read_topic(spark, "t")
    with pytest.raises(ValueError, match="path"):
        read_topic(spark, "t", fmt="parquet")


def test_landing_resumes(spark, folder):
    inbox, out = f"{folder}/inbox", f"{folder}/out"
    users = spark.read.parquet(stores.topic_path(spark, SMALL, USERS.topic))
    clicks = spark.read.parquet(stores.topic_path(spark, SMALL, CLICK_TOPIC))
    total = users.count()

    def land():
        land_topic(read_topic(spark, USERS.topic, fmt="parquet", path=inbox), out, f"{folder}/cp").awaitTermination()
        return read_bronze(spark, out).count()

    users.filter("offset % 2 = 0").write.mode("append").parquet(inbox)
    clicks.write.mode("append").parquet(inbox)
    first = land()
    assert 0 < first < total
    assert land() == first
    users.filter("offset % 2 = 1").write.mode("append").parquet(inbox)
    assert land() == total
    landed = read_bronze(spark, out)
    assert landed.select("topic").distinct().collect() == [(USERS.topic,)]
    assert landed.filter("ingested_at IS NULL").count() == 0
    assert landed.schema.names == BRONZE_SCHEMA.names


def test_a_failing_topic_is_reported_after_the_others(spark, folder):
    good = stores.topic_stream(spark, SMALL, USERS.topic)
    bad = good.withColumn("value", F.raise_error(F.lit("unreadable")).cast("binary"))
    with pytest.raises(Exception, match="unreadable"):
        land_topics({"bad": bad, "good": good}, folder)
    assert read_bronze(spark, f"{folder}/good").count() > 0


def test_cdc_stream_replay(spark, folder):
    """A micro-batch whose commit succeeded but whose checkpoint did not is skipped when it runs again."""
    raw = f"{folder}/bronze"
    stores.bronze_of(spark, SMALL, "users").write.parquet(raw)
    target = silver_table(spark, folder, USERS, buckets=4)

    def run(checkpoint):
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(raw)
        apply_cdc_stream(stream, USERS, target, checkpoint).awaitTermination()

    run(f"{folder}/cp")
    state = sorted(map(tuple, target.read().collect()))
    version = target.version()
    first = target.pointer().token
    assert first.endswith("#0")
    run(f"{folder}/cp")
    assert target.version() == version
    # A new checkpoint reads everything again; older and equal changes are recognised.
    run(f"{folder}/cp2")
    assert sorted(map(tuple, target.read().collect())) == state
    # It begins with batch 0 as well, which must not be taken for the first one's.
    assert target.version() == version + 1
    assert target.pointer().token.endswith("#0") and target.pointer().token != first


def test_stage_counts_wait_for_the_watermark(spark, folder):
    stream = spark.readStream.schema(CLICK_SILVER_SCHEMA).parquet(stores.silver_path(spark, SMALL, "clickstream"))
    write_stream(stage_counts(stream, width="1 hour"), f"{folder}/out", f"{folder}/cp").awaitTermination()
    counted = spark.read.parquet(f"{folder}/out")
    clicks = stores.silver(spark, SMALL, "clickstream")
    last = clicks.agg(F.max("timestamp")).first()[0]
    assert counted.filter(F.col("window_end") > F.lit(last) - F.expr("INTERVAL 1 HOUR")).count() == 0
    closed = clicks.filter(
        F.date_trunc("hour", "timestamp") + F.expr("INTERVAL 1 HOUR") <= F.lit(last) - F.expr("INTERVAL 1 HOUR")
    )
    assert counted.agg(F.sum("events")).first()[0] == closed.count()


def test_all_checks_pass_on_clean_tables(spark):
    staging = build_staging(stores.all_silver(spark, SMALL))
    marts = build_marts(spark, staging, date(2019, 1, 1), date(2026, 12, 31))
    report = run_suite({**staging, **marts}, CHECKS).collect()
    assert len(report) == 38
    assert [r["check_name"] for r in report if not r["passed"]] == []


def test_whole_run_twice(spark, folder):
    def topics():
        return {topic: stores.topic_stream(spark, SMALL, topic) for topic in TOPICS}

    span = {"first": date(2019, 1, 1), "last": date(2026, 12, 31), "buckets": 4}
    result = run_lakehouse(spark, topics(), folder, strict=False, **span)
    assert result.changes["orders"]["inserted"] > 0
    assert result.changes["orders"]["deleted"] == 0
    assert result.marts["fact_orders"].count() > 0
    # Lines and payments of deleted orders are left without their order; everything else holds.
    assert sorted(r["check_name"] for r in result.report.filter("NOT passed").collect()) == [
        "relationships_stg_order_items_order_id",
        "relationships_stg_payments_order_id",
    ]
    assert result.changes["clickstream"]["inserted"] == stores.silver(spark, SMALL, "clickstream").count()
    counts = {name: df.count() for name, df in result.marts.items()}
    with pytest.raises(ChecksFailed, match="2 checks failed"):
        run_lakehouse(spark, topics(), folder, **span)
    shown = published_marts(spark, f"{folder}/gold", buckets=4).read()
    assert {name: df.count() for name, df in shown.items()} == counts
    assert ORDERS.topic in TOPICS


def test_another_bucket_count_is_refused(spark, folder):
    from pyspark.sql import types as T

    from tidemark.sources.snapshots import SnapshotTable

    schema = T.StructType([T.StructField("id", T.LongType())])
    SnapshotTable(spark, folder, schema, buckets=4).commit(spark.range(20))
    assert SnapshotTable(spark, folder, schema, buckets=4).read().count() == 20
    with pytest.raises(ValueError, match="4 buckets"):
        SnapshotTable(spark, folder, schema, buckets=8).read()


def test_raw_tables_are_laid_out_by_day(spark, folder):
    """The days before the last refresh are neither listed nor read by the next one."""
    inbox, raw = f"{folder}/inbox", f"{folder}/raw"
    users = spark.read.parquet(stores.topic_path(spark, SMALL, USERS.topic))
    progress, target = Progress(spark, f"{folder}/progress"), silver_table(spark, folder, USERS, buckets=4)
    assert progress.read() is None
    middle = users.agg(F.max("offset")).first()[0] // 2
    for day in (1, 2):
        users.filter((F.col("offset") <= middle) == F.lit(day == 1)).write.mode("append").parquet(inbox)
        stream = read_topic(spark, USERS.topic, fmt="parquet", path=inbox)
        land_topic(stream, raw, f"{folder}/cp", ingested_at=F.lit(f"2025-01-0{day} 10:00:00").cast("timestamp")).awaitTermination()
        fresh = (progress.read() or Marks()).rows_after(bronze_table(spark, raw))
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        days = {str(r[0]) for r in fresh.select("ingest_date").distinct().collect()}
        if day == 2:
            assert "PartitionFilters: [((ingest_date" in plan or "PartitionFilters: [(ingest_date" in plan
            assert days == {"2025-01-02"}
        result = refresh_table(bronze_table(spark, raw), USERS, target, progress)
        assert result["inserted"] + result["updated"] > 0
        assert progress.read().day == date(2025, 1, day)
        assert refresh_table(bronze_table(spark, raw), USERS, target, progress) == {"inserted": 0, "updated": 0, "deleted": 0}
    assert target.read().count() == stores.silver(spark, SMALL, "users").count()
    assert read_bronze(spark, raw, since=date(2025, 1, 2)).count() < read_bronze(spark, raw).count() == users.count()
    assert read_bronze(spark, raw).schema.names == BRONZE_SCHEMA.names


def test_marks_are_those_of_the_stored_rows_where_none_are_kept(spark, folder):
    from tidemark.streaming.apply import known_marks

    target = silver_table(spark, folder, USERS, buckets=4)
    raw = stores.bronze_of(spark, SMALL, "users")
    assert known_marks(Progress(spark, f"{folder}/p"), target) == Marks()
    refresh_table(raw, USERS, target)
    assert known_marks(Progress(spark, f"{folder}/p"), target) == known_marks(None, target) != Marks()
    assert refresh_table(raw, USERS, target, Progress(spark, f"{folder}/p")) == {"inserted": 0, "updated": 0, "deleted": 0}


def test_a_backlog_comes_in_pieces(spark, folder):
    users = spark.read.parquet(stores.topic_path(spark, SMALL, USERS.topic))
    users.repartition(5).write.parquet(f"{folder}/inbox")
    stream = read_topic(spark, USERS.topic, fmt="parquet", path=f"{folder}/inbox", limit=2)
    query = land_topic(stream, f"{folder}/raw", f"{folder}/cp")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    assert read_bronze(spark, f"{folder}/raw").count() == users.count()


def test_state_survives_a_restart(spark, folder):
    """State from a checkpoint goes on; another checkpoint reads everything again and changes nothing."""
    orders = stores.bronze_of(spark, SMALL, "orders")
    raw, out = f"{folder}/raw", f"{folder}/state"
    target = silver_table(spark, folder, ORDERS, buckets=4)
    for low, high in ((0, 1), (1, 3), (3, 8)):
        part = orders.filter((F.col("offset") % 8 >= low) & (F.col("offset") % 8 < high))
        part.write.mode("append").parquet(raw)
        apply_batch(part, ORDERS, target)
        query = keep_state(spark.readStream.schema(BRONZE_SCHEMA).parquet(raw), ORDERS, out, f"{folder}/cp")
        query.awaitTermination()
        assert sorted(map(tuple, read_state(spark, out, ORDERS).collect())) == sorted(map(tuple, target.read().collect()))
        keys = part.filter("value IS NOT NULL").select("key").distinct().count()
        assert spark.read.parquet(f"{out}/query={query.id}/batch={query.lastProgress['batchId']}").count() <= keys
    state = sorted(map(tuple, target.read().collect()))
    keep_state(spark.readStream.schema(BRONZE_SCHEMA).parquet(raw), ORDERS, out, f"{folder}/cp2").awaitTermination()
    assert sorted(map(tuple, read_state(spark, out, ORDERS).collect())) == state
    assert compact_state(spark, out, f"{folder}/compact", ORDERS) > 0
    assert sorted(map(tuple, read_state(spark, f"{folder}/compact", ORDERS).collect())) == state
    assert read_state(spark, f"{folder}/nothing", ORDERS).count() == 0


def test_first_deliveries_keep_bounded_state(spark, folder, at):
    import json

    def event(id_, hour, offset):
        body = {"event_id": id_, "user_id": 1, "event_type": "search", "timestamp": "2024-01-01T10:00:00Z"}
        return (None, json.dumps(body), CLICK_TOPIC, 0, offset, at(hour), at(hour))

    arrivals = [
        [event("a", 1, 0), event("b", 5, 1), event(None, 5, 2), event(None, 5, 3), event("b", 5, 4)],
        [event("b", 6, 5), event("c", 6, 6), event(None, 6, 7)],
        [event("a", 1, 8), event("d", 2, 9), event("e", 20, 10)],  # two too late, one of them never seen before
        [event("b", 20, 11), event("e", 21, 12)],  # "b" is forgotten by now
    ]
    seen = []
    for rows in arrivals:
        spark.createDataFrame(rows, BRONZE_SCHEMA).write.mode("append").parquet(f"{folder}/raw")
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{folder}/raw")
        query = write_stream(first_deliveries(stream, "3 hours"), f"{folder}/out", f"{folder}/cp")
        query.awaitTermination()
        seen.append(tuple(deliveries(query).values()))
    assert seen == [(5, 1, 0), (3, 1, 0), (3, 0, 2), (2, 1, 0)]
    stored = spark.read.schema(CLICK_SILVER_SCHEMA).parquet(f"{folder}/out").collect()
    assert sorted(r.event_id or "-" for r in stored) == ["-", "-", "-", "a", "b", "b", "c", "e"]


def test_a_start_opens_the_state_as_files(spark, folder):
    """Nothing of earlier runs is applied again when a run starts, and the last position of a key wins over runs."""
    raw, out, checkpoint = f"{folder}/raw", f"{folder}/state", f"{folder}/cp"

    def message(key, status, partition, offset, hour, op="u"):
        image = f'{{"id":{key},"status":"{status}"}}'
        before, after = (image, "null") if op == "d" else ("null", image)
        value = f'{{"payload":{{"before":{before},"after":{after},"op":"{op}"}}}}'
        return {"value": value, "partition": partition, "offset": offset, "timestamp": datetime(2024, 1, 1, hour)}

    arrivals = [
        [message(1, "pending", 0, 0, 1), message(1, "paid", 0, 1, 1), message(2, "paid", 1, 7, 5), message(3, "paid", 0, 2, 1)],
        [message(1, "paid", 0, 3, 2, "d"), message(2, "pending", 2, 9, 4), message(3, "shipped", 2, 0, 3)],
        [message(3, "paid", 0, 2, 1), message(4, "paid", 0, 4, 6)],
    ]
    for rows in arrivals:
        full = [tuple(row.get(name) for name in BRONZE_SCHEMA.names) for row in rows]
        part = spark.createDataFrame(full, BRONZE_SCHEMA)
        part.write.mode("append").parquet(raw)
        keep_state(spark.readStream.schema(BRONZE_SCHEMA).parquet(raw), ORDERS, out, checkpoint).awaitTermination()
    found = sorted((r.id, r.status) for r in read_state(spark, out, ORDERS).collect())
    assert found == [(2, "paid"), (3, "shipped"), (4, "paid")]
    stored = [name for _, _, names in os.walk(f"{checkpoint}/state") for name in names]
    assert any(name.endswith(".zip") for name in stored)
    assert not any(name.endswith(".changelog") for name in stored)
