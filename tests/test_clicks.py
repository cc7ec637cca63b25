import json
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.operators import high_water, new_rows, parse_clicks, refine_clickstream
from tidemark.schemas import BRONZE_SCHEMA, CLICK_SILVER_SCHEMA, CLICK_TOPIC
from tidemark.streaming import refine_clickstream_stream

NOW = datetime(2024, 1, 1)


def event(id_, partition, offset, **changes):
    body = {
        "event_id": id_,
        "user_id": 1,
        "event_type": "search",
        "product_id": 2,
        "timestamp": "2024-01-01T10:00:00+00:00",
        "device": "mobile",
        "session_id": "s",
        **changes,
    }
    return (None, json.dumps(body), CLICK_TOPIC, partition, offset, NOW, NOW)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def ids(df):
    return sorted((r["event_id"], r["_bronze_partition"], r["_bronze_offset"]) for r in df.collect())


# Two partitions whose offsets overlap; "a" is delivered twice in the first batch and again in the second.
FIRST = [event("a", 0, 0), event("b", 1, 0), event("a", 1, 1)]
SECOND = [event("a", 0, 1), event("c", 1, 2), event("c", 0, 2), event("d", 2, 0)]


def test_parse(spark):
    odd = [event("x", 0, 9, timestamp="yesterday", user_id="7"), (None, "{bad", CLICK_TOPIC, 0, 10, NOW, NOW)]
    got = {r["_bronze_offset"]: r for r in parse_clicks(bronze(spark, FIRST[:1] + odd)).collect()}
    assert parse_clicks(bronze(spark, odd)).schema.names == CLICK_SILVER_SCHEMA.names
    assert got[0]["timestamp"] == datetime(2024, 1, 1, 10)
    assert (got[9]["event_id"], got[9]["timestamp"], got[9]["user_id"]) == ("x", None, 7)
    assert got[10]["event_id"] is None


def test_first_run_keeps_first_delivery(spark):
    assert ids(refine_clickstream(bronze(spark, FIRST))) == [("a", 0, 0), ("b", 1, 0)]


def test_copies_are_dropped_before_the_shuffle(spark):
    plan = refine_clickstream(bronze(spark, FIRST))._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_next_run_adds_only_what_is_new(spark):
    silver = refine_clickstream(bronze(spark, FIRST))
    added = refine_clickstream(bronze(spark, FIRST + SECOND), silver)
    assert ids(added) == [("c", 0, 2), ("d", 2, 0)]
    whole = silver.unionByName(added)
    assert ids(refine_clickstream(bronze(spark, FIRST + SECOND), whole)) == []


def test_progress_is_kept_per_partition(spark):
    progress = spark.createDataFrame([(0, 0), (1, 1)], "partition int, last_offset bigint")
    left = new_rows(bronze(spark, FIRST + SECOND), progress)
    assert sorted((r["partition"], r["offset"]) for r in left.collect()) == [(0, 1), (0, 2), (1, 2), (2, 0)]
    nothing = progress.filter(F.lit(False))
    assert new_rows(bronze(spark, FIRST), nothing).count() == 3


def test_progress_reaches_the_scan(spark, folder):
    bronze(spark, FIRST).write.parquet(folder)
    progress = spark.createDataFrame([(0, 0)], "partition int, last_offset bigint")
    stored = spark.read.schema(BRONZE_SCHEMA).parquet(folder)
    plan = new_rows(stored, progress)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(offset,0)" in plan


def test_high_water(spark):
    silver = refine_clickstream(bronze(spark, SECOND))
    assert sorted(map(tuple, high_water(silver).collect())) == [(0, 2), (2, 0)]


def test_streaming_form_equals_batch_form(spark, folder):
    for part in (FIRST, SECOND, SECOND[:0]):
        bronze(spark, part).write.mode("append").parquet(f"{folder}/bronze")
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{folder}/bronze")
        refine_clickstream_stream(spark, stream, f"{folder}/silver", f"{folder}/checkpoint").awaitTermination()
    stored = spark.read.parquet(f"{folder}/silver")
    assert ids(stored) == [("a", 0, 0), ("b", 1, 0), ("c", 0, 2), ("d", 2, 0)]


def test_events_without_an_id_stay_and_stay_once(spark):
    raw = bronze(spark, [*FIRST, event(None, 0, 5), event(None, 0, 6), event(None, 1, 5)])
    silver = refine_clickstream(raw)
    unnamed = [(None, 0, 5), (None, 0, 6), (None, 1, 5)]
    assert sorted((r["_bronze_partition"], r["_bronze_offset"]) for r in silver.filter("event_id IS NULL").collect()) == [
        x[1:] for x in unnamed
    ]
    for _ in range(2):
        assert refine_clickstream(raw, silver).count() == 0


def test_events_without_an_id_are_stored_once_by_every_checkpoint(spark, folder):
    raw = bronze(spark, [*FIRST, event(None, 0, 5), event(None, 0, 6), event(None, 1, 5)])
    raw.write.parquet(f"{folder}/bronze")
    for run in range(3):
        stream = spark.readStream.schema(BRONZE_SCHEMA).parquet(f"{folder}/bronze")
        refine_clickstream_stream(spark, stream, f"{folder}/silver", f"{folder}/checkpoint-{run}").awaitTermination()
        assert spark.read.parquet(f"{folder}/silver").count() == 5
