import json
from datetime import datetime, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_decode import wire
from tidemark.operators import (
    change_history,
    latest_changes,
    parse_envelope,
    split_changes,
)
from tidemark.operators.changes import decode_failures
from tidemark.plans.run import silver_table
from tidemark.schemas import BRONZE_SCHEMA, PRODUCTS
from tidemark.streaming.apply import apply_batch, refresh_table

START = datetime(2024, 1, 1)


def image(id_, cents=100, **changes):
    return {"id": id_, "name": f"p{id_}", "category": "toys", "price": wire(cents), "stock": 5, **changes}


def message(op, before, after, offset, partition=0):
    value = None if op is None else json.dumps({"schema": {}, "payload": {"before": before, "after": after, "op": op}})
    return (None, value, PRODUCTS.topic, partition, offset, START + timedelta(minutes=offset), START)


def raw(value, offset, partition=0):
    return (None, value, PRODUCTS.topic, partition, offset, START, START)


def bronze(spark, rows):
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def prices(df):
    return {r["id"]: r["price"] for r in df.select("id", "price").collect()}


LOG = [
    message("r", None, image(1), 0),
    message("c", None, image(2, 200), 1),
    message("u", image(1), image(1, -150), 2),
    message("d", image(2, 200), None, 3),
    message(None, None, None, 4),
    message("c", None, image(3, 300), 5),
    message("d", image(3, 300), None, 6),
    message("c", None, image(3, 333), 7),
    message("d", image(9), None, 8),
]


def test_envelope_keeps_usable_messages(spark):
    odd = [
        raw("{broken", 20),
        raw(json.dumps({"payload": {"op": "u"}}), 21),
        raw(json.dumps({"other": 1}), 22),
        raw(json.dumps({"payload": {"before": None, "after": image("x"), "op": "c"}}), 23),
        raw(json.dumps({"payload": {"before": None, "after": image("77"), "op": "c"}}), 24),
        raw(json.dumps({"payload": {"before": None, "after": image(2**40), "op": "c"}}), 25),
        raw(None, 26),
    ]
    parsed = parse_envelope(bronze(spark, LOG + odd), PRODUCTS)
    assert sorted((r["offset"], r["row_key"], r["op"]) for r in parsed.collect()) == [
        (0, 1, "r"),
        (1, 2, "c"),
        (2, 1, "u"),
        (3, 2, "d"),
        (5, 3, "c"),
        (6, 3, "d"),
        (7, 3, "c"),
        (8, 9, "d"),
        (24, 77, "c"),
        (25, 2**40, "c"),
    ]


def test_one_odd_column_does_not_lose_the_row(spark):
    log = [message("c", None, image(1, stock="many"), 0), message("c", None, image(2, price="####"), 1)]
    upserts, _ = split_changes(latest_changes(bronze(spark, [*log]), PRODUCTS), PRODUCTS)
    got = {r["id"]: (r["price"], r["stock"], r["name"]) for r in upserts.collect()}
    assert got == {1: (Decimal("1.00"), None, "p1"), 2: (None, 5, "p2")}
    failures = {(r["column_name"], r["failures"]) for r in decode_failures(bronze(spark, log), PRODUCTS).collect()}
    assert failures == {("id", 0), ("price", 1), ("stock", 1)}


def test_parsed_once_and_limited_before_the_shuffle(spark):
    plan = latest_changes(bronze(spark, LOG), PRODUCTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    assert "row_number(), 1, Partial" in plan


def test_latest_and_split(spark):
    upserts, deletes = split_changes(latest_changes(bronze(spark, LOG), PRODUCTS), PRODUCTS)
    assert prices(upserts) == {1: Decimal("-1.50"), 3: Decimal("3.33")}
    assert sorted(r["id"] for r in deletes.collect()) == [2, 9]


def test_merge_and_metrics(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    assert apply_batch(bronze(spark, LOG[:2]), PRODUCTS, target) == {"inserted": 2, "updated": 0, "deleted": 0}
    assert apply_batch(bronze(spark, LOG[2:]), PRODUCTS, target) == {"inserted": 1, "updated": 1, "deleted": 1}
    assert prices(target.read()) == {1: Decimal("-1.50"), 3: Decimal("3.33")}


def test_merge_ignores_what_is_older(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    apply_batch(bronze(spark, LOG), PRODUCTS, target)
    for part in (LOG[:3], LOG):
        assert apply_batch(bronze(spark, part), PRODUCTS, target) == {"inserted": 0, "updated": 0, "deleted": 0}
    assert prices(target.read()) == {1: Decimal("-1.50"), 3: Decimal("3.33")}


def jobs_of(spark, action):
    spark.sparkContext.setJobGroup("counted", "")
    result = action()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")), result


def test_metrics_cost_no_job(spark, folder):
    """The first load is the write, its pointer and the probes; nothing is counted afterwards."""
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    n, result = jobs_of(spark, lambda: apply_batch(bronze(spark, LOG), PRODUCTS, target))
    assert result["inserted"] == 2
    m, _ = jobs_of(spark, lambda: target.read().count())
    assert n <= 6 and m >= 1


def test_empty_batch(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    assert refresh_table(bronze(spark, []), PRODUCTS, target) == {"inserted": 0, "updated": 0, "deleted": 0}
    assert not target.exists()
    assert target.read().count() == 0


def test_refresh_is_repeatable(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    log = bronze(spark, LOG)
    assert refresh_table(log, PRODUCTS, target) == {"inserted": 2, "updated": 0, "deleted": 0}
    assert refresh_table(log, PRODUCTS, target) == {"inserted": 0, "updated": 0, "deleted": 0}
    assert prices(target.read()) == {1: Decimal("-1.50"), 3: Decimal("3.33")}


def test_history(spark):
    versions = change_history(bronze(spark, LOG), PRODUCTS).collect()
    minute = lambda offset: START + timedelta(minutes=offset)
    got = sorted((r["id"], r["valid_from"], r["valid_to"], r["is_current"]) for r in versions if r["id"] != 9)
    assert got == sorted(
        [
            (1, minute(0), minute(2), False),
            (1, minute(2), None, True),
            (2, minute(1), minute(3), False),
            (3, minute(5), minute(6), False),
            (3, minute(7), None, True),
        ],
        key=lambda r: (r[0], r[1]),
    )


def test_history_of_hot_keys_is_the_same(spark):
    log = [message("c", None, image(n % 3), n * 7, partition=0) for n in range(60)]
    whole = change_history(bronze(spark, log), PRODUCTS)
    sliced = change_history(bronze(spark, log), PRODUCTS, slice_seconds=1000)
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, sliced.collect()), key=str)


@st.composite
def logs_and_cuts(draw):
    """A log of valid per-key sequences, and where it is cut into batches."""
    alive, rows = set(), []
    for offset in range(draw(st.integers(1, 14))):
        key = draw(st.integers(1, 4))
        if key in alive and draw(st.booleans()):
            alive.discard(key)
            rows.append(message("d", image(key), None, offset))
        else:
            alive.add(key)
            rows.append(message("u", None, image(key, offset), offset))
    cuts = sorted(draw(st.sets(st.integers(1, len(rows)), max_size=2)))
    return rows, [0, *cuts, len(rows)]


@settings(
    max_examples=4,
    deadline=None,
    phases=[Phase.explicit, Phase.generate],
    suppress_health_check=list(HealthCheck),
)
@given(logs_and_cuts())
def test_any_batching_gives_the_same_state(spark, case):
    from tidemark.session import work_path

    rows, cuts = case
    target = silver_table(spark, work_path(spark, "test"), PRODUCTS, buckets=2)
    for low, high in zip(cuts, cuts[1:]):
        if high > low:
            apply_batch(bronze(spark, rows[low:high]), PRODUCTS, target)
    whole, _ = split_changes(latest_changes(bronze(spark, rows), PRODUCTS), PRODUCTS)
    assert prices(target.read()) == prices(whole)


def test_only_touched_buckets_are_rewritten(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=8)
    apply_batch(bronze(spark, [message("c", None, image(n), n) for n in range(40)]), PRODUCTS, target)
    before = set(target.read().inputFiles())
    apply_batch(bronze(spark, [message("u", None, image(7, 777), 100)]), PRODUCTS, target)
    after = set(target.read().inputFiles())
    bucket = target.touched(spark.createDataFrame([(7,)], "id bigint"))
    assert len(bucket) == 1
    assert {f for f in before - after} == {f for f in before if f"_bucket={bucket[0]}/" in f}
    assert target.superseded() == sorted(before - after)
    assert prices(target.read())[7] == Decimal("7.77")
    assert target.read().count() == 40


def test_a_table_may_become_empty(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    apply_batch(bronze(spark, [message("c", None, image(1), 0)]), PRODUCTS, target)
    apply_batch(bronze(spark, [message("d", image(1), None, 1)]), PRODUCTS, target)
    assert target.read().count() == 0
    apply_batch(bronze(spark, [message("c", None, image(1, 5), 2)]), PRODUCTS, target)
    assert prices(target.read()) == {1: Decimal("0.05")}


def test_committed_batch_is_not_applied_again(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    batch = bronze(spark, LOG)
    apply_batch(batch, PRODUCTS, target, token="stream#0")
    apply_batch(batch, PRODUCTS, target, token="stream#0")
    assert target.version() == 0


def test_failed_commit_leaves_the_table_alone(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    apply_batch(bronze(spark, LOG[:2]), PRODUCTS, target)
    state = prices(target.read())
    # Data of a next version without its pointer, as a crash would leave it.
    orphan = target.read().select("*", target.bucket_of(F.col("id")).alias("_bucket"))
    orphan.write.partitionBy("_bucket").parquet(f"{target.root}/data/v=1")
    assert prices(target.read()) == state
    apply_batch(bronze(spark, LOG[2:]), PRODUCTS, target)
    assert prices(target.read()) == {1: Decimal("-1.50"), 3: Decimal("3.33")}


def test_rejects_are_kept_and_counted(spark):
    from tidemark.operators import parse_envelope, reject_counts, rejects

    odd = [raw("{bad", 20), raw("", 21), raw('{"schema": {}}', 22), raw('{"payload": {"op": "c", "after": {"id": "x"}}}', 23), raw(None, 24)]
    rows = bronze(spark, LOG + odd)
    found = {r.reason: r.messages for r in reject_counts(rows, PRODUCTS).collect()}
    assert found == {"tombstone": 2, "malformed": 2, "no_payload": 1, "no_key": 1}
    assert rejects(rows, PRODUCTS).count() + parse_envelope(rows, PRODUCTS).count() == rows.count()


def test_a_key_that_moves_to_another_partition_does_not_revert(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    old, new = message("c", None, image(1, 100), 5), (*message("u", image(1), image(1, 200), 0, partition=1)[:5], START + timedelta(hours=1), START)
    assert prices(split_changes(latest_changes(bronze(spark, [old, new]), PRODUCTS), PRODUCTS)[0]) == {1: Decimal("2.00")}
    apply_batch(bronze(spark, [old]), PRODUCTS, target)
    assert apply_batch(bronze(spark, [new]), PRODUCTS, target) == {"inserted": 0, "updated": 1, "deleted": 0}
    for _ in range(2):
        assert refresh_table(bronze(spark, [old, new]), PRODUCTS, target) == {"inserted": 0, "updated": 0, "deleted": 0}
        assert apply_batch(bronze(spark, [old]), PRODUCTS, target) == {"inserted": 0, "updated": 0, "deleted": 0}
        assert prices(target.read()) == {1: Decimal("2.00")}


def test_a_replay_does_not_bring_deleted_rows_back(spark, folder):
    target = silver_table(spark, folder, PRODUCTS, buckets=4)
    made, gone = message("c", None, image(1), 0), message("d", image(1), None, 1)
    for part in ([made], [gone], [made]):
        apply_batch(bronze(spark, part), PRODUCTS, target)
    assert target.read().count() == 0
    again = apply_batch(bronze(spark, [message("c", None, image(1, 5), 2)]), PRODUCTS, target)
    assert again == {"inserted": 1, "updated": 0, "deleted": 0} and prices(target.read()) == {1: Decimal("0.05")}


def moved(op, before, after, offset, partition, hour):
    return (*message(op, before, after, offset, partition)[:5], START + timedelta(hours=hour), START)


#: A key that moves to another partition at lower offsets, one that is deleted and comes back, one that stays.
MOVING = [
    moved("c", None, image(1, 100), 5, 0, 1),
    moved("u", image(1), image(1, 200), 0, 1, 2),
    moved("u", image(1), image(1, 300), 1, 1, 3),
    moved("c", None, image(2, 10), 6, 0, 1),
    moved("d", image(2), None, 7, 0, 4),
    moved("c", None, image(2, 20), 2, 1, 5),
    moved("u", image(2), image(2, 30), 8, 0, 6),
    moved("c", None, image(3, 1), 9, 0, 2),
]


def versions(df):
    return sorted((r["id"], r["price"], r["valid_from"], r["valid_to"] or datetime.max, r["is_current"]) for r in df.collect())


def test_history_of_a_key_that_moves(spark):
    at = lambda hour: START + timedelta(hours=hour)
    found = versions(change_history(bronze(spark, MOVING), PRODUCTS))
    assert [v for v in found if v[0] == 1] == [
        (1, Decimal("1.00"), at(1), at(2), False),
        (1, Decimal("2.00"), at(2), at(3), False),
        (1, Decimal("3.00"), at(3), datetime.max, True),
    ]
    assert [v[2:4] for v in found if v[0] == 2] == [(at(1), at(4)), (at(5), at(6)), (at(6), datetime.max)]


def test_history_grows_to_the_same(spark, folder):
    """Whatever the order of arrival, and when messages come again."""
    from tidemark.streaming import History

    want = versions(change_history(bronze(spark, MOVING), PRODUCTS))
    orders = {"in order": [MOVING[:1], MOVING[1:4], MOVING[4:]], "late": [MOVING[5:], MOVING[2:5], MOVING[:2]], "again": [MOVING[:6], MOVING[2:], MOVING]}
    for name, arrivals in orders.items():
        history = History(spark, f"{folder}/{name}", PRODUCTS, buckets=2)
        for part in arrivals:
            history.extend(bronze(spark, part))
        assert versions(history.read()) == want, name
    assert not spark.read.parquet(f"{folder}/in order/closed").isEmpty()


def test_a_run_that_failed_leaves_the_history_alone(spark, folder):
    from tidemark.streaming import History

    history = History(spark, folder, PRODUCTS, buckets=2)
    history.extend(bronze(spark, MOVING[:4]))
    before = versions(history.read())
    # Closed versions of a next run without its commit, as a crash would leave them.
    spark.read.parquet(f"{folder}/closed/run=0").write.parquet(f"{folder}/closed/run=1")
    assert versions(history.read()) == before
    history.extend(bronze(spark, MOVING[4:]))
    assert versions(history.read()) == versions(change_history(bronze(spark, MOVING), PRODUCTS))


def test_one_parse_tells_keys_reasons_and_images(spark):
    from tidemark.operators import reject_counts, rejects

    for df in (rejects(bronze(spark, LOG), PRODUCTS), reject_counts(bronze(spark, LOG), PRODUCTS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("from_json(") == 1 and "get_json_object" not in plan
