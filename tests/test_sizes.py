"""What one task or one file is given does not follow the size of the tables."""

import re
import time
from glob import glob

from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_changes import MOVING, PRODUCTS, bronze
from tidemark import operators as op
from tidemark.operators.changes import latest_typed_changes
from tidemark.plans.questions import funnel_ordered
from tidemark.plans.run import silver_table
from tidemark.schemas import CDC_TABLES, ORDERS, PAYMENTS
from tidemark.session import TASK_BYTES, _bytes, configure
from tidemark.sources.snapshots import SnapshotTable
from tidemark.streaming.apply import apply_batch
from workloads import domain, stores
from workloads.queries import REGISTRY, _fact_clicks, _silver_facts


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_tasks_are_bounded(spark):
    try:
        for given, want in (("64m", dict.fromkeys(TASK_BYTES)), ("1m", dict.fromkeys(TASK_BYTES, 1 << 20))):
            for name in TASK_BYTES:
                spark.conf.set(name, given)
            configure(spark)
            for name, most in TASK_BYTES.items():
                assert _bytes(spark.conf.get(name)) == (want[name] or most)
    finally:
        for name in TASK_BYTES:
            spark.conf.unset(name)
        configure(spark)
    assert [_bytes(s) for s in ("67108864b", "16m", "1GB", "512")] == [64 << 20, 16 << 20, 1 << 30, 512]


def test_orders_are_made_from_stored_lines(spark, monkeypatch):
    """Where lines and orders are both needed, the given lines are grouped once."""
    grouped = []
    plain = domain.SILVER["order_items"], domain.order_items
    monkeypatch.setattr(stores, "_written", {})
    monkeypatch.setitem(domain.SILVER, "order_items", lambda *a: grouped.append(1) or plain[0](*a))
    monkeypatch.setattr(domain, "order_items", lambda *a: grouped.append(1) or plain[1](*a))
    stores.all_silver(spark, SMALL)
    assert len(grouped) == 1


def test_topics_are_made_from_stored_tables(spark):
    """Lines are grouped once, not again for every topic that needs orders."""
    payments = stores.messages(spark, SMALL, PAYMENTS.topic)
    assert not [f for f in payments.inputFiles() if "lineitem" in f]
    assert "Join" not in plan(stores.messages(spark, SMALL, ORDERS.topic))


def test_amounts_are_encoded_once_an_order(spark):
    text = plan(stores.messages(spark, SMALL, ORDERS.topic))
    assert len(re.findall("base64|Base64", text)) == 1


def test_history_is_chained_once_a_run(spark, folder, monkeypatch):
    from tidemark.streaming import History, history as module

    calls = []
    plain = module.chained
    monkeypatch.setattr(module, "chained", lambda *a: calls.append(1) or plain(*a))
    history = History(spark, folder, PRODUCTS, buckets=2)
    for part in (MOVING[4:], MOVING[:4], MOVING):
        history.extend(bronze(spark, part))
    assert len(calls) == 3


def test_reasons_need_keys_only(spark):
    counted = plan(op.reject_counts(stores.bronze_of(spark, SMALL, "orders"), CDC_TABLES["orders"]))
    assert "total_amount" not in counted


def test_a_backlog_has_files_by_its_size(spark, monkeypatch):
    frame = stores.topic_frame(spark, SMALL, ORDERS.topic)
    path = f"{stores.work_path(spark, 'larger')}"
    frame.repartition(3).write.parquet(path)
    monkeypatch.setattr(stores, "topic_frame", lambda *_: spark.read.parquet(path))
    base = path.rsplit("/", 1)[0]
    before = set(glob(f"{base}/backlog-*"))
    rows = REGISTRY["bronze_rate_limited"](spark, SMALL).collect()
    (root,) = set(glob(f"{base}/backlog-*")) - before
    assert len(glob(f"{root}/inbox/*.parquet")) == 18
    assert all(r["several_batches"] for r in rows) and sum(r["messages"] for r in rows) == frame.count()


def test_a_merge_meets_the_stored_rows_once(spark, folder, monkeypatch):
    """Stored rows are read and shuffled by one join, whatever they and the changes hold."""
    target = silver_table(spark, folder, PRODUCTS, buckets=2)
    plans = []
    commit = SnapshotTable.commit
    monkeypatch.setattr(SnapshotTable, "commit", lambda self, rows, *a: plans.append(plan(rows)) or commit(self, rows, *a))
    done = [apply_batch(bronze(spark, part), PRODUCTS, target) for part in (MOVING[:4], MOVING[4:], MOVING)]
    assert [re.findall(r"Join (\w+),", p) for p in plans[1:]] == [["FullOuter"]] * 2
    assert done[2] == dict.fromkeys(done[2], 0)


def test_a_payment_meets_its_user_once(spark):
    """Not once a line of its order."""
    assert "Aggregate [order_id" in plan(funnel_ordered(_fact_clicks(spark, SMALL), _silver_facts(spark, SMALL)))


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_what_was_shuffled_goes_with_the_action(spark, folder):
    before = shuffle_files(spark)
    spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count().write.parquet(folder)
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left
    assert glob(f"{folder}/*.zstd.parquet") and spark.read.parquet(folder).count() == 100


def test_changes_are_decoded_before_they_are_shuffled(spark):
    text = latest_typed_changes(bronze(spark, MOVING), PRODUCTS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json(") == 1 and "row_number(), 1, Partial" in text
    assert text.index("conv(") > text.rindex("Exchange hashpartitioning")


def test_a_run_of_the_history_leaves_no_shuffle_behind(spark, folder):
    """Nor a folder of its own: what is worked on lies where the next run writes."""
    from tidemark.streaming import History

    before, held = shuffle_files(spark), spark.sparkContext._jsc.getPersistentRDDs().size()
    history = History(spark, folder, PRODUCTS, buckets=2)
    for part in (MOVING[4:], MOVING[:4], MOVING):
        history.extend(bronze(spark, part))
    assert len(glob(f"{folder}/_work/*")) == 5
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    assert not left and spark.sparkContext._jsc.getPersistentRDDs().size() <= held
