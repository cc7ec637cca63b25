import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.plans import fact_orders
from tidemark.plans.marts import build_marts, build_staging, published_marts, stored_by_order
from tidemark.plans.questions import top_products
from tidemark.sources import Published, export_tables, exported
from workloads import domain, stores


def name_of(folder):
    return f"t{folder[-12:]}"


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_old_or_new_never_some_of_each(spark, folder):
    tables = Published(spark, folder, name_of(folder))
    assert (tables.version(), tables.read()) == (-1, {})
    old = {"a": spark.range(5), "b": spark.range(3)}
    tables.publish(old)
    held = tables.read()
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        tables.publish({"a": spark.range(7), "b": broken})
    for one in (tables, Published(spark, folder, name_of(folder))):
        assert one.version() == 0
        assert {n: t.count() for n, t in one.read().items()} == {"a": 5, "b": 3}
    assert spark.table(f"{name_of(folder)}.a").count() == 5
    assert any(n.startswith("a__set_") for n in tables.superseded())  # what the failed write left
    tables.publish({"a": spark.range(7), "c": spark.range(1)})
    assert (tables.version(), sorted(tables.read())) == (1, ["a", "c"])
    assert spark.table(f"{name_of(folder)}.a").count() == 7
    # Who read before goes on with what was current then.
    assert held["a"].count() == 5


def test_another_session_attaches_buckets(spark, folder, no_broadcast):
    key = {"left": "k", "right": "k"}
    left = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("x"))
    Published(spark, folder, name_of(folder), key, 4).publish({"left": left, "right": left.select("k").distinct()})
    other = f"{name_of(folder)}_other"  # a catalog that has never heard of them
    found = Published(spark, folder, other, key, 4).read()
    joined = found["left"].join(found["right"], "k")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 1000
    Published(spark, folder, other, key, 4).show()
    assert spark.table(f"{other}.right").count() == 100


def test_hot_key_and_empty_tables(spark, folder):
    hot = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    stored = Published(spark, folder, name_of(folder), {"hot": "k", "none": "k"}, 4).publish({"hot": hot, "none": hot.filter("false")})
    assert stored["hot"].groupBy().agg(F.count("*"), F.sum("id")).first() == (3000, 2999 * 1500)
    assert stored["none"].count() == 0 and stored["none"].columns == ["k", "id"]
    with pytest.raises(ValueError, match="database"):
        Published(spark, folder, keys={"hot": "k"})


def test_facts_of_stored_orders_shuffle_nothing(spark, folder, no_broadcast):
    staging = build_staging(stores.all_silver(spark, SMALL))
    parts = ("stg_order_items", "stg_orders", "stg_payments")
    stored = stored_by_order(spark, staging, folder, name_of(folder), 4)
    fact = fact_orders(*[stored[n] for n in parts], by_order=True)
    assert "Exchange" not in plan(fact)
    assert rows(fact) == rows(fact_orders(*[staging[n] for n in parts]))


def test_lines_are_told_apart_without_a_shuffle(spark, folder, no_broadcast):
    silver = {n: stores.silver(spark, SMALL, n) for n in domain.SILVER}
    marts = build_marts(spark, build_staging(silver))
    gold = published_marts(spark, folder, buckets=4).publish(marts)
    # One exchange by product and month, one by product, and one to pick the best: none for the lines.
    assert "order_item_id" not in "".join(x for x in plan(top_products(gold["fact_orders"], gold["dim_products"])).split("\n") if "Exchange" in x)
    assert rows(top_products(gold["fact_orders"], gold["dim_products"])) == rows(top_products(marts["fact_orders"], marts["dim_products"]))


def test_failed_export_leaves_the_old_one(spark, folder):
    assert export_tables({"orders": spark.range(10)}, folder, files=1) == {"orders": 10}
    path = exported(spark, folder).path("orders")
    broken = spark.range(4).select(F.raise_error(F.lit("no")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="no"):
        export_tables({"orders": broken}, folder)
    assert exported(spark, folder).path("orders") == path
    assert len(spark.read.parquet(path).inputFiles()) == 1
    assert spark.read.parquet(path).count() == 10
