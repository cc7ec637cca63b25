from datetime import date, datetime
from decimal import Decimal

import pytest

from tidemark.plans import dim_date, fact_orders
from tidemark.schemas import CDC_TABLES
from tidemark.sources import SourceBinding, table_exists

NOON = datetime(2024, 5, 6, 12)


@pytest.fixture
def tables(spark):
    items = [(n, 1, 100 + n, n % 3 + 1, Decimal("2.50")) for n in range(20)]
    items += [(30, 2, 101, 1, Decimal("1.00")), (31, 3, 101, 2, Decimal("9.99")), (32, 404, 101, 1, Decimal("1.00"))]
    orders = [(1, 5, NOON, "paid", Decimal("0")), (2, 5, NOON, "pending", Decimal("0")), (3, 6, NOON, "cancelled", Decimal("0"))]
    payments = [(1, 1, "cod", Decimal("1"), "success", NOON), (2, 3, "cod", Decimal("1"), "failed", None)]
    payments += [(n, 3, "e_wallet", Decimal("1"), "success", NOON) for n in range(10, 18)]
    return (
        spark.createDataFrame(items, "order_item_id bigint, order_id bigint, product_id bigint, quantity int, price decimal(12,2)"),
        spark.createDataFrame(orders, "order_id bigint, user_id bigint, order_date timestamp, status string, total_amount decimal(14,2)"),
        spark.createDataFrame(payments, "payment_id bigint, order_id bigint, payment_method string, amount decimal(14,2), status string, paid_at timestamp"),
    )


def test_fact_orders(tables):
    fact = fact_orders(*tables)
    got = {r["order_item_id"]: r for r in fact.filter("order_id <> 3").collect()}
    assert sorted(got) == [*range(20), 30]
    assert got[2]["line_total"] == Decimal("7.50")
    assert (got[2]["payment_status"], got[30]["payment_status"]) == ("success", None)
    assert got[2]["date_key"] == 20240506
    # Several payments of one order repeat its lines.
    assert fact.filter("order_item_id = 31").count() == 9


def test_dim_date(spark):
    days = dim_date(spark).orderBy("date_key").collect()
    assert len(days) == 1096
    assert tuple(days[0]) == (20240101, date(2024, 1, 1), 2024, 1, 1, 1, "January", "Monday")
    assert tuple(days[59]) == (20240229, date(2024, 2, 29), 2024, 2, 29, 4, "February", "Thursday")
    assert days[-1]["full_date"] == date(2026, 12, 31)
    assert dim_date(spark, date(2019, 1, 1), date(2019, 1, 3)).count() == 3


def test_sources(spark, folder, tables):
    binding = SourceBinding(folder + "/{name}", tuple(CDC_TABLES))
    assert not table_exists(spark, binding.path("orders"))
    tables[1].write.parquet(binding.path("orders"))
    assert table_exists(spark, binding.path("orders"))
    binding.register(spark, only=["orders"])
    assert spark.sql("SELECT count(*) AS n FROM orders").first()["n"] == 3
    assert binding.openers(spark)["orders"]().count() == 3
    with pytest.raises(KeyError):
        binding.path("invoices")
    doubled = SourceBinding(folder + "/{name}", ("orders",), opener=lambda s, name, path: s.read.parquet(path).union(s.read.parquet(path)))
    assert doubled.read(spark, "orders").count() == 6


def test_existence_probe_does_not_hide_other_errors(spark):
    with pytest.raises(Exception, match="nosuchfs"):
        table_exists(spark, "nosuchfs://host/path")
