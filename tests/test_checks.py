import pytest

from tidemark.operators import Check, accepted_values, not_null, relationships, run_suite, unique
from tidemark.operators.checks import CHECKS


@pytest.fixture
def orders(spark):
    rows = [(1, 10, "paid"), (2, 10, "lost"), (2, 11, "lost"), (None, None, None), (None, 12, "paid"), (3, 99, "paid")]
    return spark.createDataFrame(rows, "id bigint, user_id bigint, status string")


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(10,), (11,), (12,), (None,)], "id bigint")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_unique(orders):
    assert rows(unique(orders, "id")) == [(2, 2)]


def test_not_null(orders):
    assert not_null(orders, "id").count() == 2


def test_relationships(orders, users):
    assert rows(relationships(orders, "user_id", users, "id")) == [(99, 1)]


def test_accepted_values(orders):
    assert rows(accepted_values(orders, "status", ["paid"])) == [("lost", 2)]


def test_suite_counts_and_passes(orders, users):
    checks = [
        Check("orders", "id", "unique"),
        Check("orders", "id", "not_null"),
        Check("orders", "user_id", "relationships", parent="users", field="id"),
        Check("orders", "status", "accepted_values", values=("paid",)),
        Check("users", "id", "unique"),
    ]
    report = {r["check_name"]: (r["violations"], r["passed"]) for r in run_suite({"orders": orders, "users": users}, checks).collect()}
    assert report == {
        "unique_orders_id": (1, False),
        "not_null_orders_id": (2, False),
        "relationships_orders_user_id": (1, False),
        "accepted_values_orders_status": (2, False),
        "unique_users_id": (0, True),
    }


def test_row_checks_of_a_table_share_one_scan(orders):
    checks = [Check("orders", c, "not_null") for c in ("id", "user_id", "status")]
    checks.append(Check("orders", "status", "accepted_values", values=("paid",)))
    plan = run_suite({"orders": orders}, checks)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1


def test_declared_checks():
    assert len(CHECKS) == 38
    assert len({c.name for c in CHECKS}) == 38
    kinds = [c.kind for c in CHECKS]
    assert {k: kinds.count(k) for k in kinds} == {
        "unique": 11,
        "not_null": 18,
        "relationships": 7,
        "accepted_values": 2,
    }
    assert sum(c.table.startswith("stg_") for c in CHECKS) == 22


def test_suite_takes_few_exchanges(spark):
    from tests.conftest import SMALL
    from tidemark.operators.checks import CHECKS
    from tidemark.plans.marts import build_marts, build_staging
    from workloads import stores

    staging = build_staging(stores.all_silver(spark, SMALL))
    marts = build_marts(spark, staging)
    stored = {name: spark.read.schema(df.schema).parquet(stores.silver_path(spark, SMALL, "users")) for name, df in {**staging, **marts}.items()}
    plan = op_suite(stored, CHECKS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 7


def op_suite(tables, checks):
    from tidemark.operators import run_suite

    return run_suite(tables, checks)
