"""Declarative data tests.  Each operator returns what violates it; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once: ``value, rows``.  NULLs are left to ``not_null``."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows without a value."""
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Foreign-key values without a parent, and their rows: ``value, rows``.

    The child is reduced to its distinct keys before the join, so one key with very many rows costs nothing extra.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return keys.join(parent.select(F.col(field).alias("value")), "value", "left_anti")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list and their rows: ``value, rows``.  NULLs are left to ``not_null``."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@dataclass(frozen=True)
class Check:
    """One declared test of one column."""

    table: str
    column: str
    kind: str  # unique | not_null | relationships | accepted_values
    values: tuple[str, ...] = ()
    parent: str = ""
    field: str = ""

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


REPORT_COLUMNS = ("check_name", "kind", "table_name", "column_name", "violations", "passed")


def _lines(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with a count for each check, named by its number, as lines of the report."""
    lines = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.lit(c.kind).alias("kind"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.col(f"v{i}").alias("violations"),
            (F.col(f"v{i}") == 0).alias("passed"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*lines))).select(*REPORT_COLUMNS)


def _row_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All row-wise checks in one aggregate: every row gives the numbers of the checks it fails, most rows none."""
    by_table: dict[str, list[int]] = {}
    for i, check in enumerate(checks):
        by_table.setdefault(check.table, []).append(i)

    def fails(i: int) -> Column:
        column = F.col(checks[i].column)
        failing = column.isNull() if checks[i].kind == "not_null" else column.isNotNull() & ~column.isin(list(checks[i].values))
        return F.when(failing, F.lit(i))

    parts = [tables[t].select(F.explode(F.array_compact(F.array(*map(fails, own)))).alias("failed")) for t, own in by_table.items()]
    return _lines(_union(parts).agg(*[F.count_if(F.col("failed") == i).alias(f"v{i}") for i in range(len(checks))]), checks)


def _domains(checks: Sequence[Check]) -> list[list[tuple[str, str]]]:
    """Columns that checks compare with one another, by domain."""
    domains: list[list[tuple[str, str]]] = []
    for check in checks:
        own = {(check.table, check.column)} | ({(check.parent, check.field)} if check.parent else set())
        met = [d for d in domains if own & set(d)]
        domains = [d for d in domains if d not in met] + [sorted(own.union(*met))]
    return domains


def _key_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """All ``unique`` and ``relationships`` checks over keys of one type, by one grouping.

    A key is counted once for each column of its domain that holds it.  What repeats in one column and what is missing in another
    can both be read off these counts, so columns are neither grouped for themselves nor joined.  Counts are combined before the
    shuffle, so one key with very many rows costs nothing extra.
    """
    domains = _domains(checks)
    place = {column: (d, i) for d, columns in enumerate(domains) for i, column in enumerate(columns)}
    by_table: dict[str, list[str]] = {}
    for table, column in place:
        by_table.setdefault(table, []).append(column)

    def entries(table: str) -> DataFrame:
        held = [
            F.when(F.col(c).isNotNull(), F.struct(*[F.lit(x).alias(n) for n, x in zip(("domain", "slot"), place[table, c])], F.col(c).cast(
                _key_type(tables[table], c)).alias("value")))
            for c in by_table[table]
        ]
        return tables[table].select(F.inline(F.array_compact(F.array(*held))))

    slots = max(map(len, domains))
    held = _union([entries(t) for t in by_table])
    keys = held.groupBy("domain", "value").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(slots)])

    def violations(check: Check) -> Column:
        domain, own = place[check.table, check.column]
        here = F.col("domain") == domain
        if check.kind == "unique":
            return F.count_if(here & (F.col(f"n{own}") > 1))
        missing = here & (F.col(f"n{place[check.parent, check.field][1]}") == 0)
        return F.coalesce(F.sum(F.when(missing, F.col(f"n{own}"))), F.lit(0))

    return _lines(keys.agg(*[violations(c).alias(f"v{i}") for i, c in enumerate(checks)]), checks)


def _key_type(df: DataFrame, column: str) -> str:
    return "bigint" if isinstance(df.schema[column].dataType, T.IntegralType) else "string"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union by halves: Spark looks at every plan again that it is put into, so a long chain would take quadratic time."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _union(parts[:middle]).union(_union(parts[middle:]))


def run_suite(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Run all checks: one line each with its number of violations.

    ``not_null`` and ``accepted_values`` count rows, ``unique`` counts repeated values and ``relationships`` rows without a parent.
    Row checks share one aggregate, checks of keys one grouping for each type of key: five exchanges, however many checks there are.
    """
    groups: dict[str, list[Check]] = {}
    for check in checks:
        rowwise = check.kind not in ("unique", "relationships")
        groups.setdefault("rows" if rowwise else _key_type(tables[check.table], check.column), []).append(check)
    return _union([(_row_checks if kind == "rows" else _key_checks)(tables, own) for kind, own in groups.items()])


def _unique_keys(*pairs: tuple[str, str]) -> list[Check]:
    return [Check(table, column, kind) for table, column in pairs for kind in ("unique", "not_null")]


def _reference(table: str, column: str, parent: str, field: str) -> list[Check]:
    return [
        Check(table, column, "not_null"),
        Check(table, column, "relationships", parent=parent, field=field),
    ]


# The 38 declared tests and the accepted values.
ORDER_STATUSES = ("pending", "paid", "shipped", "delivered", "cancelled")
PAYMENT_STATUSES = ("success", "failed")
CHECKS: tuple[Check, ...] = (
    *_unique_keys(
        ("stg_users", "user_id"),
        ("stg_products", "product_id"),
        ("stg_orders", "order_id"),
        ("stg_order_items", "order_item_id"),
        ("stg_payments", "payment_id"),
        ("stg_clickstream", "event_id"),
        ("dim_users", "user_id"),
        ("dim_products", "product_id"),
        ("dim_date", "date_key"),
        ("fact_orders", "order_item_id"),
        ("fact_clickstream", "event_id"),
    ),
    *_reference("stg_orders", "user_id", "stg_users", "user_id"),
    *_reference("stg_order_items", "order_id", "stg_orders", "order_id"),
    *_reference("stg_order_items", "product_id", "stg_products", "product_id"),
    *_reference("stg_payments", "order_id", "stg_orders", "order_id"),
    *_reference("fact_orders", "user_id", "dim_users", "user_id"),
    *_reference("fact_orders", "product_id", "dim_products", "product_id"),
    *_reference("fact_orders", "date_key", "dim_date", "date_key"),
    Check("stg_orders", "status", "accepted_values", values=ORDER_STATUSES),
    Check("stg_payments", "status", "accepted_values", values=PAYMENT_STATUSES),
)
