"""Every registered query against its DuckDB oracle on the small tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from workloads.oracles import ORACLES
from workloads.queries import REGISTRY

TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return con


def bag(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, df.collect()) == bag(names, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    assert REGISTRY.keys() == ORACLES.keys()
    assert REGISTRY.keys() <= entry.queries().keys()
