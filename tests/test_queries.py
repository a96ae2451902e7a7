"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from twinrow.plans.queries import QUERIES  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def by_name(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) & set(QUERIES)))
def test_query_equals_its_sql(spark, oracle, name):
    df = contract.queries()[name](spark, FOLDER)
    got = df.collect()
    cursor = oracle.execute(contract.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert by_name(df.columns, got) == by_name(names, cursor.fetchall())


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).columns == ["id", "left_rows", "right_rows"]
