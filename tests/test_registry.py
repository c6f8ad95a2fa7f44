"""Every registered query against its SQL, on the smallest data set."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return con


def _plain(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [
        tuple(None if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in data
    ]
    return sorted(columns), sorted(cells, key=lambda r: tuple((v is None, 0 if v is None else v) for v in r))


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    result = duck.execute(entry_module.oracle_sql()[name])
    want = _plain([d[0] for d in result.description], result.fetchall())
    assert _plain(df.columns, df.collect()) == want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_sql_only_for_registered_queries():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
