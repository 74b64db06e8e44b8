"""Every registered query against its DuckDB form, on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from cdclake_workload import queries as operator_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()

NAMES = {q.__name__ for q in operator_queries.ALL}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def canonical(values):
    return tuple(None if v is None or (isinstance(v, float) and math.isnan(v)) else str(v) for v in values)


def in_order(found):
    return sorted(found, key=lambda r: [v or "" for v in r])


def test_every_query_has_an_oracle():
    assert NAMES <= set(contract.queries()) and NAMES <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(NAMES))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    found = in_order(canonical(r[c] for c in columns) for r in df.collect())
    cursor = oracle.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    expected = in_order(canonical(r[names.index(c)] for c in columns) for r in cursor.fetchall())
    assert found == expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "k"]
    assert df.count() > 0
