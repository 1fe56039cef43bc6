"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from rankloom.plans.registered import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(cell(row[c]) for c in columns) for row in df.collect())
    if name not in ORACLE:
        assert got
        return
    relation = con.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    assert got == sorted(tuple(cell(row[i]) for i in at) for row in relation.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
