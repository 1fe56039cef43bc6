"""The subpackage's queries on the smallest tables: those with SQL against it, the others for their columns."""

import os

import duckdb
import pytest

from rankloom.llm.queries import ORACLE, QUERIES
from test_oracle import SF, TABLES, cell

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
ROWS = {"op1": "documents", "op3": "documents", "op4": "documents", "op5": "pages", "op6": "documents", "op9": "documents", "op10": "documents"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_like_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    relation = con.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    at = [relation.columns.index(c) for c in columns]
    want = sorted(tuple(cell(row[i]) for i in at) for row in relation.fetchall())
    assert sorted(tuple(cell(row[c]) for c in columns) for row in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(spark, name):
    done = QUERIES[name](spark, SF).collect()
    if table := ROWS.get(name.split("_")[0]):
        key = "page_id" if table == "pages" else "doc_id"
        assert sorted(r[key] for r in done) == sorted(r[key] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(key).collect())
    assert done
