"""Registered queries against SQL, and the tables' invariants where SQL has none."""

import duckdb
import pytest

import __spark_entry__ as contract
from cohortry.llm import oracle, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "labels", "benchmark"]


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def test_all_are_registered():
    names = [n.split("_")[0] for n in contract.queries() if n.startswith("op")]
    assert [f"op{n}" for n in range(1, 14)] == sorted(names, key=lambda n: int(n[2:]))
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", oracle.queries())
def test_query_equals_sql(spark, db, name):
    df = queries.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    found = sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    relation = db.sql(oracle.queries()[name])
    assert sorted(relation.columns) == columns
    expected = sorted(map(repr, relation.project(", ".join(columns)).fetchall()))
    assert found == expected and found

