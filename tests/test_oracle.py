"""Every query against its SQL in DuckDB."""

import decimal

import duckdb
import pytest

from strata.queries import acts, batch, governed, graphs, lakes, records, streams, writes  # noqa: F401
from strata.queries.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    text = lambda v: f"{float(v):.6f}" if isinstance(v, float | decimal.Decimal) else str(v)
    return sorted(tuple(text(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_query(spark, db, name):
    got = QUERIES[name](spark, DATA)
    want = db.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_plans_push_down_and_prune(spark):
    plan = QUERIES["partition_scan"](spark, DATA)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate" in plan
    assert "WindowGroupLimit" in QUERIES["top_movie"](spark, DATA)._jdf.queryExecution().toString()
