"""Queries over the whole graph do no less than those that they stand beside."""

import duckdb

from strata.queries import graphs  # noqa: F401
from strata.queries.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


def test_all_edges_and_vertices_are_counted(spark):
    got = {(r["what"], r["kind"]): r["count"] for r in QUERIES["graph_counts_whole"](spark, DATA).collect()}
    types = {"ACTED_IN", "DIRECTED", "HAS_GENRE", "HAS_KEYWORD", "PRODUCED_BY"}
    assert set(got) == {("edge", k) for k in types} | {("vertex", "movie"), ("vertex", "person")}
    db = duckdb.connect()
    for t in ("part", "supplier", "orders", "lineitem"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    assert sorted(db.execute(SQL["graph_counts_whole"]).fetchall()) == sorted((*k, n) for k, n in got.items())


def test_a_circle_goes_on_to_the_movies_of_co_actors(spark):
    db = duckdb.connect()
    for t in ("part", "supplier", "orders", "lineitem"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    own = db.execute(SQL["graph_circle"].split(", m1 AS")[0] + " SELECT count(DISTINCT to_id) FROM a WHERE from_id = 1").fetchone()[0]
    got = QUERIES["graph_circle_whole"](spark, DATA).first()["movies"]
    assert got == db.execute(SQL["graph_circle_whole"]).fetchone()[0] == db.execute(SQL["graph_circle"]).fetchone()[0] > own
    print(own, got)
