"""Queries on tables that are larger than the driver's, in keys or in rows, against their SQL."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from strata.queries import records, writes
from strata.sources import pages, upserts
from tests.test_oracle import DATA, rows_of


def compare(spark, name, folder):
    got = __spark_entry__.queries()[name](spark, str(folder))
    db = duckdb.connect()
    for file in folder.glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}{'/*.parquet' if file.is_dir() else ''}'")
    want = db.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, got.collect()) == rows_of(columns, want.fetchall())


def test_sizes_of_large_keys(spark, tmp_path):
    keys = [0, 31, 32, 1023, 1024, 32767, 32768, 1048575, 1048576, 1558745, 8999999, 94906265]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    compare(spark, "function_readable_sizes", tmp_path)


def counting(spark, rows):
    """rows, and how many of them tasks have made so far."""
    made = spark.sparkContext.accumulator(0)

    def told(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(told, rows.schema), made


def test_an_upsert_makes_its_rows_once(spark, tmp_path):
    rows, made = counting(spark, spark.range(100).select("id", (F.col("id") % 7).alias("v")))
    upserts.create(rows, str(tmp_path / "t"), ["id"], 4)
    assert made.value == 100 and upserts.upsert(rows, str(tmp_path / "t")) == [] and made.value == 200
    assert upserts.read(spark, str(tmp_path / "t")).count() == 100


def test_a_graph_of_two_loads_parses_its_records_once(spark, monkeypatch):
    real, told = records.raw_movies, []

    def raw_movies(t):
        rows, made = counting(spark, real(t))
        told.append(made)
        return rows

    monkeypatch.setattr(records, "raw_movies", raw_movies)
    assert __spark_entry__.queries()["graph_saved"](spark, DATA).count() > 0
    assert [made.value for made in told] == [spark.read.parquet(f"{DATA}/part.parquet").count()]


def block(folder, first, rows):
    (folder / f"pages={first}").mkdir(parents=True)
    (folder / f"pages={first}" / "part-0.txt").write_text("\n".join(map(json.dumps, rows)) + "\n")


def test_pages_in_blocks(spark, tmp_path):
    said = lambda *ks: [{"page": k, "total_pages": 5, "results": [{"id": k, "title": "a\u2028b\r"}]} for k in ks]
    block(tmp_path / "poll=1" / "list=x", 1, said(1, 2, 3))
    block(tmp_path / "poll=1" / "list=x", 4, said(4, 5, 6))
    spark.dataSource.register(pages.ListPages)
    rows = spark.read.format("list_pages").options(path=str(tmp_path), pages_a_task=2).load()
    assert sorted(map(tuple, rows.collect())) == [(1, "x", r["page"], json.dumps(r["results"])) for r in said(1, 2, 3, 4, 5)]
    for poll, some in ((2, (1, 3, 4, 5)), (3, (1, 2, 3, 4))):
        block(tmp_path / f"poll={poll}" / "list=y", 1, said(*some))
        run = pages.planned(str(tmp_path), [poll], 9)
        with pytest.raises(OSError, match="page 2" if poll == 2 else "page 5"):
            list(pages._read(*run))


def test_long_lists_are_read_by_a_bounded_number_of_tasks(tmp_path):
    for name, total in (("long", 200_000), ("short", 3)):
        block(tmp_path / "poll=0" / f"list={name}", 1, [{"page": 1, "total_pages": total, "results": []}])
    runs = pages.planned(str(tmp_path), [0], 2)
    assert len(runs) <= pages.MANY_TASKS + 2
    for name, total in (("long", 200_000), ("short", 3)):
        assert [k for r in runs if r.name == name for k in range(r.first, r.last + 1)] == list(range(1, total + 1))


def long_lists(spark, folder):
    """Lists of 2,143 and 143 pages."""
    rows = spark.range(16_000).select(F.col("id").alias("p_partkey"), F.when(F.col("id") % 16 == 3, "Brand#1").otherwise("Brand#2").alias("p_brand"),
        F.concat(F.lit("name "), F.col("id") % 11).alias("p_name"))
    rows.write.parquet(str(folder / "part.parquet"))


def test_a_long_list_lies_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writes, "scratch", lambda spark, name: str(tmp_path / name))
    long_lists(spark, tmp_path / "data")
    compare(spark, "ingest_list_ranks", tmp_path / "data")
    assert len(list((tmp_path / "polls").rglob("*.txt"))) == 4


def test_a_stream_of_long_lists_lies_in_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writes, "scratch", lambda spark, name: str(tmp_path / name))
    long_lists(spark, tmp_path / "data")
    compare(spark, "stream_list_ranks", tmp_path / "data")
    assert len(list((tmp_path / "polls" / "pages").rglob("*.txt"))) == 6


def test_buckets_that_are_new_and_buckets_that_change(spark, tmp_path):
    path, want = str(tmp_path / "t"), {}
    upserts.create(spark.createDataFrame([], "id long, v long, n long"), path, ["id"], 8)
    for rows in ([(1, 1, 1)], [(1, 2, 2), (2, 1, 1), (2, 5, 3)], [(k, k, 2) for k in range(60)], [(k, 0, 1) for k in range(50, 70)], [(k, 9, 9) for k in range(3)]):
        for k, v, n in rows:
            want[k] = (n, v) if n >= want.get(k, (0, 0))[0] else want[k]
        df = spark.createDataFrame(rows, "id long, v long, n long")
        assert upserts.upsert(df, path, "n")
        assert {r["id"]: (r["n"], r["v"]) for r in upserts.read(spark, path).collect()} == want
