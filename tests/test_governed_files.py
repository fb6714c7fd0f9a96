"""Pages as a source, the catalogue, lifecycle acts on folders, column references, masked texts."""

import datetime
import json

import pytest
from pyspark.errors import ParseException
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.governance import catalogue, metrics
from strata.sources import lake, pages, rolling


def page(tmp_path, poll, name, k, total, results):
    folder = tmp_path / f"poll={poll}" / f"list={name}" / f"page={k}"
    folder.mkdir(parents=True)
    (folder / "part-0.txt").write_text(json.dumps({"page": k, "total_pages": total, "results": results}))


def test_pages_end_where_the_first_one_says(spark, tmp_path):
    for k in range(1, 6):
        page(tmp_path, 1, "a%23b", k, 4, [{"id": k}])
    page(tmp_path, 1, "empty", 1, 1, None)
    page(tmp_path, 2, "x", 1, 1, [{"id": 9}, {"id": 8}])
    spark.dataSource.register(pages.ListPages)
    rows = spark.read.format("list_pages").options(path=str(tmp_path), pages_a_task=3).load()
    assert sorted(map(tuple, rows.collect())) == [(1, "a#b", k, json.dumps([{"id": k}])) for k in range(1, 5)] + [(1, "empty", 1, "[]"), (2, "x", 1, '[{"id": 9}, {"id": 8}]')]
    assert rows.rdd.getNumPartitions() == 4
    page(tmp_path, 3, "gap", 1, 2, [])
    with pytest.raises(Exception, match="page 2"):
        spark.read.format("list_pages").options(path=str(tmp_path)).load().collect()


def test_a_stream_of_polls(spark, tmp_path):
    own = tmp_path / "p"
    own.mkdir()
    reader = pages.StreamReader(str(own), 50)
    assert reader.initialOffset() == reader.latestOffset() == {"poll": -1}
    page(own, 0, "a", 1, 1, [1])
    page(own, 7, "a", 1, 1, [2])
    assert reader.latestOffset() == {"poll": 7} and [r.poll for r in reader.partitions({"poll": 0}, {"poll": 7})] == [7]


def test_paths_stand_for_themselves():
    for path in ("/a/b%23 c", "file:/a/b%23 c", "file:///a/b%23 c"):
        assert rolling.file_system(path)[1] == "/a/b%23 c"


def plan_of(spark, base):
    rows = [("t", datetime.date(2024, 1, d), "DROP" if d < 3 else "COLD") for d in range(1, 5)]
    return catalogue.with_folders(spark, spark.createDataFrame(rows, "table string, dt date, action string"), {"t": f"{base}/t"}, f"{base}/cold")


def test_lifecycle_acts_and_is_taken_up(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    rows = spark.range(50).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int")).alias("dt"))
    lake.overwrite_partitions(rows, f"{base}/t")
    days = lambda place: sorted(p.name for p in (tmp_path / place).rglob("dt=*"))
    assert {r["status"] for r in catalogue.act(plan_of(spark, base), f"{base}/journal").collect()} == {"SKIPPED"} and len(days("t")) == 5
    real = catalogue._act
    monkeypatch.setattr(catalogue, "_act", lambda *a: (_ for _ in ()).throw(SystemExit()))
    with pytest.raises(SystemExit):
        catalogue.act(plan_of(spark, base), f"{base}/journal", dry_run=False)
    monkeypatch.setattr(catalogue, "_act", real)
    assert len(days("t")) == 5 and len(catalogue.resume(spark, f"{base}/journal")) == 1
    assert days("t") == ["dt=2024-01-05"] and days("cold") == ["dt=2024-01-03", "dt=2024-01-04"] and catalogue.resume(spark, f"{base}/journal") == []
    assert spark.read.parquet(f"{base}/cold/t").count() == 20
    again = catalogue.act(plan_of(spark, base), f"{base}/journal", dry_run=False)  # dropped and moved already
    assert {r["status"] for r in again.collect()} == {"APPLIED"}
    lost = plan_of(spark, base).withColumn("folder", F.lit(f"{base}/none")).withColumn("target", F.lit(f"{base}/nowhere")).where("action = 'COLD'")
    assert {r["status"] for r in catalogue.act(lost, f"{base}/journal", dry_run=False).collect()} == {"FAILED"}


def test_footers_count_rows(spark, tmp_path):
    rows = spark.range(30).select("id", F.when(F.col("id") < 20, F.lit("2024-01-01").cast("date")).alias("dt"))
    lake.overwrite_partitions(rows.coalesce(1), str(tmp_path / "t"))
    found = {r["dt"]: r["rows"] for r in catalogue.files(spark, str(tmp_path / "t"), "t").collect()}
    assert found == {datetime.date(2024, 1, 1): 20, None: 10}


def test_references(spark):
    names = lambda text: C.references(spark, text)
    assert names("sum(count) + max(end)") == ["count", "end"] and names("count(*)") == []
    assert names("case when `odd name` > 0 then t.x.y else 'text' end") == ["odd name", "t.x.y"]
    assert names("transform(xs, x -> x + y) ") == ["xs", "y"] and names("avg(a) over (partition by k order by t desc)") == ["a", "k", "t"]
    with pytest.raises(ParseException):
        names("sum(")
    table = spark.createDataFrame([(1, 2)], "count int, end int")
    M = metrics.Metric
    found = metrics.problems([M("a", "t", "sum(count) + max(end)"), M("b", "t", "sum(t.count)"), M("c", "t", "sum(x)"), M("d", "t", "sum(count) +"), M("e", "t", "no_such(count)")], {"t": table})
    assert [(n, p) for n, p, _ in found] == [("b", "MISSING_COLUMN"), ("c", "MISSING_COLUMN"), ("d", "INVALID"), ("e", "INVALID")]


@pytest.mark.parametrize(("text", "masked"), [
    ('{"password": "x y", "n": 1}', '{"password": "****", "n": 1}'), ("access_token=abc&x=1", "access_token=****&x=1"), ("pwd: hunter2; next", "pwd: ****; next"),
    ("Cookie: a=b; c=d\nHost: x", "Cookie: ****\nHost: x"), ("Authorization: Bearer abc.def", "Authorization: Bearer ****"), ("tokens=5 mytoken=7", "tokens=5 mytoken=7"),
    ('"X-Api-Key": "abc", "o": "k"', '"X-Api-Key": "****", "o": "k"'), ('password="a\\"b" z', 'password="****" z'), ('{"secret":12,"b":2}', '{"secret":****,"b":2}')])
def test_masked(spark, text, masked):
    assert spark.range(1).select(C.mask_text(F.lit(text))).first()[0] == masked


def test_headers(spark):
    rows = spark.createDataFrame([("Authorization", "x"), ("Host", "x"), ("cookie", None), (None, "x")], "n string, v string")
    assert [r[0] for r in rows.select(C.mask_header(F.col("n"), F.col("v"))).collect()] == ["****", "x", None, "x"]


def test_canonical_json(spark):
    one = lambda text: spark.createDataFrame([(text,)], "t string").select(C.canonical_json(F.col("t"))).first()[0]
    assert one('{"b": 1, "a": {"d": [2, {"z": 1, "y": null}], "c": "é\\n"}}') == '{"a":{"c":"é\\n","d":[2,{"y":null,"z":1}]},"b":1}'
    assert one("[1, 2.50]") == "[1,2.5]" and one("{") is None and one(None) is None and one('{"a":1,"a":2}') is None
