"""Rolled files, loads that fail, swaps that crash, upserts on disk."""

import gzip
import itertools

import pytest
from pyspark.sql import functions as F

from strata.operators import graph
from strata.plans import batch, ingest
from strata.sources import lake, raw, rolling, swap, upserts
from tests.test_warehouse import DT, frame, movie, person, tv


def records(spark, n, first=1):
    return frame(spark, "movie", [movie(i) for i in range(first, first + n)])


def lines_of(folder):
    return [gzip.decompress(f.read_bytes()).splitlines() for f in sorted(folder.glob("*.ndjson.gz"))]


def test_files_roll_by_lines_and_by_real_bytes(spark, tmp_path):
    rows = spark.range(25).select("id", F.repeat(F.lit("é"), 50).alias("text")).coalesce(1)
    lake.write_ndjson(rows, str(tmp_path / "a"), records_per_file=10)
    assert [len(x) for x in lines_of(tmp_path / "a")] == [10, 10, 5]
    lake.write_ndjson(rows, str(tmp_path / "b"), bytes_per_file=400)
    found = lines_of(tmp_path / "b")
    assert all(sum(len(x) + 1 for x in file) <= 400 for file in found) and len(found) > 5 and sum(map(len, found)) == 25
    lake.write_ndjson(rows, str(tmp_path / "b"), bytes_per_file=1)  # a longer line has a file of its own
    assert len(lines_of(tmp_path / "b")) == len(found) + 25 and {p.name for p in tmp_path.iterdir()} == {"a", "b"}
    assert not [p for p in (tmp_path / "b").iterdir() if p.is_dir()]


def test_a_failed_task_leaves_no_file(spark, tmp_path):
    path = tmp_path / "x"
    lake.write_ndjson(spark.range(5), str(path))
    broken = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("no"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception):
        lake.write_ndjson(broken, str(path), records_per_file=3)
    assert sum(map(len, lines_of(path))) == 5 and len(list(path.iterdir())) == len(list(path.glob("*.ndjson.gz")))


def test_a_bad_load_leaves_the_good_one(spark, tmp_path):
    path = tmp_path / "raw" / "movie" / f"dt={DT}"
    ids = spark.range(1, 21)
    ingest.full_load(ids, records(spark, 20), str(path))
    with pytest.raises(RuntimeError):
        ingest.full_load(ids, records(spark, 20).withColumn("payload", F.lit("broken")), str(path))
    ingest.full_load(spark.range(21, 24), records(spark, 3, 21), str(path))
    assert raw.read_partition(spark, str(tmp_path), "movie", DT).count() == 23
    assert {p.name for p in path.parent.iterdir()} == {f"dt={DT}"}


def test_loaded_records_come_through_the_batch(spark, tmp_path):
    for kind, rows in (("movie", [movie(i) for i in range(1, 8)]), ("tv", [tv(1)]), ("person", [person(1), person(3)])):
        details = frame(spark, kind, rows)
        ingest.full_load(details.select(F.col("entity_id").alias("id")), details, f"{tmp_path}/raw/{kind}/dt={DT}")
    assert batch.run(spark, str(tmp_path), DT)["dim_movie"].count() == 7


def state(spark, path):
    return sorted((r["p"], r["v"]) for r in spark.read.parquet(path).collect())


OLD, NEW = [(p, "old") for p in "abc"], [(p, "new") for p in "bcd"]


@pytest.mark.parametrize(("failing", "error"), list(itertools.product(range(1, 6), [OSError, SystemExit])))
def test_a_swap_that_fails_at_any_rename(spark, tmp_path, monkeypatch, failing, error):
    """Three partitions, two of which are there: five renames. An error undoes the swap at once, a crash leaves it to the next one."""
    path = str(tmp_path / "t")
    lake.overwrite_partitions(spark.createDataFrame(OLD, "p string, v string"), path, "p")
    real, calls = lake._move, []

    def move(fs, source, target):
        calls.append(1)
        if len(calls) == failing:
            raise error("no")
        real(fs, source, target)

    monkeypatch.setattr(lake, "_move", move)
    with pytest.raises(error):
        swap.replace_partitions(spark.createDataFrame(NEW, "p string, v string"), path, "p")
    monkeypatch.setattr(lake, "_move", real)
    if error is OSError:
        assert not list((tmp_path / "t").glob("_swap*"))
    else:
        assert swap.recover(spark, path) == 1
    assert state(spark, path) == OLD
    swap.replace_partitions(spark.createDataFrame(NEW, "p string, v string"), path, "p")
    assert state(spark, path) == [("a", "old"), *NEW] and swap.recover(spark, path) == 0


def test_a_swap_that_was_through_stays(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    lake.overwrite_partitions(spark.createDataFrame(OLD, "p string, v string"), path, "p")
    real = lake.delete
    monkeypatch.setattr(lake, "delete", lambda s, p: (_ for _ in ()).throw(SystemExit()) if "_swap-" in p else real(s, p))
    with pytest.raises(SystemExit):
        swap.replace_partitions(spark.createDataFrame(NEW, "p string, v string"), path, "p")
    monkeypatch.setattr(lake, "delete", real)
    assert swap.recover(spark, path) == 1 and state(spark, path) == [("a", "old"), *NEW]


def test_partitions_taken_from_a_staging_table(spark, tmp_path):
    path, staging = str(tmp_path / "t"), str(tmp_path / "s")
    lake.overwrite_partitions(spark.createDataFrame(OLD, "p string, v string"), path, "p")
    lake.overwrite_partitions(spark.createDataFrame([*NEW, (None, "new"), ("x=/y", "new")], "p string, v string"), staging, "p")
    assert len(swap.take_partitions(spark, staging, path, "p", ["b", None, "x=/y", "gone"])) == 3
    assert sorted(map(str, state_with_nulls(spark, path))) == sorted(map(str, [("a", "old"), ("b", "new"), ("c", "old"), (None, "new"), ("x=/y", "new")]))


def state_with_nulls(spark, path):
    return [(r["p"], r["v"]) for r in spark.read.parquet(path).collect()]


def test_a_window_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.sql("select id as k, timestamp'2024-05-01' + make_interval(0,0,0,0,id) as at, cast(null as string) as v, to_date(timestamp'2024-05-01' + make_interval(0,0,0,0,id)) as dt from range(96)")
    swap.replace_window(spark, path, rows, "at", "2024-05-01 00:00:00", "2024-05-01 00:00:00")
    assert spark.read.parquet(path).count() == 96
    before = {f.name for f in (tmp_path / "t").rglob("*.parquet")}
    wrote = swap.replace_window(spark, path, rows.where("k = 30").withColumn("v", F.lit("x")), "at", "2024-05-02 00:00:00", "2024-05-02 23:00:00")
    assert wrote == ["dt=2024-05-02"]
    assert spark.read.parquet(path).count() == 96 - 23 and len(before & {f.name for f in (tmp_path / "t").rglob("*.parquet")}) >= 3
    assert swap.replace_window(spark, path, rows.limit(0), "at", "2024-05-02 00:00:00", "2024-05-02 23:00:00") == ["dt=2024-05-02"]
    assert spark.read.parquet(path).count() == 72


def test_upserts(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "a long, b string, v string, n long"
    rows = [(1, "x", "old", 1), (1, None, "old", 1), (None, None, "old", 1), (2, "y", "old", 5)]
    upserts.create(spark.createDataFrame(rows, schema), path, ["a", "b"], buckets=8, version="n")
    with pytest.raises(ValueError):
        upserts.create(spark.createDataFrame(rows, schema), path, ["a", "b"])
    got = lambda: sorted(((r["a"], r["b"], r["v"], r["n"]) for r in upserts.read(spark, path).collect()), key=str)
    assert got() == sorted(rows, key=str)
    new = spark.createDataFrame([(1, None, "later", 3), (1, None, "new", 2), (None, None, "new", 1), (2, "y", "late", 4), (3, "z", "new", 1)], schema)
    assert upserts.upsert(new, path, "n")
    want = [(1, "x", "old", 1), (1, None, "later", 3), (None, None, "new", 1), (2, "y", "old", 5), (3, "z", "new", 1)]
    assert got() == sorted(want, key=str)
    upserts.upsert(new, path, "n")
    assert got() == sorted(want, key=str)
    assert upserts.upsert(new.where("a = 3"), path) == [] and upserts.upsert(new.limit(0), path) == []


def test_merging_null_keys_again_changes_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b")], "id long, name string")
    once = graph.merge(rows, rows, ["id"])
    assert once.count() == 2 and graph.merge(once, rows, ["id"]).count() == 2


def test_a_saved_graph_has_both_ends_and_refuses_nameless_vertices(spark, tmp_path):
    vertices = spark.createDataFrame([("movie", 1, "m"), ("person", 2, "p")], "label string, id long, name string")
    edges = spark.createDataFrame([(2, 1, "ACTED_IN"), (2, 1, "ACTED_IN"), (3, 1, "ACTED_IN")], "from_id long, to_id long, type string")
    graph.save(vertices, edges, str(tmp_path / "g"), 2)
    assert graph.save(vertices, edges, str(tmp_path / "g"), 2) == {"vertices": 0, "edges": 0}
    assert [tuple(r) for r in graph.load(spark, str(tmp_path / "g"))[1].collect()] == [(2, 1, "ACTED_IN")]
    with pytest.raises(ValueError):
        graph.save(vertices.withColumn("id", F.lit(None).cast("long")), edges, str(tmp_path / "g"))
    assert graph.violations(vertices.unionByName(vertices.where("id = 1"))).first()["n"] == 2
    assert rolling.LINES == 200_000 and rolling.BYTES == 64 << 20


def test_compaction_rewrites_small_files_alone(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"), F.when(F.col("id") < 3000, F.lit("a b")).otherwise("c").alias("p"))
    rows.where("p = 'a b'").repartition(5).write.partitionBy("p").parquet(path)
    rows.where("p = 'c'").coalesce(1).write.mode("append").partitionBy("p").parquet(path)
    large = {f.name for f in (tmp_path / "t" / "p=c").glob("*.parquet")}
    want = sorted(map(tuple, rows.collect()))
    got = lambda: sorted(map(tuple, spark.read.parquet(path).select("id", "v", "p").collect()))
    real, calls = lake._move, []

    def move(fs, source, target):
        calls.append(1)
        if len(calls) == 4:
            raise SystemExit
        real(fs, source, target)

    monkeypatch.setattr(lake, "_move", move)
    with pytest.raises(SystemExit):
        swap.compact(spark, path, 1 << 20, "p")
    monkeypatch.setattr(lake, "_move", real)
    assert swap.recover(spark, path) == 1 and got() == want
    assert swap.compact(spark, path, 1 << 20, "p") == 5 and got() == want
    assert {f.name for f in (tmp_path / "t" / "p=c").glob("*.parquet")} == large and swap.compact(spark, path, 1 << 20, "p") == 0
    plain = str(tmp_path / "u")
    spark.range(100).repartition(4).write.parquet(plain)
    assert swap.compact(spark, plain) == 4 and spark.read.parquet(plain).count() == 100 and len(list((tmp_path / "u").glob("*.parquet"))) == 1


def test_what_crashed_publishes_leave_goes_or_comes_back(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.publish(spark.range(5), path)
    spark.range(3).write.parquet(f"{path}__{'0' * 32}")
    assert lake.expire(spark, path, 0) == [] and lake.expire(spark, path, 1 << 60) == [f"t__{'0' * 32}"]
    (tmp_path / "t").rename(tmp_path / f"t__{'1' * 32}")  # a crash between the renames
    spark.range(9).write.parquet(f"{path}__{'2' * 32}")
    lake.expire(spark, path, 1 << 60)
    assert spark.read.parquet(path).count() == 5 and {p.name for p in tmp_path.iterdir()} == {"t"}
