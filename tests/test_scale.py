"""Operators where one key, film or chain is large; streams that are killed, come late, or run long."""

import collections
import random

import pytest
from pyspark.sql import functions as F

from strata.governance import lineage
from strata.operators import graph, rollups, scd2
from strata.queries import streams
from strata.sources import lake
from strata.streaming import metrics, sinks, tiers


def acting(spark, rows):
    return spark.createDataFrame([(p, m, "ACTED_IN") for p, m in rows], "from_id long, to_id long, type string")


def plain_pairs(rows):
    films, pairs = collections.defaultdict(set), collections.Counter()
    for p, m in rows:
        films[m].add(p)
    for persons in films.values():
        pairs.update((a, b) for a in persons for b in persons if a < b)
    return pairs


@pytest.mark.parametrize("limit", [None, 1, 10, 500])
def test_pairs_of_heavy_and_light_films(spark, limit):
    r = random.Random(1)
    rows = [(p, 0) for p in range(60)] + [(r.randrange(80), m) for m in range(1, 40) for _ in range(6)]
    want = sorted(((a, b, n) for (a, b), n in plain_pairs(rows).items()), key=lambda x: (-x[2], x[0], x[1]))[:limit]
    got = [tuple(x) for x in graph.coactors(acting(spark, rows), limit, heavy=20, block=7).collect()]
    assert (got if limit else sorted(got)) == (want if limit else sorted(want))


def test_no_task_has_a_film_of_ten_thousand_actors(spark):
    rows = spark.range(10_000).select(F.col("id").alias("from_id"), F.lit(1).cast("long").alias("to_id"))
    sizes = rows.withColumn("own", F.pmod(F.xxhash64("from_id"), F.lit(20))).groupBy("own").count()
    assert sizes.agg(F.max("count")).first()[0] < 700  # what a key of the heavy join has on either side
    assert graph._pairs_within(rows, 1024, 512).count() == 10_000 * 9_999 // 2


def test_reachable_over_long_ways_and_cycles(spark):
    ring = [(f"t{i}", f"t{(i + 1) % 40}") for i in range(40)]
    edges = spark.createDataFrame([*ring, ("a", "t0"), ("t5", None), (None, "t6"), ("x", "y")], "source string, target string")
    down = {r["table"]: r["steps"] for r in lineage.reachable(edges, "a").collect()}
    assert down == {f"t{i}": i + 1 for i in range(40)}  # beyond 32 steps, too
    assert {r["table"] for r in lineage.reachable(edges, "t0", down=False).collect()} == {f"t{i}" for i in range(40)} | {"a"}
    assert lineage.reachable(edges, "nowhere").count() == 0


@pytest.mark.parametrize("closed", [False, True])
def test_point_in_time_with_a_hot_key(spark, closed):
    r = random.Random(2)
    versions = [(1, t, t + 10, f"v{t}") for t in range(0, 3000, 10)] + [(1, 2990, 10**9, "last"), (1, 50, 900, "long"), (2, 5, 10**9, "x"), (2, None, 10, "n"), (None, 1, 9, "k")]
    facts = [(r.choice([1, 1, 1, 2, 3, None]), r.randrange(-50, 4000)) for _ in range(400)] + [(1, None), (1, 0), (1, 10), (1, 2990), (1, 10**9)]
    stamp = lambda c: F.timestamp_seconds(c).alias(c)
    v = spark.createDataFrame(versions, "k long, valid_from long, valid_to long, v string").select("k", stamp("valid_from"), stamp("valid_to"), "v")
    f = spark.createDataFrame(facts, "k long, at long").select("k", stamp("at"))
    got = scd2.as_of(f, v, "k", "at", closed, hot=20, per_bucket=8)
    want = sorted((k, at, w) for k, at in facts for j, a, b, w in versions
        if k is not None and k == j and at is not None and a is not None and a <= at and (at <= b if closed else at < b))
    assert sorted((x["k"], int(x["at"].timestamp()), x["v"]) for x in got.collect()) == want
    assert got.columns == ["k", "at", "valid_from", "valid_to", "v"]


def test_a_hot_key_meets_few_versions(spark):
    """Facts times versions of a bucket, not of the key."""
    v = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 10).alias("valid_from"), F.timestamp_seconds(F.col("id") * 10 + 10).alias("valid_to"), "id")
    f = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_seconds(F.col("id") * 10 + 3).alias("at"))
    sizes = v.agg(F.min(F.unix_micros("valid_from")).alias("__low"), ((F.max(F.unix_micros("valid_from")) - F.min(F.unix_micros("valid_from"))) / 79).alias("__width"), F.lit(79).alias("__buckets"))
    held = v.crossJoin(sizes).groupBy(scd2._time_bucket(F.col("valid_from")).alias("b")).count().agg(F.max("count"), F.count("*")).first()
    assert held[0] <= 2 * scd2.BUCKET_VERSIONS and held[1] >= 79
    assert scd2.as_of(f, v, "k", "at").count() == 20_000


ROWS = "id long, at timestamp, key string, value long"


def test_tiers_cover_each_batch_once(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.range(90).select("id", F.timestamp_seconds(F.col("id") * 600).alias("at"), F.lit("k").alias("key"), F.col("id").alias("value"))
    add = tiers.rolling_up(path, lambda b: rollups.hourly(b, "at", ["key"], "value"), ["key"], fan=3)
    for n in range(30):
        for _ in range(1 + n % 2):  # every other batch comes twice
            add(rows.where(F.col("id") % 30 == n), n)
    found = tiers.folders(spark, path)
    assert len(found) <= 6 and sorted((f["first"], f["last"]) for f in found)[0][0] == 0 and sum(f["last"] - f["first"] + 1 for f in found) == 30
    got = sorted(map(tuple, tiers.read(spark, path, "bucket", ["key"]).collect()))
    assert got == sorted(map(tuple, rollups.hourly(rows, "at", ["key"], "value").collect()))
    assert {p.name for p in (tmp_path / "r").iterdir() if p.is_dir()} == {f["folder"] for f in found}


def test_a_crash_between_states_and_manifest(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "r")
    rows = spark.range(10).select(F.timestamp_seconds("id").alias("at"), F.lit("k").alias("key"), F.col("id").alias("value"))
    add = tiers.rolling_up(path, lambda b: rollups.hourly(b, "at", ["key"], "value"), ["key"])
    real = lake.save_state
    monkeypatch.setattr(lake, "save_state", lambda *a: (_ for _ in ()).throw(SystemExit()))
    with pytest.raises(SystemExit):
        add(rows, 0)
    monkeypatch.setattr(lake, "save_state", real)
    with pytest.raises(ValueError):
        tiers.read(spark, path, "bucket", ["key"])
    add(rows, 0)
    assert tiers.read(spark, path, "bucket", ["key"]).first()["n"] == 10 and tiers.sweep(spark, path) == 1


def test_supervised_gives_up(spark):
    starts = []

    class Dies:
        def awaitTermination(self):
            raise OSError("no")

    with pytest.raises(OSError):
        metrics.supervised(lambda: starts.append(1) or Dies(), attempts=3, sleep=lambda s: None)
    assert len(starts) == 3


def test_alerts_of_metrics(spark):
    rows = [("q", "r", 1, None, 5, 10, None, None, 300_001, 0, 0, 1, None), ("q", "r", 2, None, 5, 10, None, None, 300_000, 10_001, 2, 1, None), ("q", "r", None, *[None] * 9, "x")]
    found = metrics.alerts(spark.createDataFrame(rows, metrics.SCHEMA))
    assert sorted((r["batch"] or 0, r["kind"], r["value"]) for r in found.collect()) == [(0, "FAILED", 1), (1, "LATENCY", 300_001), (2, "LAG", 10_001), (2, "LATE_ROWS", 2)]


def test_settings_of_streams_are_their_own(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    own = streams.own_session(spark)
    own.conf.set("spark.sql.shuffle.partitions", "3")
    assert spark.conf.get("spark.sql.shuffle.partitions") == before and own.conf.get("spark.sql.session.timeZone") == "UTC"


def test_dead_letters_and_good_rows_from_one_pass(spark, tmp_path):
    from strata.streaming import codec

    good = '{"eventType": "entity_changed", "entityType": "MOVIE", "entityId": 5, "event_time": 1714521600000, "payload": {"b": 1, "a": "x"}, "source": 7}'
    lines = [good, "broken", "[]", '{"event_type": "ENTITY_CHANGED", "entity_type": "movie", "entity_id": "5", "event_time": 1}', good.replace("MOVIE", "person")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines))
    stream = streams.own_session(spark).readStream.text(str(tmp_path / "in"))
    write = sinks.split(str(tmp_path / "good"), str(tmp_path / "bad"), codec.decode, codec.good, codec.dead_letters)
    sinks.run_available(stream, str(tmp_path / "c"), "", write).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "good"))
    assert sorted((r["entity_type"], r["entity_id"], r["payload"], r["source"]) for r in got.collect()) == [("movie", 5, '{"b":1,"a":"x"}', "7"), ("person", 5, '{"b":1,"a":"x"}', "7")]
    assert codec.of_types(got, "Movie").count() == 1 and spark.read.parquet(str(tmp_path / "bad")).count() == 3
