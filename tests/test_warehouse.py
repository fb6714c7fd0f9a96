"""Modelled tables, histories and the daily batch, from small payloads."""

import datetime
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators import ads, dedup, dwd, dws, graph, rollups, scd2
from strata.plans import batch, ingest
from strata.sources import lake, raw, schemas

DT = "2024-05-01"


def movie(n, **more):
    """Record n: three genres, a company with a bracketed suffix, two actors, a director who also edits, one dated release."""
    actor = lambda i: {"id": i, "credit_id": f"act-{n}-{i}", "name": f"actor {i}", "character": f"part {i}", "order": i - 1}
    worker = lambda dep, job: {"id": 3, "credit_id": f"{job.lower()}-{n}", "name": "worker 3", "department": dep, "job": job}
    return {
        "id": n, "title": f"Film {n}", "release_date": "1998-03-05", "budget": 250, "revenue": 1000, "popularity": 4.0 + n, "vote_average": 6.5,
        "vote_count": 12, "adult": False,
        "belongs_to_collection": {"id": 40, "name": "Harbour tales"}, "genres": [{"id": g, "name": f"kind {g}"} for g in (3, 4, 5)],
        "production_companies": [{"id": 70, "name": "Blue Lantern (NZ)"}], "production_countries": [{"iso_3166_1": "NZ", "name": "New Zealand"}],
        "spoken_languages": [{"iso_639_1": "mi", "name": "Maori"}],
        "keywords": {"keywords": [{"id": 8, "name": "tide"}]},
        "credits": {"cast": [actor(1), actor(2)], "crew": [worker("Directing", "Director"), worker("Editing", "Editor")]},
        "release_dates": {"results": [{"iso_3166_1": "NZ", "release_dates": [{"certification": "M", "release_date": "1998-03-05T00:00:00.000Z", "type": 3}]},
        {"iso_3166_1": "CH", "release_dates": []}]},
    } | more


def tv(n):
    return {"id": n, "name": f"Series {n}", "genres": [{"id": 3, "name": "kind 3 on tv"}], "networks": [{"id": 61, "name": "Channel"}],
        "keywords": {"results": [{"id": 9, "name": "ferry"}]}}


def person(n):
    return {"id": n, "name": f"Person {n}", "gender": n, "birthday": "1961-11-30", "popularity": 2.5, "known_for_department": "Sound"}


def frame(spark, kind, payloads, dt=DT):
    rows = [(1, kind, p["id"] if isinstance(p, dict) else 0, dt, 1000 + i, "t", json.dumps(p) if isinstance(p, dict) else p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, schemas.RAW)


def frames(spark, **more):
    return {"movie": frame(spark, "movie", more.get("movies", [movie(1), movie(2, budget=0)])), "tv": frame(spark, "tv", [tv(1)]),
        "person": frame(spark, "person", [person(1), person(2), person(3)])}


def test_modelled_layer(spark):
    f = frames(spark, movies=[movie(1), movie(2, budget=0), movie(1, title="newer"), "not json", {"id": None}])
    m, t = dwd.parsed(f["movie"], schemas.MOVIE), dwd.parsed(f["tv"], schemas.TV)
    dim = {r["movie_id"]: r for r in dwd.dim_movie(m, DT).collect()}
    assert set(dim) == {1, 2} and dim[1]["title"] == "newer" and dim[2]["budget"] is None and dim[1]["budget"] == 250
    assert dim[1]["release_year"] == 1998 and dim[1]["load_time"] == datetime.datetime(2024, 5, 1) and dim[1]["collection_id"] == 40
    people = {r["person_id"]: r["gender"] for r in dwd.dim_person(dwd.parsed(f["person"], schemas.PERSON), DT).collect()}
    assert people == {1: "female", 2: "male", 3: "non-binary"}
    assert dwd.dim_genre(m, t, DT).count() == 4
    assert dwd.dim_company(m, DT).first()["normalized_name"] == "Blue Lantern"
    assert {r["keyword_name"] for r in dwd.dim_keyword(m, DT, t).collect()} == {"tide", "ferry"}
    credits = dwd.fact_credit(m, DT)
    assert credits.count() == 8 and credits.where("is_director = 1").count() == 2
    releases = {(r["movie_id"], r["country_code"]): (r["release_type"], r["release_date"]) for r in dwd.fact_release(m, DT).collect()}
    assert len(releases) == 4 and releases[1, "NZ"] == ("院线", datetime.date(1998, 3, 5)) and releases[1, "CH"] == ("其他", None)
    assert dwd.fact_snapshot(m, DT).count() == 2
    assert {k: v.count() for k, v in dwd.bridges(m, t, DT).items()} == {"bridge_movie_genre": 6, "bridge_movie_company": 2, "bridge_movie_country": 2,
        "bridge_movie_keyword": 2, "bridge_tv_genre": 1, "bridge_tv_network": 1}


def test_week_over_week(spark):
    """Nine days of one film: the change is to the seventh row before, and 0 where there is none."""
    popularity = [8.0, 9.5, 7.0, 6.0, 6.5, 9.0, 9.0, 12.0, 19.0]
    days = [(datetime.date(2023, 2, 25) + datetime.timedelta(i), 77, "Film", p, 6.5, 12, 1000, datetime.date(1998, 3, 5)) for i, p in enumerate(popularity)]
    snapshots = spark.createDataFrame(days,
        "dt date, movie_id bigint, title string, popularity double, vote_average double, vote_count int, revenue bigint, release_date date")
    credits = spark.createDataFrame([(days[2][0], 77, kind) for kind in ("cast", "cast", "crew")], "dt date, movie_id bigint, credit_type string")
    movies = spark.createDataFrame([(77, 250)], "movie_id bigint, budget bigint")
    rows = sorted(dws.movie_metric(snapshots, credits, movies).collect(), key=lambda r: r["dt"])
    assert [r["popularity_wow"] for r in rows] == [0.0] * 7 + [0.5, 1.0] and rows[0]["roi"] == 4.0
    assert [(r["cast_count"], r["crew_count"]) for r in rows[1:4]] == [(0, 0), (2, 1), (0, 0)]


def test_ranks(spark):
    rows = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0), (1, 3, 4.0), (1, 4, None)], "dt int, id int, v double")
    assert sorted((r["id"], r["rank"]) for r in ads.top(rows, "v", 1).collect()) == [(1, 1), (2, 1)]
    assert {r["id"] for r in ads.top(rows, "v", 9).collect()} == {1, 2, 3}


SCHEMA = "k bigint, title string, v double, valid_from timestamp, valid_to timestamp"
FAR = datetime.datetime(2099, 12, 31)


def batch_of(spark, day, rows):
    return spark.createDataFrame([(k, t, v, datetime.datetime(2024, 1, day), FAR) for k, t, v in rows], SCHEMA)


def state(df):
    return sorted((r["k"], r["title"] or "", r["valid_from"].day, r["valid_to"].year if r["valid_to"] == FAR else r["valid_to"].day) for r in df.collect())


def test_scd2(spark):
    empty = spark.createDataFrame([], SCHEMA)
    one = scd2.merge(empty, batch_of(spark, 1, [(1, "a", 1.0), (2, "b", 1.0)]), "k", ["title"])
    assert state(one) == [(1, "a", 1, 2099), (2, "b", 1, 2099)]
    same = scd2.merge(one, batch_of(spark, 2, [(1, "a", 9.0)]), "k", ["title"])
    assert state(same) == state(one)
    two = scd2.merge(one, batch_of(spark, 3, [(1, "A", 1.0), (3, "c", 1.0)]), "k", ["title"])
    assert state(two) == [(1, "A", 3, 2099), (1, "a", 1, 3), (2, "b", 1, 2099), (3, "c", 3, 2099)]
    assert state(scd2.merge(two, batch_of(spark, 3, [(1, "A", 1.0), (3, "c", 1.0)]), "k", ["title"])) == state(two)
    again = scd2.merge(two, batch_of(spark, 3, [(1, "B", 1.0)]), "k", ["title"])
    assert [x for x in state(again) if x[0] == 1] == [(1, "B", 3, 2099), (1, "a", 1, 3)]
    assert state(scd2.merge(two, batch_of(spark, 2, [(1, "old", 1.0)]), "k", ["title"])) == state(two)
    nulls = scd2.merge(empty, batch_of(spark, 1, [(1, None, 1.0)]), "k", ["title"])
    assert state(scd2.merge(nulls, batch_of(spark, 2, [(1, "", 1.0)]), "k", ["title"])) == state(nulls)
    facts = spark.createDataFrame([(1, datetime.datetime(2024, 1, 3)), (1, datetime.datetime(2024, 1, 2))], "k bigint, at timestamp")
    assert sorted(r["title"] for r in scd2.as_of(facts, two, "k", "at").collect()) == ["A", "a"]
    assert scd2.as_of(facts, two, "k", "at", closed=True).count() == 3


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("abc")), min_size=1, max_size=3, unique_by=lambda x: x[0]), min_size=1, max_size=3))
def test_scd2_histories_have_no_overlaps(spark, batches):
    rows = spark.createDataFrame([], SCHEMA)
    for day, one in enumerate(batches, start=1):
        rows = scd2.merge(rows, batch_of(spark, day, [(k, t, 0.0) for k, t in one]), "k", ["title"])
        rows = spark.createDataFrame(rows.collect(), SCHEMA)
    for k in {k for one in batches for k, _ in one}:
        own = sorted((r for r in rows.collect() if r["k"] == k), key=lambda r: r["valid_from"])
        assert own[-1]["valid_to"] == FAR and all(a["valid_to"] == b["valid_from"] for a, b in zip(own, own[1:], strict=False))


def test_rollups_merge_without_loss(spark):
    rows = spark.createDataFrame([(datetime.datetime(2024, 1, 1 + i // 20, i % 20, i % 60), i % 3, i * 7 % 11) for i in range(60)],
        "at timestamp, k int, v bigint")
    day = lambda c: F.date_trunc("day", c)
    merged = rollups.merged(rollups.hourly(rows, "at", ["k"], "v"), day("bucket"), ["k"])
    assert sorted(merged.collect()) == sorted(rollups.states(rows, day("at"), ["k"], "v").select(*merged.columns).collect())


def test_content_changes_and_replacing(spark):
    rows = spark.createDataFrame([(1, i, h) for i, h in enumerate(["A", "A", "B", None, "B", "A", ""])], "k int, n int, h string")
    assert [r["n"] for r in dedup.content_changes(rows, ["k"], ["n"], "h").orderBy("n").collect()] == [0, 2, 3, 5, 6]
    assert dedup.replacing(rows, ["k"], "n").first()["n"] == 6


def write_raw(spark, base, dt, **payloads):
    for kind, rows in payloads.items():
        frame(spark, kind, rows, dt).write.mode("overwrite").option("compression", "gzip").json(f"{base}/tmp/{kind}")
        for i, path in enumerate(sorted((base / "tmp" / kind).glob("*.json.gz"))):
            (base / "raw" / kind / f"dt={dt}").mkdir(parents=True, exist_ok=True)
            path.rename(base / "raw" / kind / f"dt={dt}" / f"{i}.ndjson.gz")


def test_daily_batch(spark, tmp_path):
    people = [person(1), person(2), person(3)]
    write_raw(spark, tmp_path, "2024-05-01", movie=[movie(1), movie(2)], tv=[tv(1)], person=people)
    first = {k: v.count() for k, v in batch.run(spark, str(tmp_path), "2024-05-01").items()}
    assert first["dim_movie"] == 2 and first["fact_movie_credit"] == 8 and first["ads_top_movie"] == 2 and first["dws_person_career"] == 3
    again = {k: v.count() for k, v in batch.run(spark, str(tmp_path), "2024-05-01").items()}
    assert again == first
    write_raw(spark, tmp_path, "2024-05-08", movie=[movie(1, title="X", popularity=22.0), movie(2)], tv=[tv(1)], person=people)
    third = batch.run(spark, str(tmp_path), "2024-05-08")
    assert third["dim_movie"].count() == 3 and third["dim_movie"].where("valid_to < '2099-01-01'").count() == 1
    assert third["fact_movie_daily_snapshot"].count() == 4 and third["dim_person"].count() == 3
    empty = batch.transform({k: raw.read_partition(spark, str(tmp_path), k, "1999-01-01") for k in ("movie", "tv", "person")}, "1999-01-01")
    assert all(v.count() == 0 for v in empty.values())


def test_lake_and_exports(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.publish(spark.range(5), path)
    assert lake.publish(spark.read.parquet(path).where("id < 3"), path) == 3 and spark.read.parquet(path).count() == 3
    assert lake.compact(spark, path) == 1 and spark.read.parquet(path).count() == 3
    lake.save_state(spark, str(tmp_path / "s"), {"a": 1})
    assert lake.load_state(spark, str(tmp_path / "s")) == {"a": 1} and lake.load_state(spark, str(tmp_path / "none")) == {}
    (tmp_path / "e.ndjson").write_text('{"id": 1, "title": "", "name": "n"}\n\nbroken\n{"id": 2, "title": "t"}\n')
    assert [r["display_name"] for r in raw.read_export(spark, str(tmp_path / "e.ndjson")).orderBy("id").collect()] == ["n", "t"]
    assert raw.read_or_none(spark, "no_such_table") is None
    counts = raw.export_counts(spark, str(tmp_path / "e.ndjson")).first()
    assert (counts["good"], counts["blank"], counts["malformed"]) == (2, 1, 1)
    old = spark.createDataFrame([(1, datetime.datetime(2024, 5, 1)), (2, datetime.datetime(2024, 5, 2))], "k int, valid_from timestamp")
    assert sorted(r["k"] for r in lake.replace_window(old, old.where("k = 1").withColumn("k", F.lit(9)), "valid_from", "2024-05-01 00:00:00",
        "2024-05-01 23:59:59").collect()) == [2, 9]


def test_a_failed_swap_leaves_the_table(spark, tmp_path, monkeypatch):
    """Whichever rename fails, by an error or by saying so, what was there is there."""
    path = str(tmp_path / "t")
    lake.publish(spark.range(5), path)
    real = lake._move
    for failing in (1, 2):
        calls = []

        def move(fs, source, target, failing=failing, calls=calls):
            calls.append(1)
            if len(calls) == failing:
                raise OSError("no")
            real(fs, source, target)

        monkeypatch.setattr(lake, "_move", move)
        with pytest.raises(OSError):
            lake.publish(spark.range(9), path)
        monkeypatch.setattr(lake, "_move", real)
        assert spark.read.parquet(path).count() == 5 and [p.name for p in tmp_path.iterdir()] == ["t"]


class NoRename:
    def rename(self, source, target):
        return False


def test_a_rename_that_says_no_raises():
    with pytest.raises(OSError):
        lake._move(NoRename(), "a", "b")


def test_state_survives_a_crash(spark, tmp_path):
    path = str(tmp_path / "s")
    lake.save_state(spark, path, {"a": 1})
    (tmp_path / "s").rename(tmp_path / "s.old")  # between the two renames
    assert lake.load_state(spark, path) == {"a": 1}
    lake.save_state(spark, path, {"a": 2})
    assert lake.load_state(spark, path) == {"a": 2}
    with pytest.raises(ValueError):
        lake.insert(spark.range(3), str(tmp_path / "x"), ["id", "more"])


def test_full_load_gate(spark, tmp_path):
    ids = spark.createDataFrame([(i,) for i in range(1, 21)], "id bigint")
    details = frame(spark, "movie", [movie(i) for i in range(1, 18)] + [{"id": 99}])
    details = details.withColumn("entity_id", F.when(F.col("payload") == '{"id": 99}', 18).otherwise(F.col("entity_id")))
    result = ingest.full_load(ids, details, str(tmp_path / "raw"))
    assert (result.wanted, result.loaded, result.missing, result.failed) == (20, 17, 2, 1)
    assert spark.read.json(str(tmp_path / "raw")).count() == 17
    with pytest.raises(RuntimeError):
        ingest.full_load(ids, details.withColumn("payload", F.lit("broken")), str(tmp_path / "other"))
    assert not (tmp_path / "other").exists()


def test_graph_of_the_batch(spark, tmp_path):
    write_raw(spark, tmp_path, DT, movie=[movie(1), movie(2)], tv=[tv(1)], person=[person(1), person(3)])
    vertices, edges = graph.from_tables(batch.run(spark, str(tmp_path), DT))
    assert {(r["label"], r["count"]) for r in vertices.groupBy("label").count().collect()} == {("movie", 2), ("person", 2), ("genre", 3), ("company", 1),
        ("keyword", 2)}
    kinds = {r["type"]: r["count"] for r in edges.groupBy("type").count().collect()}
    assert kinds == {"ACTED_IN": 2, "DIRECTED": 2, "HAS_GENRE": 6, "PRODUCED_BY": 2, "HAS_KEYWORD": 2}  # actor 2 is no vertex
    path = graph.path_names(graph.shortest_path(edges, 1, 3), vertices.where("label = 'person'"), vertices.where("label = 'movie'")).first()
    assert path["hops"] == 2 and path["names"] == ["Person 1", "Film 1", "Person 3"]
