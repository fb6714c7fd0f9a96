import datetime
import decimal
import json

import pytest
from pyspark.sql import functions as F

from strata.governance import access, lifecycle, lineage, metrics, migrations, quality
from strata.operators import graph
from strata.streaming import codec, sinks, stateful, trend


def test_quality_rules_fail_alone(spark):
    t = {"t": spark.createDataFrame([(1, None), (1, 5)], "a int, b int")}
    rules = [quality.Rule("rows", "t", "ROW_COUNT", least=3, severity="BLOCKER"), quality.Rule("bad", "t", "RANGE", ("zzz",)),
        quality.Rule("nulls", "t", "NOT_NULL", ("b",), most=0.5), quality.Rule("gone", "u", "ROW_COUNT")]
    out = quality.measure(spark, t, rules, "2024-01-01")
    found = {r["rule"]: (r["value"], r["passed"]) for r in out.collect()}
    assert found == {"rows": (2.0, False), "bad": (None, False), "nulls": (0.5, True), "gone": (None, False)} and quality.blocked(out)
    with pytest.raises(ValueError):
        quality.Rule("x", "t", "NONSENSE")


def test_lineage_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b")], "source string, target string")
    assert {r["table"] for r in lineage.reachable(edges, "b").collect()} == {"b", "c"}
    assert {r["table"] for r in lineage.reachable(edges, "a").collect()} == {"b", "c"} and lineage.direct(edges, "c", down=False).first()["table"] == "b"


def test_lifecycle(spark):
    plan = spark.createDataFrame([("t", datetime.date(2024, 1, 5), "DROP"), ("t", datetime.date(2024, 3, 5), "COLD")], "table string, dt date, action string")
    dropped = []
    assert {r["status"] for r in lifecycle.apply(plan, lambda *x: dropped.append(x)).collect()} == {"SKIPPED"} and not dropped
    assert sorted(r["status"] for r in lifecycle.apply(plan, lambda *x: dropped.append(x), dry_run=False).collect()) == ["APPLIED",
        "SKIPPED"] and len(dropped) == 1


def test_metrics_and_access(spark):
    r = metrics.Registry()
    r.add(metrics.Metric("m", "t", "avg(a)"))
    r.add(metrics.Metric("n", "t", "sum(toFloat64)"))
    r.add(metrics.Metric("o", "u", "avg(a)"))
    with pytest.raises(ValueError):
        r.add(metrics.Metric("m", "t", "sum(a)"))
    t = {"t": spark.createDataFrame([(1,), (3,)], "a int")}
    assert metrics.problems([metrics.Metric("x", "t", "sum(a + b + c)"), metrics.Metric("y", "t", "sum('b' || a"), metrics.Metric("x", "t", "a")],
        t) == [("x", "DUPLICATE", []), ("x", "MISSING_COLUMN", ["b", "c"])] + [("y", "INVALID", [])] + [("x", "INVALID", [])]
    assert r.validate(t) == [("n", "MISSING_COLUMN"), ("o", "MISSING_TABLE")] and r.evaluate("m", t).first()[0] == 2.0
    role = access.Role("reader", ("SELECT",), ("dws", "ads"))
    assert access.grants([role])[1] == "GRANT SELECT ON DATABASE `ads` TO ROLE `reader`" and len(access.revokes([role])) == 2
    odd = access.Role("a`b", ("select", "insert"), ("d w",), ("kim",))
    plan = access.plan([odd])
    assert plan[0] == "CREATE ROLE IF NOT EXISTS `a``b`" and plan[-1] == "GRANT ROLE `a``b` TO USER `kim`" and len(plan) == 4
    assert access.parse(plan[1]) == [access.Grant("SELECT", "d w", None, "a`b")] and access.missing([odd], ["grant SELECT, INSERT on `d w`.* to `a``b`;"]) == []
    assert access.missing([odd], [plan[1]]) == [plan[2]]
    for bad in ("DROP x", "GRANT x;y ON d TO r"):
        with pytest.raises(ValueError):
            access.parse(bad)
    with pytest.raises(ValueError):
        access.grants([access.Role("r", ("SELECT; DROP",), ("d",))])


def test_parameters():
    assert [graph.parameter(x) for x in ("limit=5", "ratio=1.50", "name = a=b ", "n=NaN")] == [("limit", 5), ("ratio", decimal.Decimal("1.50")),
        ("name", "a=b"), ("n", "NaN")]
    with pytest.raises(ValueError):
        graph.parameter("nothing")


def test_migrations_are_checked(spark, tmp_path):
    path = str(tmp_path / "history")
    one = migrations.load({"V2__b.sql": ["SELECT 2"], "V1__a.sql": ["SELECT 1"]})
    assert migrations.migrate(spark, one, path, dry_run=True) == [1, 2] and not (tmp_path / "history").exists()
    assert migrations.migrate(spark, one, path) == [1, 2] and migrations.migrate(spark, one, path) == []
    for scripts in ({"V1__a.sql": ["SELECT 9"], "V2__b.sql": ["SELECT 2"]}, {"V0__z.sql": ["SELECT 0"], "V1__a.sql": ["SELECT 1"], "V2__b.sql": ["SELECT 2"]}):
        with pytest.raises(ValueError):
            migrations.migrate(spark, migrations.load(scripts), path)
    for scripts in ({"a.sql": []}, {"V1__a.sql": [], "V01__b.sql": []}):
        with pytest.raises(ValueError):
            migrations.load(scripts)


def test_sinks_try_again(spark):
    waits, calls = [], []

    def write(batch, batch_id):
        calls.append(batch_id)
        if len(calls) < 3:
            raise OSError("down")

    sinks.retrying(write, attempts=3, sleep=waits.append)(spark.range(1), 7)
    assert calls == [7, 7, 7] and waits == [0.2, 0.4]
    calls[:] = []
    with pytest.raises(OSError):
        sinks.retrying(write, attempts=2, sleep=waits.append)(spark.range(1), 7)


def test_a_stream_goes_on_after_a_failure(spark, tmp_path):
    """A write that fails ends the query; the next start begins with the same batch, and nothing is lost or doubled."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\n2\n")
    stream, down = spark.readStream.text(str(tmp_path / "in")), [True]
    write = sinks.idempotent(str(tmp_path / "out"))

    def failing(batch, batch_id):
        write(batch, batch_id)
        if down:
            raise OSError("after the write")

    with pytest.raises(Exception, match="after the write"):
        sinks.run_available(stream, str(tmp_path / "cp"), "", failing).awaitTermination()
    down.clear()
    (tmp_path / "in" / "b.txt").write_text("3\n")
    for _ in range(2):
        sinks.run_available(stream, str(tmp_path / "cp"), "", failing).awaitTermination()
    assert sorted(r["value"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3"]


def test_graph(spark):
    edges = spark.createDataFrame([(1, 10, "ACTED_IN"), (2, 10, "ACTED_IN"), (2, 11, "ACTED_IN"), (3, 11, "DIRECTED"), (10, 5, "HAS_GENRE"),
        (11, 5, "HAS_GENRE")], "from_id bigint, to_id bigint, type string")
    assert graph.coactors(edges).collect()[0][:] == (1, 2, 1)
    assert graph.shortest_path(edges, 1, 3).first()[:] == (4, "p1>m10>p2>m11>p3") and graph.shortest_path(edges, 1, 3,
        3).isEmpty() and graph.shortest_path(edges, 1, 99).isEmpty()
    assert [graph.circle(edges, 1, d).first()[0] for d in (1, 3)] == [1, 2]
    assert graph.similar(edges, 10).first()[:] == (11, 2)


def message(**more):
    return json.dumps({"event_type": "POPULARITY_OBSERVED", "entity_type": "movie", "entity_id": 1, "event_time": 1_700_000_000_000,
        "payload": {"popularity": 5.5, "title": "T"}} | more)


def test_codec(spark):
    bad = [None, "", "not-json", "{}", "[]", message(event_type="X"), message(entity_type="y"), message(entity_id="no"), message(entity_id="12"),
        message(event_time="1700000000000"), message(event_time=None)]
    camel = json.dumps({"eventType": "ENTITY_CHANGED", "entityType": "tv", "entityId": 2, "eventTime": 5})
    rows = codec.decode(spark.createDataFrame([(x,) for x in [*bad, message(), camel]], "value string"))
    assert codec.dead_letters(rows).count() == len(bad)
    good = codec.popularity(codec.good(rows)).orderBy("entity_id").collect()
    assert [(r["entity_id"], r["popularity"], r["source"], r["schema_version"]) for r in good] == [(1, 5.5, "unknown", 1),
        (2, None, "unknown", 1)] and good[1]["ingest_ms"] == 5


def test_windows_and_surges(spark):
    at = lambda minute: datetime.datetime(2024, 1, 1, 0, minute)
    rows = [(1, at(0), 20.0, 8.0, 5, "a", "l"), (1, at(1), None, None, None, "", ""), (1, at(6), 40.0, None, 6, "b", "l"), (1, at(7), 30.0, None, 6, "", ""),
        (1, at(8), 50.0, 7.0, 7, "", "")]
    events = spark.createDataFrame(rows, "entity_id bigint, event_time timestamp, popularity double, vote_average double, vote_count int, title string, list_name string")
    w = trend.windowed(events, extra=trend.popularity_extras()).orderBy("window_start").collect()
    assert [(r["samples"], r["average"], r["most"], r["title"], r["vote_average"]) for r in w] == [(2, 10.0, 20.0, "a", 8.0), (3, 40.0, 50.0, "b", 7.0)]
    none = trend.windowed(events.withColumn("vote_average", F.lit(None).cast("double")), extra=trend.popularity_extras()).collect()
    assert {r["vote_average"] for r in none} == {0.0}
    alerts = stateful.surges(spark.createDataFrame(w), ["entity_id"]).collect()
    assert [(a["ratio"], a["alert_id"]) for a in alerts] == [(4.0, "surge:1:1704067500000")]


def test_stream_splits_bad_messages(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(message() + "\nbroken\n" + message(entity_id=2) + "\n")
    stream = spark.readStream.text(str(tmp_path / "in"))
    write = sinks.split(str(tmp_path / "good"), str(tmp_path / "bad"), codec.decode, lambda d: codec.good(d).drop("value"), codec.dead_letters)
    for _ in range(2):  # a second run finds nothing new
        sinks.run_available(stream, str(tmp_path / "cp"), "", write).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2 and spark.read.parquet(str(tmp_path / "bad")).select("value").first()[0] == "broken"
    assert sinks.latest_rows(spark.range(3).withColumn("k", F.lit(1)), ["k"], "id").first()["id"] == 2
