"""Rows of operators that other queries run only inside of something: dead letters, observations, limits, blocking,
parameters, constraints, grants, and what the catalogue says.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.governance import access, catalogue, quality
from strata.operators import graph
from strata.queries import views as V
from strata.queries.batch import no_zone
from strata.queries.graphs import E
from strata.queries.registry import query
from strata.queries.streams import envelopes, in_files
from strata.queries.writes import scratch
from strata.sources import lake, raw
from strata.streaming import codec, sinks, trend


@query("SELECT CASE event_id % 10 WHEN 7 THEN 'not-json' WHEN 8 THEN '[]' ELSE '{}' END AS value, count(*) AS \"rows\", (SELECT count(*) FROM events WHERE event_id % 10 < 7) AS good FROM events WHERE event_id % 10 >= 7 GROUP BY 1")
def sink_dead_letters(spark, t) -> DataFrame:
    """A stream of two batches, whose good rows go to one table and the others to the dead-letter table."""
    base, rows = scratch(spark, "letters"), envelopes(t)
    stream = in_files(spark, [rows.where(F.col("event_id") % 2 == k).select("value") for k in range(2)], f"{base}/in")
    write = sinks.split(f"{base}/good", f"{base}/bad", codec.decode, codec.good, codec.dead_letters)
    sinks.run_available(stream, f"{base}/checkpoint", "", write).awaitTermination()
    good = spark.read.parquet(f"{base}/good").count()
    return spark.read.parquet(f"{base}/bad").groupBy("value").agg(F.count(F.lit(1)).alias("rows")).withColumn("good", F.lit(good).cast("bigint"))


#: A title is empty at every fifth millisecond; every third event is about a person.
TITLE = "CASE WHEN ms % 5 = 0 THEN '' ELSE 't' || ms % 7 END"


@query(f"""WITH o AS (SELECT event_id, epoch_us(ts) // 1000 AS ms, round(value * 100)::BIGINT AS popularity, event_id % 11 AS votes FROM events WHERE event_id % 3 > 0),
n AS (SELECT *, make_timestamp(ms * 1000) AS moment, {TITLE} AS title FROM o)
SELECT date_trunc('day', moment) AS window_start, count(*) AS samples, sum(popularity)::BIGINT AS total, max(votes)::INT AS vote_count,
  round(coalesce(avg(CASE WHEN votes > 0 THEN votes END), 0), 6) AS vote_average, arg_max(title, moment) FILTER (WHERE title <> '') AS title, 'day' AS list_name FROM n GROUP BY 1""")
def stream_observations(spark, t) -> DataFrame:
    """Messages about movies as observations, by day: votes that are known, and the last title that is not empty."""
    ms, n = F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id")
    votes = F.nullif(n % 11, F.lit(0))
    payload = F.to_json(F.struct(F.when(ms % 5 == 0, "").otherwise(F.concat(F.lit("t"), ms % 7)).alias("title"), V.cents("value").alias("popularity"),
        votes.alias("vote_average"), (n % 11).alias("vote_count"), F.lit("day").alias("list_name")))
    text = F.to_json(F.struct(F.lit("POPULARITY_OBSERVED").alias("event_type"), F.when(n % 3 > 0, "movie").otherwise("person").alias("entity_type"),
        n.alias("entity_id"), ms.alias("event_time"), payload.alias("payload")))
    events = codec.of_types(codec.good(codec.decode(t.events.select(text.alias("value")))), "movie")
    rows = trend.windowed(codec.to_observations(events), keys=("entity_type",), width="1 day", extra=trend.popularity_extras())
    return no_zone(rows.select("window_start", "samples", F.col("total").cast("bigint").alias("total"), "vote_count", F.round("vote_average", 6).alias("vote_average"),
        "title", "list_name"))


@query(E + "SELECT from_id AS person_id, count(DISTINCT to_id) AS degree FROM edges WHERE type IN ('ACTED_IN', 'DIRECTED') GROUP BY 1 ORDER BY degree DESC, person_id LIMIT 10")
def graph_degree_top(spark, t) -> DataFrame:
    """The first ten; equal degrees by id."""
    return graph.degree(V.edges(t), 10)


@query("SELECT least(50, count(*)) AS \"rows\", TRUE AS known FROM customer")
def source_export_limit(spark, t) -> DataFrame:
    """The first fifty records of an export, whichever they are."""
    path = scratch(spark, "export")
    t.customer.select(F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("title"))).alias("value")).write.text(path)
    lake.delete(spark, f"{path}/_SUCCESS")
    rows = raw.read_export(spark, f"{path}/part-*", limit=50)
    known = rows.join(t.customer, F.col("id") == F.col("c_custkey"), "left")
    return known.agg(F.count(F.lit(1)).alias("rows"), F.every(F.col("title") == F.col("c_name")).alias("known"))


@query("SELECT 'strict' AS run, max(o_totalprice) > 100000 AS blocked FROM orders UNION ALL SELECT 'lenient', FALSE")
def dq_blocked(spark, t) -> DataFrame:
    """A rule that fails blocks what follows if it says so, and does not if it warns."""
    rule = {"name": "prices", "table": "orders", "kind": "range", "column": "o_totalprice", "max": 100_000}
    found = []
    for run, severity in (("strict", "blocker"), ("lenient", "warn")):
        results = quality.measure(spark, {"orders": t.orders}, [quality.rule_from(rule | {"severity": severity})], "2025-01-01")
        found.append((run, quality.blocked(results)))
    return spark.createDataFrame(found, "run string, blocked boolean")


@query("""SELECT lower(n_name) AS name, CASE n_nationkey % 3 WHEN 0 THEN 'int' WHEN 1 THEN 'Decimal' ELSE 'str' END AS kind,
  CASE n_nationkey % 3 WHEN 0 THEN '' || n_nationkey WHEN 1 THEN n_nationkey || '.50' ELSE 'n' || n_nationkey END AS value FROM nation""")
def graph_parameters(spark, t) -> DataFrame:
    """Parameters as users give them, by name and type."""
    k = F.col("n_nationkey")
    said = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat(k, F.lit(".50"))).otherwise(F.concat(F.lit("n"), k))
    given = t.nation.select(F.concat(F.lower("n_name"), F.lit(" = "), said).alias("text")).toLocalIterator()  # what one query's caller gives
    rows = [(name, type(value).__name__, str(value)) for name, value in (graph.parameter(r["text"]) for r in given)]
    return spark.createDataFrame(rows, "name string, kind string, value string")


@query("""SELECT label, id, n FROM (SELECT 'nation' AS label, CASE WHEN n_nationkey % 7 > 0 THEN n_regionkey END AS id, count(*) AS n FROM nation GROUP BY 2
UNION ALL SELECT 'supplier', s_suppkey, count(*) FROM supplier GROUP BY 2) WHERE n > 1 OR id IS NULL""")
def graph_violations(spark, t) -> DataFrame:
    """Vertices that break the constraint: ids that are missing, or occur twice under a label."""
    nations = t.nation.select(F.lit("nation").alias("label"), F.when(F.col("n_nationkey") % 7 > 0, F.col("n_regionkey")).alias("id"))
    return graph.violations(nations.unionByName(t.supplier.select(F.lit("supplier").alias("label"), F.col("s_suppkey").alias("id"))))


@query("SELECT 'there' AS name, count(*) AS \"rows\" FROM nation UNION ALL SELECT 'not there', NULL")
def source_table_or_none(spark, t) -> DataFrame:
    """A table of the catalogue, and one that it does not have."""
    name, out = f"t_{uuid.uuid4().hex}", []
    t.nation.write.option("path", scratch(spark, "table")).saveAsTable(name)
    try:
        for said, table in (("there", name), ("not there", f"{name}_x")):
            rows = raw.read_or_none(spark, table)
            out.append((said, None if rows is None else rows.count()))
    finally:
        spark.sql(f"DROP TABLE {name}")
    return spark.createDataFrame(out, "name string, rows bigint")


@query("""SELECT 'CREATE ROLE IF NOT EXISTS `' || r_name || '`' AS statement, 'PLAN' AS what FROM region
UNION ALL SELECT 'GRANT SELECT ON DATABASE `' || n_name || '` TO ROLE `' || r_name || '`', 'PLAN' FROM nation JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'GRANT SELECT ON DATABASE `' || n_name || '` TO ROLE `' || r_name || '`', 'MISSING' FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 2 = 1
UNION ALL SELECT 'REVOKE SELECT ON DATABASE `' || n_name || '` FROM ROLE `' || r_name || '`', 'REVOKE' FROM nation JOIN region ON n_regionkey = r_regionkey""")
def access_grants(spark, t) -> DataFrame:
    """A role a region, which reads its nations' databases: the plan, what is missing where the even ones are in force, and how to take it back."""
    held = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).groupBy("r_name").agg(F.sort_array(F.collect_list("n_name")).alias("names")).collect()  # a row a role
    even = {r[0] for r in t.nation.where("n_nationkey % 2 = 0").select("n_name").collect()}
    roles = [access.Role(r["r_name"], ("select",), tuple(r["names"])) for r in held]
    present = [f"grant select on {access.quoted(n)}.* to {access.quoted(r.name)}" for r in roles for n in r.databases if n in even]
    rows = [(s, "PLAN") for s in access.plan(roles)] + [(s, "MISSING") for s in access.missing(roles, present)] + [(s, "REVOKE") for s in access.revokes(roles)]
    return spark.createDataFrame(rows, "statement string, what string")


@query("SELECT 'orders' AS name, 'parquet' AS format, 'dt' AS partitioned_by, 4 AS columns, count(*) AS \"rows\" FROM orders UNION ALL SELECT 'nation', 'parquet', '', 2, count(*) FROM nation")
def catalogue_tables(spark, t) -> DataFrame:
    """Two tables of a database as the catalogue lists them, with their columns, and the rows that their footers count."""
    database = f"d_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch(spark, 'database')}'")
    try:
        rows = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.trunc("o_orderdate", "year").alias("dt"))
        rows.write.option("path", scratch(spark, "orders")).partitionBy("dt").saveAsTable(f"{database}.orders")
        t.nation.select("n_nationkey", "n_name").write.option("path", scratch(spark, "nation")).saveAsTable(f"{database}.nation")
        tables, columns = catalogue.tables(spark, database), catalogue.columns(spark, database).groupBy("table").agg(F.count(F.lit(1)).cast("int").alias("columns"))
        counted = [catalogue.files(spark, r["location"], r["table"]).agg(F.lit(r["table"]).alias("table"), F.sum("rows").alias("rows")) for r in tables.collect()]
        found = tables.join(columns, "table").join(counted[0].unionByName(counted[1]), "table")
        found = found.select(F.substring_index("table", ".", -1).alias("name"), F.lower("format").alias("format"),
            F.array_join("partitioned_by", ",").alias("partitioned_by"), "columns", "rows")
        return spark.createDataFrame(found.collect(), found.schema)  # a row a table, before the database goes
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
