"""Files and tables on disk: ingestion up to a report, rolled files, upserts, partitions swapped together."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import dwd, graph
from strata.plans import batch, ingest
from strata.queries import records as R
from strata.queries.registry import query
from strata.queries.writes import ORDERS, orders, scratch
from strata.sources import lake, raw, schemas, swap, upserts


@query(f"SELECT p_partkey AS entity_id, {R.FIRST} + p_partkey * 60000 AS ingest_time, TRUE AS lines_kept, TRUE AS bytes_kept FROM part")
def sink_rolling_files(spark, t) -> DataFrame:
    """Files of at most 40 lines and 64 KiB: whether each that is read back keeps to that."""
    base = scratch(spark, "rolled")
    lake.write_ndjson(R.raw_movies(t), f"{base}/raw/movie/dt={R.DT}", records_per_file=40, bytes_per_file=1 << 16)
    rows = raw.read_partition(spark, base, "movie", R.DT).select("entity_id", "ingest_time", F.to_json(F.struct("*")).alias("line"),
        F.col("_metadata.file_name").alias("file"))
    files = rows.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.sum(F.octet_length("line") + 1).alias("bytes"))
    return rows.join(files, "file").select("entity_id", "ingest_time", (F.col("lines") <= 40).alias("lines_kept"), (F.col("bytes") <= 1 << 16).alias("bytes_kept"))


@query(R.SUMMARY + " SELECT substr(p_brand, 7, 2)::BIGINT AS company_id, count(DISTINCT movie_id) AS movie_count, sum(budget)::BIGINT AS total_budget, sum(revenue)::BIGINT AS total_revenue, round(avg(revenue / budget), 6) AS avg_roi FROM now GROUP BY 1")
def ingest_to_report(spark, t) -> DataFrame:
    """Details are loaded as raw files, the day's batch reads these and writes its tables; a report of them."""
    base = scratch(spark, "day")
    for kind, rows in (("movie", R.raw_movies(t)), ("tv", R.raw_tv(t)), ("person", R.raw_persons(t))):
        ingest.full_load(rows.select(F.col("entity_id").alias("id")), rows, f"{base}/raw/{kind}/dt={R.DT}", most_failed=0.5)
    written = batch.run(spark, base, R.DT)["dws_company_finance"]
    return written.select("company_id", "movie_count", "total_budget", "total_revenue", F.round("avg_roi", 6).alias("avg_roi"))


@query(f"""WITH {ORDERS} SELECT o_orderkey, CASE WHEN o_orderkey < 40 THEN 'new' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey < 40 THEN cents + 1 ELSE cents END AS cents, TRUE AS others_untouched, TRUE AS repeat_wrote_nothing FROM o
UNION ALL SELECT NULL, 'no key', 0, TRUE, TRUE""")
def sink_upsert(spark, t) -> DataFrame:
    """Two merges on disk, the second one repeated. A few keys change and a null key comes, twice; the files of all other buckets stay."""
    path = scratch(spark, "upserted")
    rows = orders(t).select("o_orderkey", F.col("o_orderstatus").alias("status"), "cents")
    upserts.create(rows, path, ["o_orderkey"], buckets=32)
    files = lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files()
    some = rows.where("o_orderkey < 40").withColumns({"status": F.lit("new"), "cents": F.col("cents") + 1})
    no_key = spark.createDataFrame([(None, "no key", 0), (None, "no key", -1)], rows.schema)
    wrote = upserts.upsert(some.unionByName(no_key), path)
    after = files()
    kept = {f for f in before if f.split("/")[-2] not in wrote} <= after and len(wrote) < 32
    again = upserts.upsert(some.unionByName(no_key), path) == [] and files() == after
    return upserts.read(spark, path).select("*", F.lit(kept).alias("others_untouched"), F.lit(again).alias("repeat_wrote_nothing"))


@query(f"""WITH {ORDERS} SELECT o_orderkey, CASE year(dt) WHEN 1995 THEN 'fewer' WHEN 1996 THEN 'staged' WHEN 1994 THEN 'window' ELSE o_orderstatus END AS status, dt
FROM o WHERE year(dt) <> 1993 AND NOT (year(dt) = 1995 AND o_orderkey % 2 = 1) AND NOT (year(dt) = 1994 AND o_orderkey % 3 <> 0)""")
def sink_swap_partitions(spark, t) -> DataFrame:
    """A year with fewer rows, one that goes, one taken from a staging table, and a window of time; a swap that a crash leaves is undone."""
    path, staging = scratch(spark, "orders"), scratch(spark, "staging")
    rows = orders(t).select("o_orderkey", F.col("o_orderstatus").alias("status"), "dt").withColumn("at", F.col("dt").cast("timestamp"))
    lake.overwrite_partitions(rows, path)
    said = lambda year, word: rows.where(F.year("dt") == year).withColumn("status", F.lit(word))
    swap.replace_partitions(said(1995, "fewer").where("o_orderkey % 2 = 0"), path, also=["1993-01-01"])
    lake.overwrite_partitions(said(1996, "staged"), staging)
    swap.take_partitions(spark, staging, path)
    swap.replace_window(spark, path, said(1994, "window").where("o_orderkey % 3 = 0"), "at", "1994-01-01 00:00:00", "1994-12-31 00:00:00")
    real, calls = lake._move, []

    def crashing(fs, source, target):
        calls.append(1)
        if len(calls) == 3:
            raise SystemExit
        real(fs, source, target)

    lake._move = crashing
    try:
        swap.replace_partitions(rows.where("year(dt) in (1995, 1997)").withColumn("status", F.lit("lost")), path)
    except SystemExit:
        pass
    finally:
        lake._move = real
    swap.recover(spark, path)
    return spark.read.parquet(path).select("o_orderkey", "status", F.col("dt").cast("date").alias("dt"))


@query(R.GRAPH_EDGES + " SELECT from_id, to_id, type, 2 AS loads FROM e")
def graph_saved(spark, t) -> DataFrame:
    """A graph saved in two overlapping loads, vertices before edges; keywords are left out as in ``graph_edges_of_tables``."""
    # Records are parsed once, by all cores however few files the tables have, and both loads take one graph. What is kept is kept
    # before filters: Spark would parse for a filter before it deals rows out, and again for what the filter leaves.
    part, customer = t.part.repartition("p_partkey").persist(), t.customer.repartition("c_custkey").persist()
    dealt = SimpleNamespace(part=part, customer=customer)
    records = R.raw_movies(dealt).select("ingest_time", F.from_json("payload", schemas.MOVIE).alias("p")).persist()
    movies, persons = records.where("p.id is not null"), dwd.parsed(R.raw_persons(dealt), schemas.PERSON)
    vertices, edges = graph.from_tables(R.modelled(movies, R.tv(t), persons))
    vertices, edges = vertices.persist(), edges.where("type <> 'HAS_KEYWORD'").persist()
    path, loads = scratch(spark, "graph"), 0
    try:
        for some in ("from_id % 2 = 0", "from_id % 2 = 1 or from_id % 3 = 0"):
            graph.save(vertices, edges.where(some), path, buckets=4)
            loads += 1
    finally:
        for rows in (edges, vertices, records, part, customer):
            rows.unpersist()
    return graph.load(spark, path)[1].select("from_id", "to_id", "type", F.lit(loads).alias("loads"))


@query(f"WITH {ORDERS} SELECT o_orderkey, cents, dt, TRUE AS merged, TRUE AS kept FROM o")
def sink_compacted(spark, t) -> DataFrame:
    """Years in many small files, but for one: whether the small ones have become one a year, and the other is the file that it was."""
    path, rows = scratch(spark, "small"), orders(t).select("o_orderkey", "cents", "dt")
    for k in range(3):
        rows.where("year(dt) <> 1995").where(F.col("o_orderkey") % 3 == k).repartition("dt").write.mode("append").partitionBy("dt").parquet(path)
    rows.where("year(dt) = 1995").repartition(1).write.mode("append").partitionBy("dt").parquet(path)
    names = lambda: {tuple(r) for r in spark.read.parquet(path).select(F.year("dt"), "_metadata.file_name").distinct().collect()}
    before = {n for n in names() if n[0] == 1995}
    swap.compact(spark, path, by="dt")
    after = names()
    merged, kept = len({y for y, _ in after}) == len(after), before <= after
    found = spark.read.parquet(path).select("o_orderkey", "cents", F.col("dt").cast("date").alias("dt"))
    return found.withColumns({"merged": F.lit(merged), "kept": F.lit(kept)})
