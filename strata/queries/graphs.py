"""Graph analytics as queries over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators import graph
from strata.queries import views as V
from strata.queries.registry import query
from strata.session import shared_folder
from strata.sources import lake

E = f"WITH {V.EDGES} "
ACTED = "(SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'ACTED_IN')"
DIRECTED = "(SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'DIRECTED')"
GENRE = "(SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'HAS_GENRE')"
WORD = "(SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'HAS_KEYWORD')"
MADE = "(SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'PRODUCED_BY')"


@query(E + "SELECT from_id AS person_id, count(DISTINCT to_id) AS degree FROM edges WHERE type IN ('ACTED_IN', 'DIRECTED') GROUP BY 1")
def graph_degree(spark, t) -> DataFrame:
    return graph.degree(V.edges(t))


@query(E + f"SELECT a.from_id AS a_id, b.from_id AS b_id, count(*) AS shared FROM {ACTED} a JOIN {ACTED} b ON a.to_id = b.to_id AND a.from_id < b.from_id GROUP BY 1, 2 ORDER BY shared DESC, a_id, b_id LIMIT 100")
def graph_coactors(spark, t) -> DataFrame:
    return graph.coactors(V.edges(t), 100)


@query(E + f"SELECT a.from_id AS director_id, b.from_id AS actor_id, count(*) AS shared FROM {DIRECTED} a JOIN {ACTED} b ON a.to_id = b.to_id GROUP BY 1, 2 ORDER BY shared DESC, director_id, actor_id LIMIT 100")
def graph_director_actor(spark, t) -> DataFrame:
    return graph.director_actor(V.edges(t), 100)


@query(E + f"SELECT b.from_id AS person_id, count(*) AS shared FROM {ACTED} a JOIN {ACTED} b ON a.to_id = b.to_id AND a.from_id = 3 AND b.from_id <> 3 GROUP BY 1")
def graph_actor_network(spark, t) -> DataFrame:
    return graph.actor_network(V.edges(t), 3)


@query(E + f"SELECT a.to_id AS a_id, b.to_id AS b_id, count(*) AS movies FROM {WORD} a JOIN {WORD} b ON a.from_id = b.from_id AND a.to_id < b.to_id GROUP BY 1, 2")
def graph_genre_cooccur(spark, t) -> DataFrame:
    """A part has one genre, so its keywords stand in for pairs of genres."""
    return graph.cooccurrence(V.edges(t), "HAS_KEYWORD")


@query(E + f"SELECT a.to_id AS company_id, b.to_id AS genre_id, count(*) AS movies FROM {MADE} a JOIN {GENRE} b ON a.from_id = b.from_id GROUP BY 1, 2")
def graph_company_genre(spark, t) -> DataFrame:
    return graph.company_genre(V.edges(t))


@query(E + """, f AS (SELECT DISTINCT to_id AS movie_id, type || ':' || from_id AS feature FROM edges WHERE type = 'ACTED_IN' UNION SELECT from_id, type || ':' || to_id FROM edges WHERE type IN ('HAS_GENRE', 'HAS_KEYWORD'))
SELECT b.movie_id, count(*) AS shared FROM f a JOIN f b ON a.feature = b.feature AND a.movie_id = 7 AND b.movie_id <> 7 GROUP BY 1""")
def graph_similar(spark, t) -> DataFrame:
    return graph.similar(V.edges(t), 7)


@query(E + "SELECT to_id AS keyword_id, count(DISTINCT from_id) AS movies FROM edges WHERE type = 'HAS_KEYWORD' GROUP BY 1")
def graph_keyword(spark, t) -> DataFrame:
    return graph.keyword_centrality(V.edges(t))


def counted(t) -> DataFrame:
    """Parts are the movies, suppliers the persons."""
    movies = t.part.select(F.col("p_partkey").alias("id"), F.lit("movie").alias("label"))
    return graph.counts(movies.unionByName(t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("person").alias("label"))), V.edges(t))


COUNTS = E + "SELECT 'edge' AS what, type AS kind, count(*) AS \"count\" FROM edges GROUP BY 2 UNION ALL SELECT 'vertex', 'movie', count(*) FROM part UNION ALL SELECT 'vertex', 'person', count(*) FROM supplier"


@query(COUNTS)
def graph_counts(spark, t) -> DataFrame:
    return counted(t)


@query(COUNTS)
def graph_counts_whole(spark, t) -> DataFrame:
    """Counts of the whole graph, written and read again."""
    path = f"{shared_folder(spark)}/graph-{uuid.uuid4()}"
    movies = t.part.select(F.lit("movie").alias("label"), F.col("p_partkey").alias("id"))
    persons = t.supplier.select(F.lit("person").alias("label"), F.col("s_suppkey").alias("id"))
    lake.publish(movies.unionByName(persons), f"{path}/vertices")
    lake.publish(V.edges(t), f"{path}/edges")
    return graph.counts(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"))


@query(E + f", small AS (SELECT p_partkey FROM part WHERE p_size <= 25), sup AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) SELECT from_id, to_id, type FROM edges WHERE type = 'ACTED_IN' AND to_id IN (FROM small) AND from_id IN (FROM sup)")
def graph_checked_edges(spark, t) -> DataFrame:
    """Edges with a missing end are left out. Movies have negative ids here, as vertices share one id space."""
    acted = graph.of(V.edges(t), "ACTED_IN").select("from_id", (-1 - F.col("to_id")).alias("to_id"), "type")
    vertices = t.part.where("p_size <= 25").select((-1 - F.col("p_partkey")).alias("id")).unionByName(t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("id")))
    return graph.checked_edges(acted, vertices).select("from_id", (-1 - F.col("to_id")).alias("to_id"), "type")


#: All credits, undirected. One of several shortest paths is taken, the least by its nodes.
LINKS = "s AS (SELECT DISTINCT from_id, to_id FROM edges WHERE type IN ('ACTED_IN', 'DIRECTED')), links AS (SELECT 'p' || from_id AS u, 'm' || to_id AS v FROM s UNION ALL SELECT 'm' || to_id, 'p' || from_id FROM s)"
HOPS = E + f""", {LINKS},
  n1 AS (SELECT DISTINCT v AS node, 1 AS h FROM links WHERE u = 'p1'), n2 AS (SELECT DISTINCT v AS node FROM links WHERE u IN (SELECT node FROM n1)),
  n3 AS (SELECT DISTINCT v AS node FROM links WHERE u IN (FROM n2)), n4 AS (SELECT DISTINCT v AS node FROM links WHERE u IN (FROM n3)),
  n5 AS (SELECT DISTINCT v AS node FROM links WHERE u IN (FROM n4)), n6 AS (SELECT DISTINCT v AS node FROM links WHERE u IN (FROM n5))
SELECT min(h)::INT AS hops FROM (SELECT 2 AS h FROM n2 WHERE node = 'p2' UNION ALL SELECT 4 FROM n4 WHERE node = 'p2' UNION ALL SELECT 6 FROM n6 WHERE node = 'p2') HAVING min(h) IS NOT NULL"""


@query(HOPS)
def graph_shortest_path(spark, t) -> DataFrame:
    return graph.shortest_path(V.edges(t), 1, 2).select("hops")


@query(HOPS.replace("'p1'", "'p3'").replace("'p2'", "'p5'"))
def graph_shortest_path_whole(spark, t) -> DataFrame:
    """Between two other persons; edges that are listed twice count once."""
    credits = graph.of(V.edges(t), graph.CREDITS)
    return graph.shortest_path(credits.unionByName(credits.where("to_id % 2 = 0")), 3, 5).select("hops")


@query(E + f""", {LINKS}, two AS (SELECT min('p1>' || a.v || '>p2') AS path FROM links a JOIN links b ON a.v = b.u WHERE a.u = 'p1' AND b.v = 'p2')
SELECT 2 AS hops, path, (SELECT s_name FROM supplier WHERE s_suppkey = 1) || ' > ' || p_name || ' > ' || (SELECT s_name FROM supplier WHERE s_suppkey = 2) AS names FROM two JOIN part ON path = 'p1>m' || p_partkey || '>p2'""")
def graph_path_names(spark, t) -> DataFrame:
    """A shortest path with the names along it."""
    found = graph.shortest_path(V.edges(t), 1, 2)
    named = graph.path_names(found, t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))
    return named.select("hops", "path", F.array_join("names", " > ").alias("names"))


CIRCLE = E + f", {LINKS}, a AS (SELECT DISTINCT from_id, to_id FROM edges WHERE type = 'ACTED_IN'), m1 AS (SELECT DISTINCT to_id FROM a WHERE from_id = 1), p2 AS (SELECT DISTINCT from_id FROM a WHERE to_id IN (FROM m1)) SELECT count(DISTINCT to_id) AS movies FROM a WHERE from_id IN (FROM p2)"


@query(CIRCLE)
def graph_circle(spark, t) -> DataFrame:
    return graph.circle(V.edges(t), 1, 3)


@query(CIRCLE)
def graph_circle_whole(spark, t) -> DataFrame:
    """Three hops again; edges that are listed twice count once."""
    acted = graph.of(V.edges(t), "ACTED_IN")
    return graph.circle(acted.unionByName(acted.where("to_id % 2 = 0")), 1, 3)
