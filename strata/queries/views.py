"""The driver's tables in the roles of the engine's model, in Spark and in SQL.

Doubles are added as whole cents (or 1/10000 of ratios), so sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.queries.registry import Tables


def cents(c: Column | str) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * 100).cast("bigint")


def movies(t: Tables) -> DataFrame:
    """part as a movie dimension with its revenue, in cents."""
    revenue = t.lineitem.groupBy(F.col("l_partkey").alias("movie_id")).agg(F.sum(cents("l_extendedprice")).alias("revenue"),
        F.year(F.min("l_shipdate")).alias("release_year"))
    part = t.part.select(F.col("p_partkey").alias("movie_id"), F.col("p_name").alias("title"), F.col("p_type").alias("genre"),
        F.col("p_brand").alias("company"), F.col("p_size").alias("popularity"), cents("p_retailprice").alias("budget"))
    return part.join(revenue, "movie_id", "left")


MOVIES = """revenue AS (
  SELECT l_partkey AS movie_id, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS revenue, year(min(l_shipdate))::INT AS release_year
  FROM lineitem GROUP BY 1
), movies AS (
  SELECT p_partkey AS movie_id, p_name AS title, p_type AS genre, p_brand AS company, p_size AS popularity, round(p_retailprice * 100)::BIGINT AS budget, revenue, release_year
  FROM part LEFT JOIN revenue ON movie_id = p_partkey
)"""


def persons(t: Tables) -> DataFrame:
    nation = t.nation.select("n_nationkey", F.col("n_name").alias("country"))
    return t.supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("person_id"),
        F.col("s_name").alias("person_name"), "country", cents("s_acctbal").alias("popularity_cents"))


PERSONS = """persons AS (
  SELECT s_suppkey AS person_id, s_name AS person_name, n_name AS country, round(s_acctbal * 100)::BIGINT AS popularity_cents FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""


def credits(t: Tables) -> DataFrame:
    """lineitem as credits; (order, line) is no key, so one row of each is taken."""
    kind = F.when(F.col("l_returnflag") == "R", "crew").otherwise("cast")
    director = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0)
    return t.lineitem.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("credit_id"), F.col("l_partkey").alias("movie_id"),
        F.col("l_suppkey").alias("person_id"), kind.alias("credit_type"), director.alias("is_director"), F.col("l_shipdate").alias("at"),
        F.col("l_quantity").cast("int").alias("quantity"))


CREDITS = """credits AS (
  SELECT l_orderkey || '-' || l_linenumber AS credit_id, l_partkey AS movie_id, l_suppkey AS person_id,
         CASE WHEN l_returnflag = 'R' THEN 'crew' ELSE 'cast' END AS credit_type,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 1 ELSE 0 END AS is_director, l_shipdate AS made_at, l_quantity::INT AS quantity
  FROM lineitem
)"""


def observed(t: Tables) -> DataFrame:
    """events as observations of popularity, in cents."""
    return t.events.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), F.col("user_id").alias("entity_id"), "event_type",
        cents("value").alias("popularity"), "props")


OBSERVED = "observed AS (SELECT event_id, ts AS event_time, user_id AS entity_id, event_type, round(value * 100)::BIGINT AS popularity, props FROM events)"


def daily(t: Tables) -> DataFrame:
    """Daily means per event type, in thousandths of a cent."""
    rows = observed(t).groupBy(F.to_date("event_time").alias("dt"), "event_type")
    return rows.agg(F.expr("(sum(popularity) * 1000) div count(1)").alias("popularity"), F.count(F.lit(1)).alias("n"))


DAILY = OBSERVED + ", daily AS (SELECT event_time::DATE AS dt, event_type, ((sum(popularity) * 1000) // count(*))::BIGINT AS popularity, count(*) AS n FROM observed GROUP BY 1, 2)"


def edges(t: Tables) -> DataFrame:
    """Credits, genres, brands and colours as edges of a graph."""
    c = credits(t)
    acted = c.where("credit_type = 'cast'").select(F.col("person_id").alias("from_id"), F.col("movie_id").alias("to_id"), F.lit("ACTED_IN").alias("type"))
    directed = c.where("is_director = 1").select(F.col("person_id").alias("from_id"), F.col("movie_id").alias("to_id"), F.lit("DIRECTED").alias("type"))
    code = lambda column: F.conv(F.substring(F.md5(column), 1, 12), 16, 10).cast("bigint")
    p = t.part
    genre = p.select(F.col("p_partkey").alias("from_id"), code(F.col("p_type")).alias("to_id"), F.lit("HAS_GENRE").alias("type"))
    made = p.select(F.col("p_partkey").alias("from_id"), code(F.col("p_brand")).alias("to_id"), F.lit("PRODUCED_BY").alias("type"))
    words = p.select(F.col("p_partkey").alias("from_id"), F.explode(F.split("p_name", " ")).alias("w")).select("from_id", code(F.col("w")).alias("to_id"),
        F.lit("HAS_KEYWORD").alias("type"))
    return acted.unionByName(directed).unionByName(genre).unionByName(made).unionByName(words).distinct()


EDGES = CREDITS + """, edges AS (
  SELECT person_id AS from_id, movie_id AS to_id, 'ACTED_IN' AS type FROM credits WHERE credit_type = 'cast'
  UNION SELECT person_id, movie_id, 'DIRECTED' FROM credits WHERE is_director = 1
  UNION SELECT p_partkey, ('0x' || left(md5(p_type), 12))::BIGINT, 'HAS_GENRE' FROM part
  UNION SELECT p_partkey, ('0x' || left(md5(p_brand), 12))::BIGINT, 'PRODUCED_BY' FROM part
  UNION SELECT p_partkey, ('0x' || left(md5(w), 12))::BIGINT, 'HAS_KEYWORD' FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
)"""


def versions(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two batches of customers' states: their last order before 1998 and their last one at all."""
    rows = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("valid_from"), F.lit("2099-12-31 00:00:00").cast("timestamp").alias("valid_to"))
    return rows.where("valid_from < timestamp'1998-01-01 00:00:00'"), rows.where("valid_from >= timestamp'1998-01-01 00:00:00'")
