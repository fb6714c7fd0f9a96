"""Raw records built from the driver's tables, and what the modelled, summary and report layers make of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators import ads, dwd, dws, graph
from strata.queries import views as V
from strata.queries.batch import no_zone
from strata.queries.registry import query
from strata.sources import schemas

DT = "2024-05-01"
#: Milliseconds of the first record's arrival; record n arrives n minutes later.
FIRST = 1_714_521_600_000


def _date(days: Column) -> Column:
    return F.date_add(F.lit("1990-01-01").cast("date"), days.cast("int")).cast("string")


def envelope(rows: DataFrame, kind: str, key: str, payload: Column) -> DataFrame:
    return rows.select(F.lit(1).alias("schema_version"), F.lit(kind).alias("entity_type"), F.col(key).cast("bigint").alias("entity_id"), F.lit(DT).alias("dt"),
        (F.lit(FIRST) + F.col(key) * 60_000).alias("ingest_time"), F.lit("files").alias("source"), payload.alias("payload"))


def raw_movies(t) -> DataFrame:
    """part as movie records; every eleventh is no JSON, every seventeenth has no id."""
    k, size = F.col("p_partkey"), F.col("p_size")
    person = lambda i: ((k * 3 + i) % 97 + 1).alias("id")
    cast = F.transform(F.sequence(F.lit(0), size % 3),
        lambda i: F.struct(person(i), F.concat(F.lit("c"), k, F.lit("-"), i).alias("credit_id"), F.concat(F.lit("n"), i).alias("name"),
        F.concat(F.lit("role"), i).alias("character"), i.cast("int").alias("order")))
    crew = F.array(*[F.struct(person(F.lit(7 * n)), F.concat(F.lit(f"w{n}-"), k).alias("credit_id"), F.lit("n").alias("name"), F.lit(dep).alias("department"),
        F.lit(job).alias("job")) for n, (dep, job) in enumerate([("Directing", "DIRECTOR"), ("Writing", "Author")])])
    words = F.transform(F.array_distinct(F.split("p_name", " ")),
        lambda w: F.struct(F.when(F.length(w) % 2 == 0, F.length(w)).cast("bigint").alias("id"), w.alias("name")))
    record = F.struct(
        F.when(k % 17 != 0, k).alias("id"), F.col("p_name").alias("title"), F.upper("p_name").alias("original_title"), F.lit("en").alias("original_language"),
        F.lit("Released").alias("status"),
        F.when(k % 7 == 0, F.lit("")).otherwise(_date(size * 200)).alias("release_date"), size.alias("runtime"),
        F.when(k % 5 == 0, 0).otherwise(V.cents("p_retailprice")).alias("budget"), (size * 10_000).cast("bigint").alias("revenue"),
        size.cast("double").alias("popularity"), (size % 9).cast("double").alias("vote_average"), (size * 2).cast("int").alias("vote_count"),
        (k % 13 == 0).alias("adult"),
        F.when(k % 3 == 0, F.struct(size.cast("bigint").alias("id"), F.concat(F.lit("set "), size).alias("name"))).alias("belongs_to_collection"),
        F.array(*[F.struct((size % m + b).cast("bigint").alias("id"), F.concat(F.lit("genre "), size % m + b).alias("name")) for m, b in ((6, 0),
        (3, 10))]).alias("genres"),
        F.array(F.struct(F.substring("p_brand", 7, 2).cast("bigint").alias("id"),
        F.concat("p_brand", F.lit(" (US)")).alias("name"))).alias("production_companies"),
        F.array(*[F.struct(F.concat(F.lit("C"), size % m).alias("iso_3166_1"), F.concat(F.lit("land "), size % m).alias("name")) for m in (4,
        40)]).alias("production_countries"),
        F.array(F.struct(F.concat(F.lit("l"), size % 5).alias("iso_639_1"), F.concat(F.lit("tongue "), size % 5).alias("name"))).alias("spoken_languages"),
        F.struct(words.alias("keywords")).alias("keywords"), F.struct(cast.alias("cast"), crew.alias("crew")).alias("credits"),
        F.struct(F.array(
            F.struct(F.lit("US").alias("iso_3166_1"),
            F.array(F.struct(F.lit("PG").alias("certification"), F.concat(_date(size * 100), F.lit("T00:00:00.000Z")).alias("release_date"),
            (size % 8).cast("int").alias("type"))).alias("release_dates")),
            F.struct(F.lit("FR").alias("iso_3166_1"),
            F.slice(F.array(F.struct(F.lit("").alias("certification"), F.lit("soon").alias("release_date"), F.lit(3).alias("type"))), F.lit(1),
            (size % 2).cast("int")).alias("release_dates"))).alias("results")).alias("release_dates"),
    )
    return envelope(t.part, "movie", "p_partkey", F.when(k % 11 == 0, F.lit("{broken")).otherwise(F.to_json(record)))


#: The movies that can be parsed, in SQL.
MOVIES = f"""m AS (
  SELECT p_partkey AS movie_id, p_name, p_brand, p_size AS size, {FIRST} + p_partkey * 60000 AS ingest_ms, round(p_retailprice * 100)::BIGINT AS price,
         CASE WHEN p_partkey % 7 <> 0 THEN DATE '1990-01-01' + (p_size * 200)::INT END AS released
  FROM part WHERE p_partkey % 11 <> 0 AND p_partkey % 17 <> 0)"""
NIGHT = f"TIMESTAMP '{DT} 00:00:00'"
FAR = "TIMESTAMP '2099-12-31 00:00:00'"


def movies(t) -> DataFrame:
    return dwd.parsed(raw_movies(t), schemas.MOVIE)


def raw_tv(t) -> DataFrame:
    """supplier as tv records."""
    k = F.col("s_suppkey")
    record = F.struct(k.alias("id"), F.col("s_name").alias("name"),
        F.array(F.struct((k % 4).alias("id"), F.concat(F.lit("genre "), k % 4).alias("name"))).alias("genres"),
        F.array(F.struct((k % 3).alias("id"), F.concat(F.lit("net "), k % 3).alias("name"))).alias("networks"),
        F.struct(F.array(F.struct((k % 9 + 100).alias("id"), F.concat(F.lit("topic "), k % 9).alias("name"))).alias("results")).alias("keywords"))
    return envelope(t.supplier, "tv", "s_suppkey", F.to_json(record))


def tv(t) -> DataFrame:
    return dwd.parsed(raw_tv(t), schemas.TV)


def raw_persons(t) -> DataFrame:
    """customer as person records."""
    k = F.col("c_custkey")
    record = F.struct(k.alias("id"), F.col("c_name").alias("name"), (k % 5).cast("int").alias("gender"),
        F.when(k % 3 == 0, F.lit("unknown")).otherwise(_date(k % 9000)).alias("birthday"), F.lit("").alias("deathday"),
        F.col("c_mktsegment").alias("place_of_birth"), F.when(k % 2 == 0, F.lit("Acting")).alias("known_for_department"),
        (k % 50).cast("double").alias("popularity"), (k % 4 == 0).alias("adult"), F.lit("b").alias("biography"))
    return envelope(t.customer, "person", "c_custkey", F.to_json(record))


def model(t) -> dict[str, DataFrame]:
    return modelled(movies(t), tv(t), dwd.parsed(raw_persons(t), schemas.PERSON))


def modelled(m: DataFrame, v: DataFrame, persons: DataFrame) -> dict[str, DataFrame]:
    """The tables of parsed movies, tv and persons."""
    out = {"dim_movie": dwd.dim_movie(m, DT), "dim_person": dwd.dim_person(persons, DT),
        "dim_company": dwd.dim_company(m, DT), "dim_genre": dwd.dim_genre(m, v, DT), "dim_keyword": dwd.dim_keyword(m, DT, v),
        "fact_movie_credit": dwd.fact_credit(m, DT)}
    return out | dwd.bridges(m, v, DT)


@query(f"""WITH {MOVIES} SELECT movie_id, p_name AS title, upper(p_name) AS original_title, 'en' AS original_language, 'Released' AS status, released AS release_date, year(released)::INT AS release_year, size AS runtime,
  CASE WHEN movie_id % 5 <> 0 THEN price END AS budget, size::BIGINT * 10000 AS revenue, size::DOUBLE AS popularity, (size % 9)::DOUBLE AS vote_average, size * 2 AS vote_count, CASE WHEN movie_id % 13 = 0 THEN 1 ELSE 0 END AS adult,
  CASE WHEN movie_id % 3 = 0 THEN size::BIGINT END AS collection_id, {NIGHT} AS load_time, {NIGHT} AS valid_from, {FAR} AS valid_to FROM m""")
def model_dim_movie(spark, t) -> DataFrame:
    """Nested fields, literals, zeros as unknown; records that are no JSON or have no id are left out."""
    return no_zone(dwd.dim_movie(movies(t), DT).drop("surrogate_key"))


@query(f"WITH {MOVIES} SELECT count(*) AS versions, count(*) AS keys, count(*) FILTER (movie_id IS NULL) AS unknown FROM m")
def model_surrogate_keys(spark, t) -> DataFrame:
    """Keys of versions are distinct."""
    return dwd.dim_movie(movies(t), DT).agg(F.count(F.lit(1)).alias("versions"), F.count_distinct("surrogate_key").alias("keys"),
        F.count_if(F.col("surrogate_key").isNull()).alias("unknown"))


@query(f"""SELECT c_custkey AS person_id, c_name AS person_name, CASE c_custkey % 5 WHEN 1 THEN 'female' WHEN 2 THEN 'male' WHEN 3 THEN 'non-binary' ELSE 'unknown' END AS gender,
  CASE WHEN c_custkey % 3 <> 0 THEN DATE '1990-01-01' + (c_custkey % 9000)::INT END AS birthday, NULL::DATE AS deathday, c_mktsegment AS place_of_birth, CASE WHEN c_custkey % 2 = 0 THEN 'Acting' END AS known_for_department,
  (c_custkey % 50)::DOUBLE AS popularity, CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS adult, {NIGHT} AS load_time FROM customer""")
def model_dim_person(spark, t) -> DataFrame:
    rows = dwd.dim_person(dwd.parsed(raw_persons(t), schemas.PERSON), DT)
    return no_zone(rows.drop("surrogate_key", "valid_from", "valid_to", "biography"))


@query(f"""WITH {MOVIES}, k AS (SELECT w AS name, CASE WHEN length(w) % 2 = 0 THEN length(w) END AS id FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM m))
SELECT DISTINCT id::BIGINT AS known_id, CASE WHEN id IS NULL THEN name END AS name FROM k UNION SELECT s_suppkey % 9 + 100, NULL FROM supplier""")
def model_dim_keyword(spark, t) -> DataFrame:
    """Keywords without an id get a hash of their name, so they stay apart; ids that several names share are one."""
    rows = dwd.dim_keyword(movies(t), DT, tv(t))
    known = F.col("keyword_id").between(0, 1000)
    return rows.select(F.when(known, F.col("keyword_id")).alias("known_id"), F.when(~known, F.col("keyword_name")).alias("name")).distinct()


@query(f"""WITH {MOVIES} SELECT 'genre' AS kind, 'movie:' || g AS key, 'genre ' || g AS name FROM (SELECT size % 6 AS g FROM m UNION SELECT size % 3 + 10 FROM m)
UNION ALL SELECT DISTINCT 'genre', 'tv:' || s_suppkey % 4, 'genre ' || s_suppkey % 4 FROM supplier
UNION ALL SELECT DISTINCT 'company', substr(p_brand, 7, 2), p_brand FROM m UNION ALL SELECT 'country', 'C' || c, 'land ' || c FROM (SELECT size % 4 AS c FROM m UNION SELECT size % 40 FROM m)
UNION ALL SELECT DISTINCT 'language', 'l' || size % 5, 'tongue ' || size % 5 FROM m UNION ALL SELECT DISTINCT 'collection', size::VARCHAR, 'set ' || size FROM m WHERE movie_id % 3 = 0""")
def model_dimensions(spark, t) -> DataFrame:
    """The small dimensions; the suffix of companies is gone."""
    m = movies(t)
    rows = lambda kind, df, key, name: df.select(F.lit(kind).alias("kind"), key.cast("string").alias("key"), F.col(name).alias("name"))
    parts = [rows("genre", dwd.dim_genre(m, tv(t), DT), F.concat_ws(":", "media_type", "genre_id"), "genre_name"),
        rows("company", dwd.dim_company(m, DT), F.col("company_id"), "normalized_name"),
        rows("country", dwd.dim_country(m, DT), F.col("country_code"), "country_name"),
        rows("language", dwd.dim_language(m, DT), F.col("language_code"), "language_name"),
        rows("collection", dwd.dim_collection(m, DT), F.col("collection_id"), "collection_name")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(f"""WITH {MOVIES} SELECT 'genre' AS kind, movie_id AS owner, (size % 6)::VARCHAR AS member, 'genre ' || size % 6 AS name FROM m UNION ALL SELECT 'genre', movie_id, (size % 3 + 10)::VARCHAR, 'genre ' || (size % 3 + 10) FROM m
UNION ALL SELECT 'company', movie_id, substr(p_brand, 7, 2), p_brand || ' (US)' FROM m UNION ALL SELECT DISTINCT 'country', movie_id, 'C' || c, 'land ' || c FROM (SELECT movie_id, size % 4 AS c FROM m UNION SELECT movie_id, size % 40 FROM m)
UNION ALL SELECT 'tv_genre', s_suppkey, (s_suppkey % 4)::VARCHAR, 'genre ' || s_suppkey % 4 FROM supplier UNION ALL SELECT 'tv_network', s_suppkey, (s_suppkey % 3)::VARCHAR, 'net ' || s_suppkey % 3 FROM supplier""")
def model_bridges(spark, t) -> DataFrame:
    """One row per owner and member; rows without either are left out."""
    b = dwd.bridges(movies(t), tv(t), DT)
    out = None
    for kind, name, owner, member, said in (("genre", "bridge_movie_genre", "movie_id", "genre_id", "genre_name"),
        ("company", "bridge_movie_company", "movie_id", "company_id", "company_name"),
        ("country", "bridge_movie_country", "movie_id", "country_code", "country_name"), ("tv_genre", "bridge_tv_genre", "tv_id", "genre_id", "genre_name"),
        ("tv_network", "bridge_tv_network", "tv_id", "network_id", "network_name")):
        rows = b[name].select(F.lit(kind).alias("kind"), F.col(owner).alias("owner"), F.col(member).cast("string").alias("member"), F.col(said).alias("name"))
        out = rows if out is None else out.unionByName(rows)
    return out


CREDITS = """credits AS (
  SELECT 'c' || movie_id || '-' || i AS credit_id, movie_id, ((movie_id * 3 + i) % 97 + 1)::BIGINT AS person_id, 'cast' AS credit_type, NULL AS department, NULL AS job, 'role' || i AS character_name, i::INT AS cast_order, 0 AS is_director
  FROM (SELECT *, unnest(range(size % 3 + 1)) AS i FROM m)
  UNION ALL SELECT 'w0-' || movie_id, movie_id, ((movie_id * 3) % 97 + 1)::BIGINT, 'crew', 'Directing', 'DIRECTOR', NULL, NULL, 1 FROM m
  UNION ALL SELECT 'w1-' || movie_id, movie_id, ((movie_id * 3 + 7) % 97 + 1)::BIGINT, 'crew', 'Writing', 'Author', NULL, NULL, 0 FROM m)"""


@query(f"WITH {MOVIES}, {CREDITS} SELECT *, DATE '{DT}' AS dt FROM credits")
def model_fact_credit(spark, t) -> DataFrame:
    """Cast and crew by explode_outer, without the rows of empty lists; a director in any case of letters."""
    return dwd.fact_credit(movies(t), DT).drop("load_time")


@query(f"WITH {MOVIES} SELECT movie_id, p_name AS title, size::DOUBLE AS popularity, (size % 9)::DOUBLE AS vote_average, size * 2 AS vote_count, size::BIGINT * 10000 AS revenue, released AS release_date, DATE '{DT}' AS dt FROM m")
def model_fact_snapshot(spark, t) -> DataFrame:
    return dwd.fact_snapshot(movies(t), DT).drop("load_time")


TYPES = "CASE {0} WHEN 1 THEN '首映' WHEN 2 THEN '限定上映' WHEN 3 THEN '院线' WHEN 4 THEN '数字' WHEN 5 THEN '实体' WHEN 6 THEN '电视' ELSE '其他' END"


@query(f"""WITH {MOVIES} SELECT movie_id, 'US' AS country_code, {TYPES.format("size % 8")} AS release_type, DATE '1990-01-01' + (size * 100)::INT AS release_date, 'PG' AS certification FROM m
UNION ALL SELECT movie_id, 'FR', CASE WHEN size % 2 = 1 THEN '院线' ELSE '其他' END, NULL, CASE WHEN size % 2 = 1 THEN '' END FROM m""")
def model_fact_release(spark, t) -> DataFrame:
    """Two levels of lists; a country without dates stays, and a date that is none is unknown."""
    return dwd.fact_release(movies(t), DT).drop("load_time", "dt")


@query(f"SELECT sha256('movie:' || p_partkey || ':' || ({FIRST} + p_partkey * 60000)) AS event_id, 'movie' AS entity_type, p_partkey AS entity_id, make_timestamp(({FIRST} + p_partkey * 60000) * 1000) AS event_time, 'files' AS source FROM part")
def model_fact_change(spark, t) -> DataFrame:
    return no_zone(dwd.fact_change(raw_movies(t), DT).drop("load_time", "dt"))


def snapshots(t) -> DataFrame:
    """Ten days of snapshots: popularity goes up by its remainder each day."""
    days = F.explode(F.sequence(F.lit(0), F.lit(9))).alias("d")
    rows = movies(t).select(F.col("p.id").alias("movie_id"), F.col("p.title").alias("title"), F.col("p.popularity").alias("popularity"),
        F.col("p.vote_average").alias("vote_average"), F.col("p.vote_count").alias("vote_count"), C.zero_as_null(F.col("p.revenue")).alias("revenue"),
        C.parse_date(F.col("p.release_date")).alias("release_date"), days)
    return rows.withColumn("dt", F.date_add(F.lit(DT).cast("date"), F.col("d") - 9)).withColumn("popularity",
        F.col("popularity") + F.col("d") * (F.col("movie_id") % 4)).drop("d")


METRIC = f"""{MOVIES}, {CREDITS}, s AS (SELECT *, DATE '{DT}' + d::INT - 9 AS dt, size::DOUBLE + d * (movie_id % 4) AS popularity, size::DOUBLE + (d - 7) * (movie_id % 4) AS before FROM m, range(10) r(d)),
  n AS (SELECT movie_id, count(*) FILTER (credit_type = 'cast') AS cast_count, count(*) FILTER (credit_type = 'crew') AS crew_count FROM credits GROUP BY 1),
  metric AS (SELECT dt, movie_id, p_name AS title, year(released)::INT AS release_year, popularity, CASE WHEN d >= 7 THEN round((popularity - before) / before, 6) ELSE 0 END AS popularity_wow, (size % 9)::DOUBLE AS vote_average, size * 2 AS vote_count, size::BIGINT * 10000 AS revenue,
    CASE WHEN movie_id % 5 <> 0 THEN price END AS budget, round(size * 10000 / CASE WHEN movie_id % 5 <> 0 THEN price END, 6) AS roi, CASE WHEN d = 9 THEN cast_count ELSE 0 END AS cast_count, CASE WHEN d = 9 THEN crew_count ELSE 0 END AS crew_count FROM s JOIN n USING (movie_id))"""


def metric(t) -> DataFrame:
    m = model(t)
    return dws.movie_metric(snapshots(t), m["fact_movie_credit"],
        dws.current_movies(m["dim_movie"])).withColumns({c: F.round(c, 6) for c in ("popularity_wow", "roi")})


@query(f"WITH {METRIC} SELECT * FROM metric")
def model_movie_metric(spark, t) -> DataFrame:
    """Snapshots with the week's change, the day's credits and the current budget."""
    return metric(t)


@query(f"""WITH {METRIC}, g AS (SELECT movie_id, (size % 6)::BIGINT AS genre_id FROM m UNION ALL SELECT movie_id, (size % 3 + 10)::BIGINT FROM m),
  daily AS (SELECT dt, genre_id, 'genre ' || genre_id AS genre_name, count(DISTINCT movie_id) AS movie_count, sum(popularity) / count(*) AS avg_popularity FROM g JOIN metric USING (movie_id) GROUP BY 1, 2)
SELECT dt, genre_id, genre_name, movie_count, round(avg_popularity, 6) AS avg_popularity, round(coalesce((avg_popularity - before) / before, 0), 6) AS popularity_change FROM (SELECT *, lag(avg_popularity, 7) OVER (PARTITION BY genre_id ORDER BY dt) AS before FROM daily)""")
def model_genre_trend(spark, t) -> DataFrame:
    rows = ads.genre_trend(model(t)["bridge_movie_genre"], metric(t))
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_popularity", "popularity_change")})


SUMMARY = f"""WITH {MOVIES}, {CREDITS}, now AS (SELECT movie_id, year(released)::INT AS release_year, size::DOUBLE AS popularity, (size % 9)::DOUBLE AS vote_average, size::BIGINT * 10000 AS revenue, CASE WHEN movie_id % 5 <> 0 THEN price END AS budget, size, p_brand FROM m)"""


@query(SUMMARY + " SELECT g::BIGINT AS genre_id, release_year, count(DISTINCT movie_id) AS movie_count, round(avg(popularity), 6) AS avg_popularity, round(avg(vote_average), 6) AS avg_vote_average, sum(revenue)::BIGINT AS total_revenue FROM (SELECT *, size % 6 AS g FROM now UNION ALL SELECT *, size % 3 + 10 FROM now) WHERE release_year IS NOT NULL GROUP BY 1, 2")
def model_genre_year(spark, t) -> DataFrame:
    m = model(t)
    rows = dws.genre_year(m["bridge_movie_genre"], dws.current_movies(m["dim_movie"])).drop("genre_name")
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_popularity", "avg_vote_average")})


@query(SUMMARY + " SELECT c AS country_code, release_year, count(DISTINCT movie_id) AS movie_count, sum(revenue)::BIGINT AS total_revenue, round(avg(vote_average), 6) AS avg_vote_average FROM (SELECT *, 'C' || size % 4 AS c FROM now UNION SELECT *, 'C' || size % 40 FROM now) WHERE release_year IS NOT NULL GROUP BY 1, 2")
def model_country_year(spark, t) -> DataFrame:
    m = model(t)
    rows = dws.country_year(m["bridge_movie_country"], dws.current_movies(m["dim_movie"])).drop("country_name")
    return rows.withColumn("avg_vote_average", F.round("avg_vote_average", 6))


@query(SUMMARY + " SELECT substr(p_brand, 7, 2)::BIGINT AS company_id, count(DISTINCT movie_id) AS movie_count, sum(budget)::BIGINT AS total_budget, sum(revenue)::BIGINT AS total_revenue, round(avg(revenue / budget), 6) AS avg_roi FROM now GROUP BY 1")
def model_company_finance(spark, t) -> DataFrame:
    """The mean of ratios: a movie without a budget does not count in it."""
    m = model(t)
    return dws.company_finance(m["bridge_movie_company"], dws.current_movies(m["dim_movie"])).drop("company_name").withColumn("avg_roi", F.round("avg_roi", 6))


@query(SUMMARY + """ SELECT c.person_id, count(DISTINCT movie_id) AS work_count, sum(is_director)::BIGINT AS as_director_count, count(*) FILTER (credit_type = 'cast') AS as_cast_count, min(release_year) AS first_work_year, max(release_year) AS latest_work_year,
  round(avg(vote_average), 6) AS avg_vote_average, any_value(c_name) AS person_name, any_value(c_custkey % 50)::DOUBLE AS popularity FROM credits c JOIN now USING (movie_id) LEFT JOIN customer ON c_custkey = c.person_id GROUP BY 1""")
def model_person_career(spark, t) -> DataFrame:
    m = model(t)
    rows = dws.person_career(m["fact_movie_credit"], dws.current_movies(m["dim_movie"]), m["dim_person"])
    return rows.drop("known_for_department").withColumn("avg_vote_average", F.round("avg_vote_average", 6))


@query(f"WITH {METRIC} SELECT dt, rank, movie_id, roi FROM (SELECT *, dense_rank() OVER (PARTITION BY dt ORDER BY roi DESC)::INT AS rank FROM metric WHERE roi IS NOT NULL) WHERE rank <= 20 ORDER BY dt, rank, movie_id")
def model_roi_report(spark, t) -> DataFrame:
    """A report in reading order."""
    return ads.in_order(ads.roi_ranking(metric(t), 20), "movie_id").select("dt", "rank", "movie_id", "roi")


GRAPH_EDGES = SUMMARY + """, e AS (
  SELECT person_id AS from_id, movie_id AS to_id, 'ACTED_IN' AS type FROM credits JOIN customer ON c_custkey = person_id WHERE credit_type = 'cast'
  UNION SELECT person_id, movie_id, 'DIRECTED' FROM credits JOIN customer ON c_custkey = person_id WHERE is_director = 1
  UNION SELECT movie_id, size % 6, 'HAS_GENRE' FROM m UNION SELECT movie_id, size % 3 + 10, 'HAS_GENRE' FROM m UNION SELECT movie_id, substr(p_brand, 7, 2)::BIGINT, 'PRODUCED_BY' FROM m)"""


@query(GRAPH_EDGES + " SELECT * FROM e")
def graph_edges_of_tables(spark, t) -> DataFrame:
    """Edges of the modelled tables whose ends are both there (keywords hash their names, so they are left out here)."""
    return graph.from_tables(model(t))[1].where("type <> 'HAS_KEYWORD'").select("from_id", "to_id", "type")


@query(SUMMARY + """ SELECT 'movie' AS label, movie_id AS id, p_name AS name FROM m UNION ALL SELECT 'person', c_custkey, c_name FROM customer
  UNION ALL SELECT 'company', id, name FROM (SELECT DISTINCT substr(p_brand, 7, 2)::BIGINT AS id, p_brand || ' (US)' AS name FROM m) UNION ALL SELECT DISTINCT 'genre', g, 'genre ' || g FROM (SELECT size % 6 AS g FROM m UNION SELECT size % 3 + 10 FROM m UNION SELECT s_suppkey % 4 FROM supplier)""")
def graph_vertices_of_tables(spark, t) -> DataFrame:
    """Merged vertices by label and id."""
    return graph.from_tables(model(t))[0].where("label <> 'keyword'").select("label", "id", "name")


@query(GRAPH_EDGES + " SELECT d.c_name AS director, a.c_name AS actor, count(DISTINCT x.to_id) AS shared FROM e x JOIN e y ON x.to_id = y.to_id AND x.type = 'DIRECTED' AND y.type = 'ACTED_IN' JOIN customer d ON d.c_custkey = x.from_id JOIN customer a ON a.c_custkey = y.from_id GROUP BY 1, 2")
def graph_director_actor_names(spark, t) -> DataFrame:
    vertices, edges = graph.from_tables(model(t))
    return graph.director_actor_names(edges, vertices.where("label = 'person'"))


@query(GRAPH_EDGES + " SELECT to_id AS id, 'MERGED' AS name FROM e WHERE type = 'DIRECTED' AND to_id % 2 = 0 UNION ALL SELECT movie_id, p_name FROM m WHERE movie_id % 2 = 1")
def graph_merge(spark, t) -> DataFrame:
    """Vertices upserted by id: of even movies the new name, of the others the old one; merging twice changes nothing."""
    old = movies(t).select(F.col("p.id").alias("id"), F.col("p.title").alias("name")).where("id % 2 = 1 or id % 4 = 0")
    new = movies(t).select(F.col("p.id").alias("id"), F.lit("MERGED").alias("name")).where("id % 2 = 0")
    once = graph.merge(old, new.unionByName(new), ["id"])
    return graph.merge(once, new, ["id"])
