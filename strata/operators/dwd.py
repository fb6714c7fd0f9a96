"""The modelled layer: raw payloads to dimensions, bridges and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.dedup import latest
from strata.sources import schemas

MOVIE_BUSINESS = ["title", "original_title", "original_language", "status", "release_date", "release_year", "runtime", "budget", "revenue", "collection_id",
    "adult"]
PERSON_BUSINESS = ["person_name", "gender", "birthday", "deathday", "place_of_birth", "known_for_department", "adult", "biography"]


def parsed(raw: DataFrame, schema: str) -> DataFrame:
    """raw with the payload as struct p; records that don't parse, or have no id, are left out."""
    return raw.withColumn("p", F.from_json("payload", schema)).where("p.id is not null")


def day(dt: str) -> Column:
    return F.lit(dt).cast("date")


def loaded(df: DataFrame, dt: str, with_dt: bool = False) -> DataFrame:
    """With load_time, the midnight of the business date, so reruns are the same."""
    if with_dt:
        df = df.withColumn("dt", day(dt))
    return df.withColumn("load_time", day(dt).cast("timestamp"))


def first_known(df: DataFrame, keys: list[str], dt: str, with_dt: bool = False) -> DataFrame:
    """One row a key: of the latest ingest, by all its columns in a tie."""
    one = latest(df, keys, F.col("ingest_time"), *[F.col(c) for c in df.columns if c not in (*keys, "ingest_time")])
    return loaded(one.drop("ingest_time"), dt, with_dt)


def version_bounds(df: DataFrame, dt: str, key: str) -> DataFrame:
    df = df.withColumn("valid_from", day(dt).cast("timestamp")).withColumn("valid_to", F.lit(C.FAR_FUTURE).cast("timestamp"))
    return df.withColumn("surrogate_key", C.surrogate_key(key, "valid_from"))


def dim_movie(movies: DataFrame, dt: str) -> DataFrame:
    p = lambda name: F.col(f"p.{name}")
    released = C.parse_date(p("release_date"))
    rows = movies.select(p("id").alias("movie_id"), p("title").alias("title"), p("original_title").alias("original_title"),
        p("original_language").alias("original_language"), p("status").alias("status"), released.alias("release_date"), F.year(released).alias("release_year"),
        p("runtime").alias("runtime"), C.zero_as_null(p("budget")).alias("budget"), C.zero_as_null(p("revenue")).alias("revenue"),
        p("popularity").alias("popularity"), p("vote_average").alias("vote_average"), p("vote_count").alias("vote_count"), C.flag(p("adult")).alias("adult"),
        p("belongs_to_collection.id").alias("collection_id"), "ingest_time")
    return version_bounds(first_known(rows, ["movie_id"], dt), dt, "movie_id")


def dim_person(persons: DataFrame, dt: str) -> DataFrame:
    p = lambda name: F.col(f"p.{name}")
    rows = persons.select(p("id").alias("person_id"), p("name").alias("person_name"), C.gender_name(p("gender")).alias("gender"),
        C.parse_date(p("birthday")).alias("birthday"), C.parse_date(p("deathday")).alias("deathday"), p("place_of_birth").alias("place_of_birth"),
        p("known_for_department").alias("known_for_department"), p("popularity").alias("popularity"), C.flag(p("adult")).alias("adult"),
        p("biography").alias("biography"), "ingest_time")
    return version_bounds(first_known(rows, ["person_id"], dt), dt, "person_id")


def _named(rows: DataFrame, array: str, prefix: str, kind: str | None = None) -> DataFrame:
    rows = rows.select(F.explode(array).alias("x"), "ingest_time").where("x.id is not null")
    extra = [F.lit(kind).alias("media_type")] if kind else []
    return rows.select(F.col("x.id").alias(f"{prefix}_id"), F.col("x.name").alias(f"{prefix}_name"), *extra, "ingest_time")


def dim_company(movies: DataFrame, dt: str) -> DataFrame:
    rows = _named(movies, "p.production_companies", "company").withColumn("normalized_name", C.company_name(F.col("company_name")))
    return first_known(rows, ["company_id"], dt)


def dim_genre(movies: DataFrame, tv: DataFrame, dt: str) -> DataFrame:
    """Genre ids are scoped by media type."""
    rows = _named(movies, "p.genres", "genre", "movie").unionByName(_named(tv, "p.genres", "genre", "tv"))
    return first_known(rows, ["media_type", "genre_id"], dt)


def keywords(movies: DataFrame, tv: DataFrame | None = None) -> DataFrame:
    """movie and tv keywords, which differ in shape; the id is a hash of the name where there is none."""
    both = movies.select(F.col("p.id").alias("id"), F.lit("movie").alias("media_type"), F.explode("p.keywords.keywords").alias("k"), "ingest_time")
    if tv is not None:
        both = both.unionByName(tv.select(F.col("p.id").alias("id"), F.lit("tv").alias("media_type"), F.explode("p.keywords.results").alias("k"),
            "ingest_time"))
    return both.select("id", "media_type", F.coalesce("k.id", F.xxhash64("k.name")).alias("keyword_id"), F.col("k.name").alias("keyword_name"),
        "ingest_time").where("keyword_name is not null")


def dim_keyword(movies: DataFrame, dt: str, tv: DataFrame | None = None) -> DataFrame:
    return first_known(keywords(movies, tv).drop("id", "media_type"), ["keyword_id"], dt)


def dim_country(movies: DataFrame, dt: str) -> DataFrame:
    rows = movies.select(F.explode("p.production_countries").alias("x"), "ingest_time").select(F.col("x.iso_3166_1").alias("country_code"),
        F.col("x.name").alias("country_name"), "ingest_time")
    return first_known(rows.where("country_code is not null"), ["country_code"], dt)


def dim_language(movies: DataFrame, dt: str) -> DataFrame:
    rows = movies.select(F.explode("p.spoken_languages").alias("x"), "ingest_time").select(F.col("x.iso_639_1").alias("language_code"),
        F.col("x.name").alias("language_name"), "ingest_time")
    return first_known(rows.where("language_code is not null"), ["language_code"], dt)


def dim_collection(movies: DataFrame, dt: str) -> DataFrame:
    rows = movies.select(F.col("p.belongs_to_collection.id").alias("collection_id"), F.col("p.belongs_to_collection.name").alias("collection_name"),
        "ingest_time")
    return first_known(rows.where("collection_id is not null"), ["collection_id"], dt)


def bridge(rows: DataFrame, array: str, owner: str, members: dict[str, str], dt: str) -> DataFrame:
    """owner and the named fields of each element; one row per owner and first member."""
    rows = rows.select(F.col("p.id").alias(owner), F.explode(array).alias("x"), "ingest_time")
    rows = rows.select(owner, *[F.col(f"x.{field}").alias(name) for name, field in members.items()], "ingest_time")
    member = next(iter(members))
    return first_known(rows.where(F.col(owner).isNotNull() & F.col(member).isNotNull()), [owner, member], dt)


def bridges(movies: DataFrame, tv: DataFrame, dt: str) -> dict[str, DataFrame]:
    named = keywords(movies).where("media_type = 'movie'").select(F.col("id").alias("movie_id"), "keyword_id", "keyword_name", "ingest_time")
    return {
        "bridge_movie_genre": bridge(movies, "p.genres", "movie_id", {"genre_id": "id", "genre_name": "name"}, dt),
        "bridge_movie_company": bridge(movies, "p.production_companies", "movie_id", {"company_id": "id", "company_name": "name"}, dt),
        "bridge_movie_country": bridge(movies, "p.production_countries", "movie_id", {"country_code": "iso_3166_1", "country_name": "name"}, dt),
        "bridge_movie_keyword": first_known(named, ["movie_id", "keyword_id"], dt),
        "bridge_tv_genre": bridge(tv, "p.genres", "tv_id", {"genre_id": "id", "genre_name": "name"}, dt),
        "bridge_tv_network": bridge(tv, "p.networks", "tv_id", {"network_id": "id", "network_name": "name"}, dt),
    }


def fact_credit(movies: DataFrame, dt: str) -> DataFrame:
    """One row per credit, cast and crew."""
    none = lambda kind: F.lit(None).cast(kind)
    cast = movies.select(F.col("p.id").alias("movie_id"), F.explode_outer("p.credits.cast").alias("x"), "ingest_time")
    cast = cast.select("movie_id", F.col("x.credit_id").alias("credit_id"), F.col("x.id").alias("person_id"), F.lit("cast").alias("credit_type"),
        none("string").alias("department"), none("string").alias("job"), F.col("x.character").alias("character_name"), F.col("x.order").alias("cast_order"),
        F.lit(0).alias("is_director"), "ingest_time")
    crew = movies.select(F.col("p.id").alias("movie_id"), F.explode_outer("p.credits.crew").alias("x"), "ingest_time")
    crew = crew.select("movie_id", F.col("x.credit_id").alias("credit_id"), F.col("x.id").alias("person_id"), F.lit("crew").alias("credit_type"),
        F.col("x.department").alias("department"), F.col("x.job").alias("job"), none("string").alias("character_name"), none("int").alias("cast_order"),
        C.is_director(F.col("x.job")).alias("is_director"), "ingest_time")
    return first_known(cast.unionByName(crew).where("credit_id is not null"), ["credit_id"], dt, with_dt=True)


def fact_snapshot(movies: DataFrame, dt: str) -> DataFrame:
    rows = movies.select(F.col("p.id").alias("movie_id"), F.col("p.title").alias("title"), F.col("p.popularity").alias("popularity"),
        F.col("p.vote_average").alias("vote_average"), F.col("p.vote_count").alias("vote_count"), C.zero_as_null(F.col("p.revenue")).alias("revenue"),
        C.parse_date(F.col("p.release_date")).alias("release_date"), "ingest_time")
    return first_known(rows, ["movie_id"], dt, with_dt=True)


def fact_release(movies: DataFrame, dt: str) -> DataFrame:
    """One row per movie, country, kind and date; a country without dates stays with null ones."""
    rows = movies.select(F.col("p.id").alias("movie_id"), F.explode_outer("p.release_dates.results").alias("c"), "ingest_time")
    rows = rows.select("movie_id", F.col("c.iso_3166_1").alias("country_code"), F.explode_outer("c.release_dates").alias("r"),
        "ingest_time").where("country_code is not null")
    rows = rows.select("movie_id", "country_code", C.release_type_name(F.col("r.type")).alias("release_type"),
        F.to_date(C.parse_instant(F.col("r.release_date"))).alias("release_date"), F.col("r.certification").alias("certification"), "ingest_time")
    return first_known(rows, ["movie_id", "country_code", "release_type", "release_date"], dt, with_dt=True)


def fact_change(raw: DataFrame, dt: str) -> DataFrame:
    rows = raw.select(C.event_id(F.col("entity_type"), F.col("entity_id"), F.col("ingest_time")).alias("event_id"), "entity_type", "entity_id",
        F.timestamp_millis("ingest_time").alias("event_time"), "source", "ingest_time")
    return first_known(rows, ["event_id"], dt, with_dt=True)


def dim_date(spark, start: str, days: int) -> DataFrame:
    """A calendar; day 1 of a week is Monday."""
    d = F.date_add(F.lit(start).cast("date"), F.col("id").cast("int"))
    rows = spark.range(days).select(d.alias("dt"))
    return rows.select("dt", F.year("dt").alias("year"), F.quarter("dt").alias("quarter"), F.month("dt").alias("month"), F.dayofmonth("dt").alias("day"),
        F.weekofyear("dt").alias("week"), C.iso_day_of_week(F.col("dt")).alias("day_of_week"), C.flag(C.iso_day_of_week(F.col("dt")) >= 6).alias("is_weekend"))
