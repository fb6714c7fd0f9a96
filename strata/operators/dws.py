"""Subject-area summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import columns as C
from strata.operators.scd2 import current


def current_movies(dim: DataFrame) -> DataFrame:
    return current(dim).select("movie_id", "release_year", "popularity", "vote_average", "revenue", "budget")


def credit_counts(credits: DataFrame) -> DataFrame:
    when = lambda kind: F.sum(F.when(F.col("credit_type") == kind, 1).otherwise(0))
    return credits.groupBy("dt", "movie_id").agg(when("cast").alias("cast_count"), when("crew").alias("crew_count"))


def movie_metric(snapshots: DataFrame, credits: DataFrame, movies: DataFrame) -> DataFrame:
    """A row per day and movie. ``snapshots`` holds the days before as well, else there is no week to compare with."""
    week = F.lag("popularity", 7).over(Window.partitionBy("movie_id").orderBy("dt"))
    rows = snapshots.withColumn("before", week)
    rows = rows.join(credit_counts(credits), ["dt", "movie_id"], "left").join(movies.select("movie_id", "budget").distinct(), "movie_id", "left")
    known = lambda c: F.coalesce(F.col(c), F.lit(0))
    return rows.select("dt", "movie_id", "title", F.year("release_date").alias("release_year"), "popularity",
        C.change_ratio(F.col("popularity"), F.col("before")).alias("popularity_wow"), "vote_average", "vote_count", "revenue", "budget",
        C.safe_divide(F.col("revenue"), F.col("budget")).alias("roi"), known("cast_count").alias("cast_count"), known("crew_count").alias("crew_count"))


def genre_year(genres: DataFrame, movies: DataFrame) -> DataFrame:
    rows = genres.join(movies, "movie_id").groupBy("genre_id", "genre_name", "release_year")
    return rows.agg(F.count_distinct("movie_id").alias("movie_count"), F.avg("popularity").alias("avg_popularity"),
        F.avg("vote_average").alias("avg_vote_average"), F.sum("revenue").alias("total_revenue")).where("release_year is not null")


def person_career(credits: DataFrame, movies: DataFrame, persons: DataFrame) -> DataFrame:
    """Counts are per credit, and averages are weighted by credits. Credits of a person in a movie are added first, so
    the join and the distinct count see each pair once.
    """
    cast = F.sum(F.when(F.col("credit_type") == "cast", 1).otherwise(0))
    pairs = credits.groupBy("person_id", "movie_id").agg(F.count(F.lit(1)).alias("n"), F.sum("is_director").alias("directed"), cast.alias("acted"))
    known = F.when(F.col("vote_average").isNotNull(), F.col("n"))
    rows = pairs.join(movies, "movie_id").groupBy("person_id").agg(
        F.count_distinct("movie_id").alias("work_count"), F.sum("directed").alias("as_director_count"), F.sum("acted").alias("as_cast_count"),
        F.min("release_year").alias("first_work_year"),
        F.max("release_year").alias("latest_work_year"), F.try_divide(F.sum(F.col("vote_average") * F.col("n")), F.sum(known)).alias("avg_vote_average"))
    return rows.join(persons.select("person_id", "person_name", "known_for_department", F.col("popularity")), "person_id", "left")


def country_year(countries: DataFrame, movies: DataFrame) -> DataFrame:
    rows = countries.join(movies, "movie_id").groupBy("country_code", "country_name", "release_year")
    return rows.agg(F.count_distinct("movie_id").alias("movie_count"), F.sum("revenue").alias("total_revenue"),
        F.avg("vote_average").alias("avg_vote_average")).where("release_year is not null")


def company_finance(companies: DataFrame, movies: DataFrame) -> DataFrame:
    """avg_roi is the mean of ratios; unknown ones don't count."""
    rows = companies.join(movies, "movie_id").groupBy("company_id", "company_name")
    return rows.agg(F.count_distinct("movie_id").alias("movie_count"), F.sum("budget").alias("total_budget"), F.sum("revenue").alias("total_revenue"),
        F.avg(C.safe_divide(F.col("revenue"), F.col("budget"))).alias("avg_roi"))


def lag_calendar(series: DataFrame, keys: list[str], value: str, days: int = 7) -> DataFrame:
    """The value of the day exactly ``days`` before, by a join; ``lag`` counts rows and skips gaps."""
    before = series.select(*[F.col(k).alias(f"b_{k}") for k in keys], F.date_add("dt", days).alias("b_dt"), F.col(value).alias("before"))
    on = F.col("dt") == F.col("b_dt")
    for k in keys:
        on = on & (F.col(k) == F.col(f"b_{k}"))
    return series.join(before, on, "left").drop("b_dt", *[f"b_{k}" for k in keys])
