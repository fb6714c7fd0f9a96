"""Ranked reports. Ties share a rank, so a top-n may have more than n rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions import columns as C


def top(rows: DataFrame, by: str, n: int, partition: str = "dt") -> DataFrame:
    """rows of rank n at most, with rank; rows where ``by`` is null have none. The optimiser limits groups early."""
    rank = F.dense_rank().over(Window.partitionBy(partition).orderBy(F.desc(by)))
    return rows.where(F.col(by).isNotNull()).withColumn("rank", rank).where(F.col("rank") <= n)


def in_order(ranked: DataFrame, *ties: str) -> DataFrame:
    """A report for reading: by day and rank, ties by the named columns. Only the rows of the report are sorted."""
    return ranked.orderBy("dt", "rank", *ties)


def top_movie(metric: DataFrame, n: int = 100) -> DataFrame:
    return top(metric, "popularity", n).select("dt", "rank", "movie_id", "title", "popularity", "popularity_wow", "vote_average")


def roi_ranking(metric: DataFrame, n: int = 100) -> DataFrame:
    return top(metric, "roi", n).select("dt", "rank", "movie_id", "title", "budget", "revenue", "roi")


def genre_trend(genres: DataFrame, metric: DataFrame) -> DataFrame:
    daily = genres.join(metric.select("dt", "movie_id", "popularity"), "movie_id").groupBy("dt", "genre_id", "genre_name")
    daily = daily.agg(F.count_distinct("movie_id").alias("movie_count"), F.avg("popularity").alias("avg_popularity"))
    week = F.lag("avg_popularity", 7).over(Window.partitionBy("genre_id").orderBy("dt"))
    return daily.withColumn("popularity_change", C.change_ratio(F.col("avg_popularity"), week))


def person_influence(career: DataFrame, n: int = 100) -> DataFrame:
    scored = career.withColumn("influence", C.influence(F.col("popularity"), F.col("work_count"), F.col("avg_vote_average")))
    return top(scored, "influence", n).select("dt", "rank", "person_id", "person_name", "work_count", "influence")
