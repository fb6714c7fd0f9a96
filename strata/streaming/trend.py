"""Windowed popularity. The same function serves batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, time: str = "event_time", keys: tuple[str, ...] = ("entity_id",), width: str = "5 minutes", value: str = "popularity",
    watermark: str | None = None, extra: dict[str, Column] | None = None) -> DataFrame:
    """One row per tumbling window and key: samples, total, average over all samples, most, and ``extra`` aggregates.

    On a stream with a watermark, each window comes once it is closed, and later rows are dropped.
    """
    if watermark:
        events = events.withWatermark(time, watermark)
    more = [c.alias(k) for k, c in (extra or {}).items()]
    rows = events.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("samples"), F.sum(value).alias("total"),
        F.max(value).alias("most"), *more)
    average = F.coalesce(F.col("total"), F.lit(0.0)) / F.col("samples")
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "samples", "total", average.alias("average"), "most",
        *(extra or {}))


def popularity_extras(time: str = "event_time") -> dict[str, Column]:
    """The average of the known votes (0 without any), and the last title and list that are not empty."""
    last = lambda c: F.max_by(F.nullif(F.col(c), F.lit("")), F.when(F.col(c) != "", F.col(time)))
    return {"vote_average": F.coalesce(F.avg("vote_average"), F.lit(0.0)), "vote_count": F.max("vote_count"), "title": last("title"),
        "list_name": last("list_name")}
