"""Roll-ups as partial states (sum and count, max, min) that merge to coarser ones without loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = {"n": F.sum, "total": F.sum, "most": F.max, "least": F.min}


def states(events: DataFrame, bucket: Column, keys: list[str], value: str) -> DataFrame:
    """One state per bucket and keys."""
    v = F.col(value)
    return events.groupBy(bucket.alias("bucket"), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(v).alias("total"), F.max(v).alias("most"),
        F.min(v).alias("least"))


def hourly(events: DataFrame, time: str, keys: list[str], value: str) -> DataFrame:
    return states(events, F.date_trunc("hour", time), keys, value)


def merged(partials: DataFrame, bucket: Column, keys: list[str]) -> DataFrame:
    """States of a coarser bucket; the same as from the events themselves."""
    return partials.groupBy(bucket.alias("merged_bucket"), *keys).agg(*[f(c).alias(c) for c, f in STATE.items()]).withColumnRenamed("merged_bucket", "bucket")


def read(partials: DataFrame) -> DataFrame:
    """With the average."""
    return partials.withColumn("average", F.try_divide(F.col("total"), F.col("n")))


def alert_rollup(alerts: DataFrame, time: str, keys: list[str], ratio: str) -> DataFrame:
    return alerts.groupBy(F.date_trunc("hour", time).alias("bucket"), *keys).agg(F.count(F.lit(1)).alias("alerts"), F.max(ratio).alias("most"))
