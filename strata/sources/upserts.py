"""Tables that take upserts: rows lie in buckets of their keys, and a merge rewrites the buckets it touches alone."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from strata.sources import lake, swap
from strata.sources.raw import exists

BUCKET = "bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def last_versions(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, null keys included: that of the greatest ``order``, then of the greatest values, so that reruns agree."""
    values = [c for c in rows.columns if c not in keys]
    if not values:
        return rows.dropDuplicates(keys)
    best = F.max_by(F.struct(*values), F.struct(*order, *values))
    return rows.groupBy(*keys).agg(best.alias("__row")).select(*[F.col(k) if k in keys else F.col("__row")[k].alias(k) for k in rows.columns])


def merged(existing: DataFrame, incoming: DataFrame, keys: list[str], version: str | None = None) -> DataFrame:
    """existing with incoming upserted by its keys (null is a key): one row a key. The greatest ``version`` wins (null is
    the least); among equals, or without one, incoming does. Merging the same again changes nothing.
    """
    order = [F.col(version)] if version else []
    rows = existing.withColumn("__new", F.lit(0)).unionByName(incoming.select(*existing.columns).withColumn("__new", F.lit(1)))
    return last_versions(rows, keys, [*order, F.col("__new")]).drop("__new")


def create(df: DataFrame, path: str, keys: list[str], buckets: int = 64, version: str | None = None) -> None:
    """A new table of df's last versions. Large tables take so many buckets that one is a task's work."""
    if lake.load_state(df.sparkSession, f"{path}/_table"):
        raise ValueError(f"{path} is a table")
    lake.save_state(df.sparkSession, f"{path}/_table", {"keys": keys, "buckets": buckets, "schema": df.schema.json()})
    upsert(df, path, version)


def _bucketed(spark: SparkSession, path: str, said: dict) -> DataFrame:
    schema = StructType.fromJson(json.loads(said["schema"])).add(BUCKET, IntegerType())
    return spark.read.schema(schema).parquet(path) if exists(spark, f"{path}/{BUCKET}=*") else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str) -> DataFrame:
    """The table's rows."""
    return _bucketed(spark, path, lake.load_state(spark, f"{path}/_table")).drop(BUCKET)


def upsert(incoming: DataFrame, path: str, version: str | None = None) -> list[str]:
    """Merges incoming into the table; returns the folders of the buckets that were written. Of the others no file is
    read, moved or renamed; where incoming brings nothing new to a bucket, that is left alone, too.
    """
    spark = incoming.sparkSession
    said = lake.load_state(spark, f"{path}/_table")
    keys, place = said["keys"], bucket_of(said["keys"], said["buckets"])
    swap.recover(spark, path)
    table, folders = _bucketed(spark, path, said), set(swap.partitions(spark, path, BUCKET))
    # They are made once and asked for three times.
    rows = last_versions(incoming.select(*[c for c in table.columns if c != BUCKET]), keys, [F.col(version)] if version else []).withColumn(BUCKET, place).persist()
    try:
        # Buckets in which some key is new or has other values: what incoming has, without what is there just so.
        touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]  # a number per bucket
        there = [b for b in touched if swap.folder_of(spark, BUCKET, str(b)) in folders]
        old = table.where(F.col(BUCKET).isin(there))
        changed = [b for b in touched if b not in there]  # buckets that have no rows yet
        if there:
            changed += [r[0] for r in rows.where(F.col(BUCKET).isin(there)).exceptAll(old).select(BUCKET).distinct().collect()]
        if not changed:
            return []
        within = F.col(BUCKET).isin(changed)
        new = merged(old.where(within), rows.where(within), keys, version) if there else rows
        return swap.replace_partitions(new.repartition(len(changed), BUCKET), path, BUCKET)
    finally:
        rows.unpersist()
