"""Type-2 history: versions with [valid_from, valid_to], the current one up to a far future."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import FAR_FUTURE, content_hash
from strata.operators.dedup import latest


def far_future() -> Column:
    return F.lit(FAR_FUTURE).cast("timestamp")


def current(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("valid_to") == far_future())


def with_is_current(versions: DataFrame) -> DataFrame:
    return versions.withColumn("is_current", (F.col("valid_to") == far_future()).cast("int"))


def merge(existing: DataFrame, incoming: DataFrame, key: str, business: list[str], reject_older: bool = True) -> DataFrame:
    """existing with the versions that incoming opens; both have key, business, valid_from, valid_to.

    A version opens where a key is new or the hash of its business columns differs from the current version's. It
    closes the current version at its valid_from. A version of the same day is replaced. Incoming rows older than
    the current version are rejected. Without changes the result is existing, so merging again changes nothing.
    """
    columns = existing.columns
    incoming = latest(incoming.select(*columns), [key], F.col("valid_from"), *[F.col(c) for c in business])
    now = current(existing).select(F.col(key).alias("__key"), content_hash(*business).alias("__hash"), F.col("valid_from").alias("__from"))
    fresh = incoming.join(now, incoming[key] == now["__key"], "left").where(F.col("__key").isNull() | (F.col("__hash") != content_hash(*business)))
    if reject_older:
        fresh = fresh.where(F.col("__from").isNull() | (F.col("valid_from") >= F.col("__from")))
    opened = fresh.select(*[c for c in columns if c != "valid_to"], far_future().alias("valid_to")).select(*columns)
    bounds = opened.select(F.col(key).alias("__key"), F.col("valid_from").alias("__bound"))
    kept = existing.join(bounds, existing[key] == bounds["__key"], "left")
    kept = kept.where(F.col("__bound").isNull() | (F.col("valid_from") < F.col("__bound")) | (F.col("valid_to") != far_future()))
    closed = kept.withColumn("valid_to", F.when(F.col("__bound").isNull(), F.col("valid_to")).otherwise(F.least("valid_to", "__bound")))
    return closed.select(*columns).unionByName(opened)


def chain(versions: DataFrame, key: str) -> DataFrame:
    """The versions for reading: each key's in the order of their validity."""
    return versions.orderBy(key, "valid_from")


#: Keys with more versions meet their facts in buckets of time, of about so many versions each.
HOT_VERSIONS, BUCKET_VERSIONS = 1024, 256


def _time_bucket(at: Column) -> Column:
    """The place of a time in its key's buckets; 0 for keys that have none. Times beyond the last start are in the last bucket."""
    place = F.floor((F.unix_micros(at.cast("timestamp")) - F.col("__low")) / F.col("__width"))
    return F.coalesce(F.least(F.greatest(place, F.lit(0)), F.col("__buckets") - 1), F.lit(0)).cast("int")


def as_of(facts: DataFrame, versions: DataFrame, key: str, at: str, closed: bool = False, hot: int = HOT_VERSIONS, per_bucket: int = BUCKET_VERSIONS) -> DataFrame:
    """facts with the version that was valid at their time; half open, or closed at both ends.

    The join is by key; the range is checked on its matches. Keys with more than ``hot`` versions are cut in buckets of
    time: a version lies in each bucket that it reaches, a fact in one, and these meet, so that such a key is many
    tasks' work, and a fact looks at about ``per_bucket`` versions. The versions' clashing columns are dropped.
    """
    v = versions.select(F.col(key).alias("__key"), *[c for c in versions.columns if c not in facts.columns])
    start = F.unix_micros(F.col("valid_from").cast("timestamp"))
    sizes = v.groupBy("__key").agg(F.count(F.lit(1)).alias("n"), F.min(start).alias("__low"), F.max(start).alias("high")).where(F.col("n") > hot)
    buckets = F.ceil(F.col("n") / per_bucket)
    sizes = sizes.select("__key", "__low", buckets.alias("__buckets"), F.greatest((F.col("high") - F.col("__low")) / buckets, F.lit(1.0)).alias("__width"))
    reach = F.sequence(_time_bucket(F.col("valid_from")), F.greatest(_time_bucket(F.col("valid_to")), _time_bucket(F.col("valid_from"))))
    v = v.join(sizes, "__key", "left").withColumn("__bucket", F.explode(reach)).drop("__low", "__buckets", "__width")
    own = facts.join(sizes.withColumnRenamed("__key", "__hot"), facts[key] == F.col("__hot"), "left")
    own = own.withColumn("__at", _time_bucket(F.col(at))).drop("__hot", "__low", "__buckets", "__width")
    end = F.col(at) <= F.col("valid_to") if closed else F.col(at) < F.col("valid_to")
    on = (own[key] == v["__key"]) & (F.col("__at") == F.col("__bucket")) & (F.col(at) >= F.col("valid_from")) & end
    return own.join(v, on).drop("__key", "__at", "__bucket")
