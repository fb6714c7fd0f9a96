"""Roll-up states of a stream in tiers: folders of batches that merge as they become many.

A batch writes its states to a folder of tier 0. Once a tier has ``fan`` folders, these merge into one of the next
tier, so n batches lie in about fan * log(n) folders. A manifest names the folders that count, with the batches that
each covers: readers follow it and see each batch once, whatever a crash has left beside. A batch that is delivered
again is known by its number.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.rollups import merged
from strata.sources import lake

FAN = 4


def folders(spark: SparkSession, path: str) -> list[dict]:
    """What the manifest names: tier, folder, first and last batch."""
    return lake.load_state(spark, f"{path}/_manifest").get("folders", [])


def read(spark: SparkSession, path: str, bucket: str, keys: list[str]) -> DataFrame:
    """One state per bucket and keys, of all batches."""
    found = folders(spark, path)
    if not found:
        raise ValueError(f"{path} has no batch yet")
    return merged(spark.read.parquet(*[f"{path}/{f['folder']}" for f in found]), F.col(bucket), keys)


def rolling_up(path: str, states, keys: list[str], bucket: str = "bucket", fan: int = FAN):
    """For foreachBatch: adds ``states(batch)``, and merges tiers that are full."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = folders(spark, path)
        if not any(f["first"] <= batch_id <= f["last"] for f in found):
            folder = f"t0-{batch_id}-{uuid.uuid4().hex[:8]}"
            states(batch).write.parquet(f"{path}/{folder}")
            found = [*found, {"tier": 0, "folder": folder, "first": batch_id, "last": batch_id}]
            lake.save_state(spark, f"{path}/_manifest", {"folders": found})
        compact(spark, path, keys, bucket, fan)

    return write


def compact(spark: SparkSession, path: str, keys: list[str], bucket: str = "bucket", fan: int = FAN) -> int:
    """Merges the oldest ``fan`` folders of each full tier; returns how many merges that took. Folders that no manifest
    names any more are deleted after it has changed, so a reader that began before has to begin again.
    """
    found, done = folders(spark, path), 0
    tier = 0
    while tier <= max((f["tier"] for f in found), default=-1):
        own = sorted((f for f in found if f["tier"] == tier), key=lambda f: f["first"])
        if len(own) < fan:
            tier += 1
            continue
        some = own[:fan]
        new = {"tier": tier + 1, "folder": f"t{tier + 1}-{some[0]['first']}-{uuid.uuid4().hex[:8]}", "first": some[0]["first"], "last": some[-1]["last"]}
        states = merged(spark.read.parquet(*[f"{path}/{f['folder']}" for f in some]), F.col(bucket), keys)
        states.write.parquet(f"{path}/{new['folder']}")
        found = [f for f in found if f not in some] + [new]
        lake.save_state(spark, f"{path}/_manifest", {"folders": found})
        for f in some:
            lake.delete(spark, f"{path}/{f['folder']}")
        done += 1
    return done


def sweep(spark: SparkSession, path: str) -> int:
    """Deletes the folders that crashes have left beside those of the manifest; returns how many."""
    fs, where = lake._fs(spark, path)
    named = {f["folder"] for f in folders(spark, path)}
    lost = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName()[:1] == "t" and s.getPath().getName() not in named]
    for folder in lost:
        fs.delete(folder, True)
    return len(lost)
