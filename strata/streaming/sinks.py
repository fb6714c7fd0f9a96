"""Sinks of streams: idempotent tables, and a table beside them for what cannot be read."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.dedup import replacing
from strata.operators.rollups import merged


def idempotent(path: str):
    """For foreachBatch: a batch that is run again replaces its own files."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def split(good_path: str, bad_path: str, decode, good, bad):
    """For foreachBatch: valid rows to one table, the others to the dead-letter table, from one pass over a batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch).persist()
        try:
            idempotent(good_path)(good(decoded), batch_id)
            idempotent(bad_path)(bad(decoded), batch_id)
        finally:
            decoded.unpersist()

    return write


def retrying(write, attempts: int = 3, wait: float = 0.2, most_wait: float = 10.0, sleep=time.sleep):
    """For foreachBatch: a write that fails is tried again, after twice the time each time; the last error is raised."""

    def again(batch: DataFrame, batch_id: int) -> None:
        for n in range(attempts):
            try:
                return write(batch, batch_id)
            except Exception:
                if n + 1 == attempts:
                    raise
                sleep(min(most_wait, wait * 2**n))

    return again


def rolling_up(path: str, states):
    """For foreachBatch: the states that a batch adds to a roll-up, in a folder of the batch; ``read_rollup`` merges them."""
    write = idempotent(path)
    return lambda batch, batch_id: write(states(batch), batch_id)


def read_rollup(spark, path: str, bucket: str, keys: list[str]) -> DataFrame:
    """One state per bucket and keys, of all batches; a batch that was delivered again has replaced itself."""
    return merged(spark.read.parquet(path).drop("batch"), F.col(bucket), keys)


def run_available(stream: DataFrame, checkpoint: str, path: str, write=None) -> StreamingQuery:
    """Processes what is there, with exactly-once progress in the checkpoint, and ends."""
    return stream.writeStream.foreachBatch(write or idempotent(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_rows(table: DataFrame, keys: list[str], version: str) -> DataFrame:
    """What a replacing table shows: at-least-once deliveries count once."""
    return replacing(table, keys, version)
