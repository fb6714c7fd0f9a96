"""Keyed state: content deduplication and surge detection, each as a batch form and a stream form."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from strata.functions.columns import alert_id, growth_ratio

#: A surge needs so many samples, so high an average, and such a growth over the window before.
SAMPLES, LEAST, RATIO = 3, 20.0, 1.5


def surges(windows: DataFrame, keys: list[str], samples: int = SAMPLES, least: float = LEAST, ratio: float = RATIO) -> DataFrame:
    """Windows that surge over the key's window before, with baseline, ratio and alert_id."""
    before = F.lag("average").over(Window.partitionBy(*keys).orderBy("window_start"))
    rows = windows.withColumn("baseline", before)
    rows = rows.where((F.col("samples") >= samples) & (F.col("average") >= least) & (F.col("baseline") > 0))
    rows = rows.withColumn("ratio", growth_ratio(F.col("average"), F.col("baseline"))).where(F.col("ratio") >= ratio)
    return rows.withColumn("alert_id", alert_id(F.lit("surge"), F.concat_ws(":", *keys), F.col("window_start")))


class Deduplicator(StatefulProcessor):
    """Rows whose content differs from the key's last one; state is forgotten after ``ttl_ms`` without a write."""

    def __init__(self, content: str, order: list[str], ttl_ms: int):
        self.content, self.order, self.ttl_ms = content, order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "hash string", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = self.last.get()[0] if self.last.exists() else None
        batch = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        content = batch[self.content].where(batch[self.content].astype(bool), None).astype(object)
        known = content.ffill()
        before = known.shift()
        if first is not None:  # what the state remembers stands before the first row that has content
            known, before = known.fillna(first), before.fillna(first)
        new = content.notna() & (content != before)
        if new.any():
            self.last.update((content[new].iloc[-1],))
        yield batch[new | content.isna()]

    def close(self) -> None:
        pass


def deduplicated(stream: DataFrame, keys: list[str], content: str, order: str | list[str], ttl_ms: int = 7 * 24 * 3600 * 1000) -> DataFrame:
    """Rows of a batch go by the columns of ``order``, the first of which is the time and the others break its ties."""
    order = [order] if isinstance(order, str) else order
    return stream.groupBy(*keys).transformWithStateInPandas(Deduplicator(content, order, ttl_ms), outputStructType=stream.schema, outputMode="Append",
        timeMode="ProcessingTime")


class SurgeDetector(StatefulProcessor):
    """Keeps each key's last window average; emits the windows that surge over it."""

    def __init__(self, samples: int, least: float, ratio: float):
        self.limits = samples, least, ratio

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.before = handle.getValueState("before", "average double")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        samples, least, ratio = self.limits
        batch = pd.concat(list(rows)).sort_values("window_start")
        first = self.before.get()[0] if self.before.exists() else float("nan")
        batch["baseline"] = batch["average"].shift().astype(float)
        batch.iloc[0, batch.columns.get_loc("baseline")] = first
        batch["ratio"] = batch["average"] / batch["baseline"].where(batch["baseline"] > 0)
        self.before.update((float(batch["average"].iloc[-1]),))
        yield batch[(batch["samples"] >= samples) & (batch["average"] >= least) & (batch["ratio"] >= ratio)]

    def close(self) -> None:
        pass


def surge_stream(windows: DataFrame, keys: list[str], samples: int = SAMPLES, least: float = LEAST, ratio: float = RATIO) -> DataFrame:
    schema = StructType(list(windows.schema.fields)).add("baseline", "double").add("ratio", "double")
    return windows.groupBy(*keys).transformWithStateInPandas(SurgeDetector(samples, least, ratio), outputStructType=schema, outputMode="Append",
        timeMode="None")
