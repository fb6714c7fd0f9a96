"""Ingestion from files: full loads with a failure gate, incremental loads by watermark, and ranks of polled lists."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.columns import date_windows
from strata.sources import lake
from strata.sources.raw import changed_ids


@dataclass(frozen=True)
class Result:
    wanted: int
    loaded: int
    missing: int
    failed: int

    def passes(self, most_failed: float = 0.05) -> bool:
        """Missing records are no failures: a source may have deleted them."""
        return self.failed <= most_failed * max(1, self.wanted)


def full_load(ids: DataFrame, details: DataFrame, path: str, most_failed: float = 0.05) -> Result:
    """Writes the raw records of ``ids`` (id) from ``details`` (entity_id, payload, ...) as gzipped lines.

    An id without details is missing, one whose payload is no JSON object with this id has failed. Counts come with
    the write. The records go to a stage beside ``path`` and are moved in once the counts are good: if too many have
    failed, RuntimeError is raised and ``path`` is as it was, with all that earlier loads have left there.
    """
    spark, stage = ids.sparkSession, f"{path.rstrip('/').rpartition('/')[0]}/_load-{uuid.uuid4().hex}"
    rows = ids.select(F.col("id").alias("wanted_id")).distinct().join(details, F.col("wanted_id") == F.col("entity_id"), "left")
    own = F.try_variant_get(F.try_parse_json("payload"), "$.id", "bigint")
    rows = rows.withColumn("state", F.when(F.col("entity_id").isNull(), "missing").when(own.eqNullSafe(F.col("wanted_id")), "loaded").otherwise("failed"))
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("wanted"), *[F.count_if(F.col("state") == s).alias(s) for s in ("loaded", "missing", "failed")]]
    try:
        lake.write_ndjson(rows.observe(seen, *counts).where("state = 'loaded'").select(*details.columns), stage)
        result = Result(**seen.get)
        if not result.passes(most_failed):
            raise RuntimeError(f"{result.failed} of {result.wanted} records failed")
        lake.move_in(spark, stage, path)
        return result
    finally:
        lake.delete(spark, stage)


def incremental(spark: SparkSession, state_path: str, entity: str, today: str, load: Callable[[str, str], None], start: str,
    days: int = 14) -> list[tuple[str, str]]:
    """Loads the windows from an entity's watermark to yesterday, in order; the watermark follows each that succeeds.

    A window that fails ends the run with its error, so that the next run begins with it.
    """
    mark = date.fromisoformat(lake.load_state(spark, state_path).get(entity, start))
    until, done = date.fromisoformat(today) - timedelta(days=1), []
    windows = spark.range(1).select(F.explode(date_windows(F.lit(mark), F.lit(until), days)).alias("w")).select("w.*").collect() if mark <= until else []
    for w in windows:
        load(str(w["start"]), str(w["end"]))
        lake.update_state(spark, state_path, lambda state, w=w: state | {entity: str(w["end"] + timedelta(days=1))})
        done.append((str(w["start"]), str(w["end"])))
    return done


def changes_between(changes: DataFrame, start: str, end: str, adult: bool = False) -> DataFrame:
    """The ids that changed in a closed window of days, once each."""
    return changed_ids(changes.where(F.col("dt").between(F.lit(start).cast("date"), F.lit(end).cast("date"))), adult)


def ranked_pages(pages: DataFrame, keys: list[str], page: str = "page", results: str = "results") -> DataFrame:
    """Every result with its rank from 1 across the pages of its list: what the pages before hold, and its own place."""
    order = Window.partitionBy(*keys).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.coalesce(F.size(results), F.lit(0))).over(order), F.lit(0))
    rows = pages.select(*keys, page, results, before.alias("before")).select(*keys, "before", F.posexplode(results).alias("at", "result"))
    return rows.select(*keys, (F.col("before") + F.col("at") + 1).cast("int").alias("rank"), "result.*")
