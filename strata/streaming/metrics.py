"""What streams say about themselves, batch by batch, in a table: rows, latency, lag, and what came too late."""

from __future__ import annotations

import threading
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from strata.functions.columns import MOST_LATENCY_MS

SCHEMA = ("query string, run string, batch long, started timestamp, input_rows long, batch_ms long, watermark timestamp, newest timestamp, latency_ms long, "
    "lag long, late long, state_rows long, error string")


def _time(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None


class StreamMetrics(StreamingQueryListener):
    """A listener: ``spark.streams.addListener(metrics)``. It keeps a row a batch until ``flush`` appends them to a table.

    newest is the greatest event time of a batch and latency_ms how far behind its start that was; lag counts what
    sources report as not read yet; late counts what stateful operators dropped for being behind the watermark (groups,
    where they aggregate: Spark combines before it drops). A query that ends by an error leaves a row with it.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        times = dict(p.eventTime or {})
        started, newest = _time(p.timestamp), _time(times.get("max"))
        latency = int((started - newest).total_seconds() * 1000) if newest else None
        lag = [int(dict(s.metrics or {}).get("maxOffsetsBehindLatest", 0)) for s in p.sources]
        row = (str(p.id), str(p.runId), p.batchId, started, p.numInputRows, p.batchDuration, _time(times.get("watermark")), newest, latency, sum(lag),
            sum(s.numRowsDroppedByWatermark for s in p.stateOperators), sum(s.numRowsTotal for s in p.stateOperators), None)
        with self._lock:
            self._rows.append(row)

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            with self._lock:
                self._rows.append((str(event.id), str(event.runId), *[None] * 10, event.exception[:1000]))

    def rows(self, spark: SparkSession) -> DataFrame:
        with self._lock:
            return spark.createDataFrame(list(self._rows), SCHEMA)

    def flush(self, spark: SparkSession, path: str) -> int:
        """Appends the rows kept so far to a table; returns how many."""
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
        return len(rows)


def alerts(metrics: DataFrame, latency_ms: int = MOST_LATENCY_MS, lag: int = 10_000) -> DataFrame:
    """Batches beyond a limit: query, batch, kind (LATENCY, LAG, LATE_ROWS or FAILED), value."""
    kinds = [("LATENCY", F.col("latency_ms") > latency_ms, F.col("latency_ms")), ("LAG", F.col("lag") > lag, F.col("lag")),
        ("LATE_ROWS", F.col("late") > 0, F.col("late")), ("FAILED", F.col("error").isNotNull(), F.lit(1).cast("long"))]
    found = F.filter(F.array(*[F.when(over, F.struct(F.lit(kind).alias("kind"), value.alias("value"))) for kind, over, value in kinds]), lambda x: x.isNotNull())
    return metrics.select("query", "batch", F.explode(found).alias("a")).select("query", "batch", "a.*")


def supervised(start, attempts: int = 3, wait: float = 10.0, sleep=time.sleep) -> int:
    """Runs a stream and starts it again from its checkpoint after an error, at most ``attempts`` times in all; the last
    error is raised. ``start`` returns a started query. Returns how many starts it took.
    """
    for n in range(1, attempts + 1):
        query = start()
        try:
            query.awaitTermination()
            return n
        except Exception:
            if n == attempts:
                raise
            sleep(wait)
    raise ValueError("attempts must be 1 or more")


def last_state(spark: SparkSession, checkpoint: str, operator: int = 0, store: str | None = None) -> DataFrame:
    """What a stream's state holds after its last batch: key, value (structs) and partition_id."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader.option("storeName", store) if store else reader).load(checkpoint)
