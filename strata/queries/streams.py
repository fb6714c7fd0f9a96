"""Streams over the events table, and their batch forms."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.queries import views as V
from strata.queries.batch import no_zone
from strata.queries.registry import query
from strata.session import shared_folder
from strata.streaming import codec, metrics, sinks, stateful, tiers, trend

WINDOWS = "w AS (SELECT time_bucket(INTERVAL '{0}', event_time) AS window_start, event_type, count(*) AS samples, sum(popularity)::BIGINT AS total, max(popularity) AS most, round(sum(popularity) / count(*), 6) AS average FROM observed GROUP BY 1, 2)"
HOURS = f"WITH {V.OBSERVED}, " + WINDOWS.format("1 hour")
SURGE = ", l AS (SELECT *, lag(average) OVER (PARTITION BY event_type ORDER BY window_start) AS baseline FROM w) SELECT window_start, event_type, samples, average, baseline, round(average / baseline, 6) AS ratio FROM l WHERE samples >= 3 AND average >= 2000 AND baseline > 0 AND average / baseline >= 1.5"


def windows(t, width: str) -> DataFrame:
    rows = trend.windowed(V.observed(t), keys=("event_type",), width=width)
    return rows.withColumn("average", F.round("average", 6))


@query(f"WITH {V.OBSERVED}, " + WINDOWS.format("5 minutes") + " SELECT * FROM w")
def tumbling_window(spark, t) -> DataFrame:
    return no_zone(windows(t, "5 minutes").drop("window_end"))


@query(HOURS + " SELECT * FROM w")
def tumbling_window_hour(spark, t) -> DataFrame:
    return no_zone(windows(t, "1 hour").drop("window_end"))


@query(HOURS + SURGE)
def surge_alerts(spark, t) -> DataFrame:
    rows = stateful.surges(windows(t, "1 hour"), ["event_type"], least=2000.0)
    return no_zone(rows.select("window_start", "event_type", "samples", "average", "baseline", F.round("ratio", 6).alias("ratio")))


@query(HOURS + SURGE.replace(" SELECT window_start,", ", a AS (SELECT window_start,",
    1) + ") SELECT date_trunc('hour', window_start) AS bucket, event_type, count(*) AS alerts, max(ratio) AS most FROM a GROUP BY 1, 2")
def alert_rollup(spark, t) -> DataFrame:
    from strata.operators.rollups import alert_rollup as rolled

    rows = stateful.surges(windows(t, "1 hour"), ["event_type"], least=2000.0).withColumn("ratio", F.round("ratio", 6))
    return no_zone(rolled(rows, "window_start", ["event_type"], "ratio"))


def envelopes(t) -> DataFrame:
    """events as messages on the wire, some of them broken, in either naming."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    event = lambda *names: F.to_json(F.struct(F.lit("POPULARITY_OBSERVED").alias(names[0]), F.lit("movie").alias(names[1]), F.col("user_id").alias(names[2]),
        ms.alias(names[3]), F.md5(F.col("event_type")).alias(names[4]), F.col("event_id").cast("string").alias(names[5])))
    snake, camel = event("event_type", "entity_type", "entity_id", "event_time", "content_hash", "event_id"), event("eventType", "entityType", "entityId",
        "eventTime", "contentHash", "eventId")
    k = F.col("event_id") % 10
    broken = F.when(k == 7, F.lit("not-json")).when(k == 8, F.lit("[]")).when(k == 9, F.lit("{}"))
    return t.events.select("event_id", F.when(k >= 7, broken).when(k >= 4, camel).otherwise(snake).alias("value"))


@query("SELECT event_id, event_id % 10 < 7 AS valid, CASE WHEN event_id % 10 < 7 THEN user_id END AS entity_id, CASE WHEN event_id % 10 < 7 THEN (epoch_us(ts) // 1000) END AS event_ms FROM events")
def dlq_split(spark, t) -> DataFrame:
    rows = codec.decode(envelopes(t).withColumnRenamed("event_id", "n"))
    return rows.select(F.col("n").alias("event_id"), "valid", "entity_id", "event_ms")


def scratch(spark: SparkSession) -> str:
    """A folder for checkpoints and output, under the folder that all machines share."""
    return f"{shared_folder(spark)}/stream-{uuid.uuid4()}"


def own_session(spark: SparkSession) -> SparkSession:
    """A session of its own for a stream's settings, which other queries don't see."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "4")
    return own


def observed_stream(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", F.col("ts").cast("timestamp").alias("event_time"), "user_id", "event_type", V.cents("value").alias("popularity"))


def stream_of(spark, t) -> DataFrame:
    reader = own_session(spark).readStream.schema(t.events.schema)
    return observed_stream(reader.option("pathGlobFilter", "events.parquet").parquet(t._dir))


def in_files(spark, parts: list[DataFrame], folder: str) -> DataFrame:
    """A stream of the parts, one after the other, a file a batch."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for k, rows in enumerate(parts):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/{k}")
        fs = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for file in fs.globStatus(hadoop(f"{folder}/{k}/*.parquet")):  # files go by their times
            fs.setTimes(file.getPath(), 1_700_000_000_000 + 60_000 * k, -1)
    reader = own_session(spark).readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", "*.parquet").parquet(folder)


def available_now(spark, stream: DataFrame, empty_batches: bool = True, base: str | None = None) -> DataFrame:
    """What the stream gives for the data that is there.

    State that expires by the clock asks for another empty batch after each one, so such a stream would never end.
    """
    base = base or scratch(spark)
    stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(empty_batches).lower())
    sinks.run_available(stream, f"{base}/checkpoint", f"{base}/out").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{base}/out").select(*stream.columns)


#: A stream shows windows that the watermark has passed, a minute behind the newest event.
CLOSED = " WHERE window_start + INTERVAL '1 hour' <= (SELECT max(event_time) - INTERVAL '1 minute' FROM observed)"


@query(HOURS + " SELECT window_start, event_type, samples, total, most, average FROM w" + CLOSED)
def stream_trend_available_now(spark, t) -> DataFrame:
    rows = trend.windowed(stream_of(spark, t), keys=("event_type",), width="1 hour", watermark="1 minute").withColumn("average", F.round("average", 6))
    return no_zone(available_now(spark, rows).drop("window_end"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NULL OR before <> event_type")
def stream_dedup_available_now(spark, t) -> DataFrame:
    rows = stateful.deduplicated(stream_of(spark, t), ["user_id"], "event_type", ["event_time", "event_id"])
    return available_now(spark, rows, empty_batches=False).select("event_id", "user_id", "event_type")


@query(HOURS.replace("FROM observed GROUP BY 1, 2)",
    "FROM observed GROUP BY 1, 2 HAVING time_bucket(INTERVAL '1 hour', min(event_time)) + INTERVAL '1 hour' <= (SELECT max(event_time) - INTERVAL '1 minute' FROM observed))") + SURGE)
def stream_surge_available_now(spark, t) -> DataFrame:
    rows = trend.windowed(stream_of(spark, t), keys=("event_type",), width="1 hour", watermark="1 minute").select("window_start", "event_type", "samples",
        F.round("average", 6).alias("average"))
    found = available_now(spark, stateful.surge_stream(rows, ["event_type"], least=2000.0))
    return no_zone(found.select("window_start", "event_type", "samples", "average", "baseline", F.round("ratio", 6).alias("ratio")))


#: Events before this time come in a third batch. Spark judges a batch's rows by the watermark that the batch before
#: began with, which the first two batches have moved beyond them.
LATE = "2024-01-15 00:00:00"


def three_batches(t) -> list[DataFrame]:
    late, even = F.col("ts") < F.lit(LATE).cast("timestamp_ntz"), F.col("event_id") % 2 == 0
    return [t.events.where(~late & even), t.events.where(~late & ~even), t.events.where(late)]


@query(HOURS.replace("FROM events)", f"FROM events WHERE ts >= TIMESTAMP '{LATE}')") + f", n AS (SELECT count(*) AS late_rows FROM events WHERE ts < TIMESTAMP '{LATE}') SELECT window_start, event_type, samples, total, most, average, late_rows, late_rows > 0 AS reported FROM w, n" + CLOSED)
def stream_late_rows(spark, t) -> DataFrame:
    """Three batches: what the last brings is late, and its rows are dropped; windows show what came in time. The rows
    dropped are those that are in no closed window and in none that the state still holds; the listener has reported
    (combined) rows that came too late if there are any.
    """
    base, seen = scratch(spark), metrics.StreamMetrics()
    stream = observed_stream(in_files(spark, three_batches(t), f"{base}/in"))
    rows = trend.windowed(stream, keys=("event_type",), width="1 hour", watermark="1 minute").withColumn("average", F.round("average", 6))
    own = stream.sparkSession
    own.streams.addListener(seen)
    closed = available_now(spark, rows, base=base)
    own.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    own.streams.removeListener(seen)
    seen.flush(spark, f"{base}/metrics")
    came, late = spark.read.parquet(f"{base}/metrics").agg(F.sum("input_rows"), F.sum("late")).first()
    kept = closed.agg(F.sum("samples")).first()[0] + (metrics.last_state(spark, f"{base}/checkpoint").agg(F.sum("value.count")).first()[0] or 0)
    return no_zone(closed.drop("window_end").withColumns({"late_rows": F.lit(came - kept).cast("bigint"), "reported": F.lit(late > 0)}))


def let_in(spark, t) -> DataFrame:
    """event_id, event_type of the rows of ``three_batches`` that a stream with a watermark of a minute takes."""
    stream = observed_stream(in_files(spark, three_batches(t), f"{scratch(spark)}/in"))
    rows = stream.withWatermark("event_time", "1 minute").dropDuplicatesWithinWatermark(["event_id"])
    return available_now(spark, rows.select("event_id", "event_type"))


@query(f"SELECT event_id, event_type FROM events WHERE ts >= TIMESTAMP '{LATE}'")
def late_data_filter(spark, t) -> DataFrame:
    """The rows that come in time; the watermark drops the others."""
    return let_in(spark, t)


@query(f"SELECT event_id, event_type FROM events WHERE ts < TIMESTAMP '{LATE}'")
def late_data_filter_all(spark, t) -> DataFrame:
    """The rows that came too late: those that were sent, without those that were taken."""
    return t.events.select("event_id", "event_type").join(let_in(spark, t).select("event_id"), "event_id", "left_anti")


@query(HOURS + " SELECT window_start, event_type, samples, total, window_start + INTERVAL '1 hour' <= (SELECT max(event_time) - INTERVAL '1 minute' FROM observed) AS closed, 2 AS starts, 1 AS failures FROM w")
def stream_recovered(spark, t) -> DataFrame:
    """A stream of three batches that dies inside its second one, after that has written, and is started again from its
    checkpoint: the closed windows, and the open ones from the state that it leaves. Both are those of an undisturbed run.
    """
    base, seen, died = scratch(spark), metrics.StreamMetrics(), []
    until = lambda day: F.col("ts") < F.lit(f"2024-01-{day}").cast("timestamp_ntz")
    parts = [t.events.where(until(11)), t.events.where(~until(11) & until(21)), t.events.where(~until(21))]
    stream = observed_stream(in_files(spark, parts, f"{base}/in"))
    rows = trend.windowed(stream, keys=("event_type",), width="1 hour", watermark="1 minute")
    write = sinks.idempotent(f"{base}/out")

    def dying(batch: DataFrame, batch_id: int) -> None:
        write(batch, batch_id)
        if batch_id == 1 and not died:
            died.append(1)
            raise OSError("the machine is gone")

    stream.sparkSession.streams.addListener(seen)
    starts = metrics.supervised(lambda: sinks.run_available(rows, f"{base}/checkpoint", f"{base}/out", dying), sleep=lambda s: None)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stream.sparkSession.streams.removeListener(seen)
    failures = metrics.alerts(seen.rows(spark)).where("kind = 'FAILED'").count()
    closed = spark.read.schema(rows.schema).parquet(f"{base}/out").select("window_start", "event_type", "samples", "total", F.lit(True).alias("closed"))
    kept = metrics.last_state(spark, f"{base}/checkpoint").select(F.col("key.window.start").alias("window_start"), "key.event_type", F.col("value.count").alias("samples"),
        F.col("value.sum").alias("total"), F.lit(False).alias("closed"))
    return no_zone(closed.unionByName(kept).withColumns({"starts": F.lit(starts), "failures": F.lit(failures)}))


@query(f"WITH {V.OBSERVED} SELECT event_time::DATE AS bucket, event_type, count(*) AS n, sum(popularity)::BIGINT AS total, max(popularity) AS most, min(popularity) AS least, TRUE AS few_folders FROM observed GROUP BY 1, 2")
def stream_rollup_tiers(spark, t) -> DataFrame:
    """A stream of twenty batches, each of which fails once after it has been added and so comes again: days from the
    hours in a handful of folders.
    """
    from strata.operators.rollups import hourly, merged

    base, failed = scratch(spark), set()
    stream = observed_stream(in_files(spark, [t.events.where(F.col("event_id") % 20 == k) for k in range(20)], f"{base}/in"))
    add = tiers.rolling_up(f"{base}/rollup", lambda rows: hourly(rows, "event_time", ["event_type"], "popularity"), ["event_type"])

    def failing(batch: DataFrame, batch_id: int) -> None:
        add(batch, batch_id)
        if batch_id not in failed:
            failed.add(batch_id)
            raise OSError("no answer")

    sinks.run_available(stream, f"{base}/checkpoint", "", sinks.retrying(failing, sleep=lambda s: None)).awaitTermination()
    few = len(tiers.folders(spark, f"{base}/rollup")) <= 8 and len(failed) == 20
    states = tiers.read(spark, f"{base}/rollup", "bucket", ["event_type"])
    return merged(states, F.to_date("bucket"), ["event_type"]).withColumn("few_folders", F.lit(few))
