"""Readers of raw records, exports and tables."""

from __future__ import annotations

import gzip
import io
import itertools

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import display_name
from strata.sources.schemas import EXPORT, RAW


def exists(spark: SparkSession, path: str) -> bool:
    """Whether files match the path, through Spark's own file systems. What cannot be listed raises, but for a file
    system that says of a missing folder that it is not there.
    """
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        return bool(glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob))
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return False
        raise


def read_partition(spark: SparkSession, base: str, entity: str, dt: str) -> DataFrame:
    """The raw records of an entity and day; an empty frame with the same columns if there are none."""
    path = f"{base}/raw/{entity}/dt={dt}"
    if not exists(spark, f"{path}/*.ndjson.gz"):
        return spark.createDataFrame([], RAW)
    rows = spark.read.schema(RAW).option("mode", "PERMISSIVE").option("pathGlobFilter", "*.ndjson.gz").json(path)
    return rows.where("entity_id is not null")


def read_or_none(spark: SparkSession, table: str) -> DataFrame | None:
    return spark.read.table(table) if spark.catalog.tableExists(table) else None


def export_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of files that may be gzipped, whatever their names say: the first two bytes tell."""

    def lines(batches):
        for batch in batches:
            for content in batch.column(0).to_pylist():
                with gzip.open(io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content) as file:
                    while some := list(itertools.islice(file, 50_000)):
                        yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace").rstrip("\r\n") for x in some])], names=["value"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(lines, "value string")


def read_export(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Records of a daily id export with their display name; blank and malformed lines are left out.

    Raises ValueError if no line is good. ``export_counts`` says how many lines were not.
    """
    rows = export_lines(spark, path).select(F.from_json("value", EXPORT).alias("r")).select("r.*").where("id is not null")
    rows = rows.withColumn("display_name", display_name(F.col("title"), F.col("name")))
    if rows.isEmpty():
        raise ValueError(f"{path} has no good record")
    return rows.limit(limit) if limit else rows


def export_counts(spark: SparkSession, path: str) -> DataFrame:
    """good, blank and malformed lines of an export, in one row."""
    rows = export_lines(spark, path).select(F.trim("value") == "", F.from_json("value", EXPORT)["id"].isNotNull()).toDF("blank", "good")
    return rows.agg(F.count_if("good").alias("good"), F.count_if("blank").alias("blank"), F.count_if(~F.col("good") & ~F.col("blank")).alias("malformed"))


def changed_ids(changes: DataFrame, adult: bool = False) -> DataFrame:
    """The distinct ids of a window's changes (id, adult), without adult ones unless they are asked for."""
    rows = changes.where("id is not null")
    return (rows if adult else rows.where(~F.coalesce(F.col("adult"), F.lit(False)))).select("id").distinct()


def sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **values) -> DataFrame:
    """A query with named parameters (:name) over tables given by name ({name}); values are never put into the text."""
    return spark.sql(text, args=values, **(tables or {}))


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """A stream of event texts from files; with the Kafka connector installed, kafka_events does the same."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def kafka_events(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """Committed offsets are those of the query's checkpoint; a new query starts from the earliest."""
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest")
    return stream.load().select(F.col("value").cast("string").alias("value"))
