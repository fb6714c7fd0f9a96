"""Writers of lake tables."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata.sources import rolling
from strata.sources.raw import exists


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def overwrite_partitions(df: DataFrame, path: str, by: str = "dt") -> None:
    """Replaces the partitions that df has, and no other."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def append(df: DataFrame, path: str, by: str | None = None) -> int:
    """Adds df's rows; returns how many."""
    return counted(df, lambda d: (d.write.partitionBy(by) if by else d.write).mode("append").parquet(path))


def insert(df: DataFrame, path: str, columns: list[str], by: str | None = None) -> int:
    """Adds rows to a table with exactly these columns; others are refused before anything is written."""
    return append(checked(df, columns), path, by)


def _move(fs, source, target) -> None:
    """Some file systems say that a rename failed and some raise; here it always raises."""
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be renamed to {target}")


def publish(df: DataFrame, path: str) -> int:
    """Replaces a whole table, which df may be reading: write beside it, then swap. Returns the rows that were written.

    The rows are counted while they are written. If the swap fails, the table is put back as it was.
    """
    spark, stage, old = df.sparkSession, f"{path}__{uuid.uuid4().hex}", f"{path}__{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs, target = _fs(spark, path)
    stage_path, old_path = hadoop(stage), hadoop(old)
    try:
        rows = counted(df, lambda d: d.write.parquet(stage))
        had = fs.exists(target)
        if had:
            _move(fs, target, old_path)
        try:
            _move(fs, stage_path, target)
        except Exception:
            if had:
                _move(fs, old_path, target)
            raise
        if had:
            fs.delete(old_path, True)
        return rows
    finally:
        fs.delete(stage_path, True)


def counted(df: DataFrame, write) -> int:
    """Runs ``write`` on df and returns how many rows it wrote, without a job of its own."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def replace_window(existing: DataFrame, incoming: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """existing without the rows whose column lies in [start, end], and incoming."""
    inside = F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    return existing.where(~F.coalesce(inside, F.lit(False))).unionByName(incoming)


def checked(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with exactly these columns in this order."""
    if set(df.columns) != set(columns):
        raise ValueError(f"columns are {df.columns}, not {columns}")
    return df.select(*columns)


def write_ndjson(df: DataFrame, path: str, records_per_file: int = rolling.LINES, bytes_per_file: int = rolling.BYTES) -> None:
    """Adds gzipped lines of JSON, in files that ``raw.read_partition`` reads: at most so many records, and about so
    many bytes before compression, each.
    """
    rolling.write_records(df, path, records_per_file, bytes_per_file)


def move_in(spark: SparkSession, stage: str, path: str, pattern: str = f"*{rolling.SUFFIX}") -> int:
    """Moves the files of a stage into a folder, beside what it has; returns how many. The stage goes."""
    fs, target = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(target)
    found = [status.getPath() for status in fs.globStatus(hadoop(f"{stage}/{pattern}")) or ()]
    for file in found:
        _move(fs, file, hadoop(target, file.getName()))
    delete(spark, stage)
    return len(found)


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20) -> int:
    """Rewrites a whole table to files of about target_bytes; returns their number. ``swap.compact`` takes small files alone."""
    fs, where = _fs(spark, path)
    files = max(1, -(-fs.getContentSummary(where).getLength() // target_bytes))
    publish(spark.read.parquet(path).repartition(int(files)), path)
    return int(files)


def expire(spark: SparkSession, path: str, older_than_ms: int) -> list[str]:
    """Deletes what crashed publishes have left beside a table (its name and 32 hexadecimal digits), if it has not been
    touched since then. A table that such a crash has moved aside and not replaced is put back instead. Returns the names.
    """
    fs, target = _fs(spark, path)
    left = [s for s in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}__*")) or () if re.fullmatch(r".*__[0-9a-f]{32}", s.getPath().getName())]
    old = sorted((s for s in left if s.getModificationTime() < older_than_ms), key=lambda s: s.getModificationTime())
    if old and not fs.exists(target):
        whole = [s for s in old if exists(spark, f"{s.getPath()}/_SUCCESS")]
        if whole:  # the oldest one: its stage came after it
            _move(fs, whole[0].getPath(), target)
            old.remove(whole[0])
    for s in old:
        fs.delete(s.getPath(), True)
    return [s.getPath().getName() for s in old]


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written by the driver through Spark's file systems."""
    fs, where = _fs(spark, path)
    out = fs.create(where, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def get_text(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    data = fs.open(where)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes the text beside the old one and swaps, so that a crash leaves one of the two."""
    fs, target = _fs(spark, path)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    stage, old = hadoop(f"{path}__{uuid.uuid4().hex}"), hadoop(f"{path}.old")
    put_text(spark, stage.toString(), text)
    if fs.exists(target):
        fs.delete(old, True)
        _move(fs, target, old)
    _move(fs, stage, target)
    fs.delete(old, True)


def save_state(spark: SparkSession, path: str, state: dict) -> None:
    publish_text(spark, path, json.dumps(state, sort_keys=True))


def load_state(spark: SparkSession, path: str) -> dict:
    """The state, or that before it where a crash came between; {} where there is none."""
    for place in (path, f"{path}.old"):
        if exists(spark, place):
            return json.loads(get_text(spark, place))
    return {}


def update_state(spark: SparkSession, path: str, change) -> dict:
    """``change`` gets the state and returns the new one."""
    state = change(load_state(spark, path))
    save_state(spark, path, state)
    return state


def delete_state(spark: SparkSession, path: str) -> None:
    for place in (path, f"{path}.old"):
        delete(spark, place)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def table_files(spark: SparkSession, path: str, table: str, by: str = "dt") -> DataFrame:
    """table, dt, file, bytes, rows of a Parquet table's files. The listing and the row counts are Spark's."""
    found = spark.read.option("basePath", path).parquet(path)
    rows = found.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"),
        F.col(by).cast("date").alias("dt")).agg(F.count(F.lit(1)).alias("rows"))
    return rows.select(F.lit(table).alias("table"), "dt", "file", "bytes", "rows")
