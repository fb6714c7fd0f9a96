"""What the catalogue and the files of tables say, and lifecycle acts on their folders."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import lake
from strata.sources.raw import exists
from strata.sources.rolling import file_system
from strata.sources.swap import folder_of

TABLES = "table string, format string, location string, partitioned_by array<string>"
COLUMNS = "table string, position int, column string, type string, nullable boolean, partition boolean"


def tables(spark: SparkSession, database: str = "default") -> DataFrame:
    """A row per table of a database: its format, location and partition columns. A catalogue's metadata, table by table."""
    rows = []
    for t in spark.catalog.listTables(database):
        if t.isTemporary:
            continue
        said = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED `{database}`.`{t.name}`").collect()}
        parts = [c.name for c in spark.catalog.listColumns(f"`{database}`.`{t.name}`") if c.isPartition]
        rows.append((f"{database}.{t.name}", said.get("Provider"), said.get("Location"), parts))
    return spark.createDataFrame(rows, TABLES)


def columns(spark: SparkSession, database: str = "default") -> DataFrame:
    """A row per column of the tables of a database."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    rows = [(f"{database}.{n}", k, c.name, c.dataType, c.nullable, c.isPartition) for n in names
        for k, c in enumerate(spark.catalog.listColumns(f"`{database}`.`{n}`"), 1)]
    return spark.createDataFrame(rows, COLUMNS)


def files(spark: SparkSession, path: str, table: str, by: str = "dt") -> DataFrame:
    """table, dt, file, bytes, rows of a Parquet table's files: Spark lists them, and tasks read their footers alone."""

    def footers(batches):
        for batch in batches:
            rows = []
            for file in batch.column(0).to_pylist():
                store, where = file_system(file)
                with store.open_input_file(where) as content:
                    rows.append(pq.read_metadata(content).num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64())], names=[*batch.schema.names, "rows"])

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    listed = listed.select(F.regexp_replace("path", "^file:/+", "/").alias("file"), F.col("length").alias("bytes"))
    listed = listed.mapInArrow(footers, "file string, bytes long, rows long")
    value = F.url_decode(F.nullif(F.regexp_extract("file", rf"/{by}=([^/]*)/", 1), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return listed.select(F.lit(table).alias("table"), value.try_cast("date").alias("dt"), "file", "bytes", "rows")


PLAN = "run string, table string, dt date, action string, folder string, target string"
AUDIT = "run string, table string, dt date, action string, status string, error string"


def with_folders(spark: SparkSession, planned: DataFrame, locations: dict[str, str], cold: str | None = None, by: str = "dt") -> DataFrame:
    """A lifecycle plan (table, dt, action) with the folder of each partition, and where it goes if it goes cold."""
    name = folder_of(spark, by, "DAY")
    folder = F.regexp_replace(F.lit(name), "DAY", F.col("dt").cast("string"))
    at = spark.createDataFrame(list(locations.items()), "table string, location string")
    rows = planned.join(at, "table").select("table", "dt", "action", F.concat_ws("/", "location", folder).alias("folder"), folder.alias("name"))
    target = F.when(F.col("action") == "COLD", F.concat_ws("/", F.lit(cold), "table", "name")) if cold else F.lit(None).cast("string")
    return rows.select("table", "dt", "action", "folder", target.alias("target"))


def _done(run: str, table: str, dt, action: str, folder: str, target: str | None) -> tuple[str, str | None]:
    """Drops or moves one folder. What is done already is done: a task may run twice, and a run may be taken up again."""
    try:
        store, where = file_system(folder)
        there = store.get_file_info(where).type == fs.FileType.Directory
        if action == "DROP":
            if there:
                store.delete_dir(where)
        elif target is None:
            return "SKIPPED", None
        else:
            other, to = file_system(target)
            if there:
                stage = f"{to}__{run}"
                if other.get_file_info(stage).type == fs.FileType.Directory:
                    other.delete_dir(stage)
                other.create_dir(stage, recursive=True)
                fs.copy_files(where, stage, source_filesystem=store, destination_filesystem=other)
                if other.get_file_info(to).type == fs.FileType.Directory:
                    other.delete_dir(to)
                other.move(stage, to)
                store.delete_dir(where)
            elif other.get_file_info(to).type != fs.FileType.Directory:
                return "FAILED", f"{folder} is not there"
        return "APPLIED", None
    except Exception as error:
        return "FAILED", str(error)[:500]


def act(planned: DataFrame, journal: str, dry_run: bool = True) -> DataFrame:
    """Drops and moves the folders of a plan (of ``with_folders``), in tasks; an audit row for each.

    The plan is written to the journal before anything is touched, the audit after. ``resume`` takes up what a crash has
    left between the two. Moves copy first, so an interrupted one leaves the old folder. A dry run touches nothing.
    """
    spark, run = planned.sparkSession, uuid.uuid4().hex
    if dry_run:
        return planned.select(F.lit(run).alias("run"), "table", "dt", "action", F.lit("SKIPPED").alias("status"), F.lit(None).cast("string").alias("error"))
    planned.select(F.lit(run).alias("run"), "table", "dt", "action", "folder", "target").write.parquet(f"{journal}/plan/run={run}")
    return _act(spark, journal, run)


def _act(spark: SparkSession, journal: str, run: str) -> DataFrame:
    def work(batches):
        for batch in batches:
            found = [_done(*row.values()) for row in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([s for s, _ in found], pa.string()), pa.array([e for _, e in found], pa.string())],
                names=["run", "table", "dt", "action", "status", "error"])

    plan = spark.read.schema(PLAN).parquet(f"{journal}/plan/run={run}")
    parts = max(1, min(plan.count(), 4 * spark.sparkContext.defaultParallelism))
    plan.repartition(parts).mapInArrow(work, AUDIT).write.mode("overwrite").parquet(f"{journal}/audit/run={run}")
    return spark.read.schema(AUDIT).parquet(f"{journal}/audit/run={run}")


def resume(spark: SparkSession, journal: str) -> list[str]:
    """Takes up the runs whose plan is written and whose audit is not; returns them."""
    store, _ = lake._fs(spark, journal)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    runs = [s.getPath().getName().split("=")[1] for s in store.globStatus(hadoop(f"{journal}/plan/run=*")) or ()]
    left = [r for r in runs if exists(spark, f"{journal}/plan/run={r}/_SUCCESS") and not exists(spark, f"{journal}/audit/run={r}/_SUCCESS")]
    for run in left:
        _act(spark, journal, run)
    return left
