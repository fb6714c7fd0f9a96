"""Partitions of a table replaced together: staged, swapped by renames, and put back if that does not end well.

A swap lives in a folder ``_swap-ID`` of the table, which readers don't see: ``new`` has the staged partitions, ``old``
those that were moved aside, ``journal`` names all of them before the first rename, and ``done`` says that all renames
are through. Whatever ends a swap in between, ``recover`` makes the table what it was before, or after if ``done`` is
there. There is one writer at a time; while partitions are renamed, a reader may see some of both.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import lake
from strata.sources.raw import exists


def folder_of(spark: SparkSession, column: str, value: str | None) -> str:
    """The name of a partition's folder, escaped as Spark's writer does it."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(column, value)


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def _folders(spark: SparkSession, path: str, pattern: str) -> list[str]:
    fs, _ = lake._fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.globStatus(_path(spark, path, pattern)) or ())


def partitions(spark: SparkSession, path: str, column: str) -> list[str]:
    """The folders of a table's partitions."""
    return _folders(spark, path, f"{column}=*")


def recover(spark: SparkSession, path: str) -> int:
    """Ends the swaps that a crash has left: those that were through are tidied up, others are undone. Returns how many."""
    left = _folders(spark, path, "_swap-*")
    for name in left:
        home = f"{path}/{name}"
        if exists(spark, f"{home}/journal") and not exists(spark, f"{home}/done"):
            _undo(spark, path, home, json.loads(lake.get_text(spark, f"{home}/journal")))
        lake.delete(spark, home)
    return len(left)


def _undo(spark: SparkSession, path: str, home: str, names: list[str]) -> None:
    fs, _ = lake._fs(spark, path)
    for name in reversed(names):
        here, old, new = (_path(spark, x, name) for x in (path, f"{home}/old", f"{home}/new"))
        staged = name in _staged(spark, home)
        if fs.exists(here) and not fs.exists(new) and staged:  # it came from the stage
            lake._move(fs, here, new)
        if fs.exists(old):
            lake._move(fs, old, here)


def _staged(spark: SparkSession, home: str) -> set[str]:
    return set(json.loads(lake.get_text(spark, f"{home}/staged")))


def _exchange(spark: SparkSession, path: str, home: str, names: list[str]) -> None:
    """Moves the partitions aside and the staged ones in. An error undoes all of it."""
    fs, target = lake._fs(spark, path)
    fs.mkdirs(target)
    for folder in {n.rpartition("/")[0] for n in names} | {""}:
        for sub in (f"{home}/old", f"{home}/new", path):
            fs.mkdirs(_path(spark, *filter(None, (sub, folder))))
    staged = [n for n in names if fs.exists(_path(spark, home, "new", n))]
    lake.put_text(spark, f"{home}/staged", json.dumps(staged))
    lake.put_text(spark, f"{home}/journal", json.dumps(names))
    try:
        for name in names:
            here = _path(spark, path, name)
            if fs.exists(here):
                lake._move(fs, here, _path(spark, home, "old", name))
            if name in staged:
                lake._move(fs, _path(spark, home, "new", name), here)
        lake.put_text(spark, f"{home}/done", "")
    except Exception:
        _undo(spark, path, home, names)
        lake.delete(spark, home)
        raise
    lake.delete(spark, home)


def replace_partitions(df: DataFrame, path: str, by: str = "dt", also: list[str | None] | None = None) -> list[str]:
    """Replaces the partitions that df has, and those of the values ``also``, which go if df has no rows for them.
    Returns the folders of both. df may read the table.
    """
    spark = df.sparkSession
    recover(spark, path)
    home = f"{path}/_swap-{uuid.uuid4().hex}"
    try:
        df.write.partitionBy(by).parquet(f"{home}/new")
        names = {*partitions(spark, f"{home}/new", by), *(folder_of(spark, by, v) for v in also or ())}
        _exchange(spark, path, home, sorted(names))
        return sorted(names)
    finally:
        if exists(spark, home) and not exists(spark, f"{home}/journal"):  # else recover() has to look at it
            lake.delete(spark, home)


def take_partitions(spark: SparkSession, staging: str, path: str, by: str = "dt", values: list[str | None] | None = None) -> list[str]:
    """Replaces partitions by those of a staging table, moved where one rename can do it, else copied. The staging table
    keeps what it had where it was copied. ``values``: all of its partitions if none are named; those that it has not are left alone.
    """
    found = partitions(spark, staging, by)
    names = [n for n in found if values is None or n in {folder_of(spark, by, v) for v in values}]
    recover(spark, path)
    home = f"{path}/_swap-{uuid.uuid4().hex}"
    fs, _ = lake._fs(spark, staging)
    own, _ = lake._fs(spark, path)
    own.mkdirs(_path(spark, home, "new"))
    moved: list[str] = []
    try:
        for name in names:
            if fs.getUri().equals(own.getUri()):
                lake._move(fs, _path(spark, staging, name), _path(spark, home, "new", name))
                moved.append(name)
            else:
                spark.read.parquet(f"{staging}/{name}").write.parquet(f"{home}/new/{name}")
        _exchange(spark, path, home, names)
        return names
    except Exception:
        for name in moved:
            if own.exists(_path(spark, home, "new", name)):
                lake._move(own, _path(spark, home, "new", name), _path(spark, staging, name))
        raise
    finally:
        if exists(spark, home) and not exists(spark, f"{home}/journal"):
            lake.delete(spark, home)


def _below(spark: SparkSession, root: str, file: str) -> str:
    """A file's name below a folder, however the two spell their file system."""
    qualified = lambda p: lake._fs(spark, p)[0].makeQualified(_path(spark, p)).toUri().getPath()
    return qualified(file)[len(qualified(root)) + 1 :]


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20, by: str | None = None) -> int:
    """Merges the small files of each folder (those below half of ``target_bytes``, where there are two or more) and
    swaps the merged ones for them; other files stay as they are. Returns how many files went.

    Merged files have about the session's advisory partition size. Names of files come to the driver, which moves them.
    """
    recover(spark, path)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    small = listed.where(F.col("length") < target_bytes // 2).groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1)).agg(F.collect_list("path").alias("files"))
    files = [f for r in small.where(F.size("files") > 1).select("files").toLocalIterator() for f in r["files"]]
    if not files:
        return 0
    home = f"{path}/_swap-{uuid.uuid4().hex}"
    try:
        rows = spark.read.option("basePath", path).parquet(*files)
        if by:
            rows.hint("rebalance", by).write.partitionBy(by).parquet(f"{home}/new")
        else:
            rows.hint("rebalance").write.parquet(f"{home}/new")
        merged = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{home}/new")
        new = [_below(spark, f"{home}/new", r["path"]) for r in merged.select("path").toLocalIterator()]
        _exchange(spark, path, home, sorted([*(_below(spark, path, f) for f in files), *new]))
        return len(files)
    finally:
        if exists(spark, home) and not exists(spark, f"{home}/journal"):
            lake.delete(spark, home)


def replace_window(spark: SparkSession, path: str, incoming: DataFrame, column: str, start: str, end: str, by: str = "dt") -> list[str]:
    """The rows of a table whose ``column`` lies in [start, end] go, and incoming comes. Only partitions with such rows
    or with new ones are read and written. Returns their folders.
    """
    recover(spark, path)
    had = exists(spark, f"{path}/{by}=*")
    existing = spark.read.schema(incoming.schema).parquet(path) if had else incoming.limit(0)
    inside = F.coalesce(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")), F.lit(False))
    touched = existing.where(inside).select(F.col(by).cast("string")).union(incoming.select(F.col(by).cast("string"))).distinct()
    values = [r[0] for r in touched.collect()]  # a value per partition of the window
    old = existing.where(F.col(by).cast("string").isin([v for v in values if v is not None]) | (F.col(by).isNull() if None in values else F.lit(False)))
    return replace_partitions(old.where(~inside).unionByName(incoming), path, by, also=values)
