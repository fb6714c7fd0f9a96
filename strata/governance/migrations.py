"""Versioned migrations: named scripts that run once each, in order, with a history that later runs check."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources import lake
from strata.sources.raw import exists

HISTORY = "version int, name string, checksum string, success boolean, error string, run bigint"


@dataclass(frozen=True)
class Migration:
    version: int
    name: str
    statements: tuple[str, ...]

    @property
    def checksum(self) -> str:
        return hashlib.sha256("\n".join(s.strip() for s in self.statements).encode()).hexdigest()


def load(scripts: dict[str, list[str]]) -> list[Migration]:
    """Migrations from statements by file name (V3__what_it_does.sql), by version; a version may occur once."""
    found = []
    for file, statements in scripts.items():
        parts = re.fullmatch(r"V(\d+)__(\w+)\.sql", file)
        if not parts:
            raise ValueError(f"{file} is no migration")
        found.append(Migration(int(parts[1]), parts[2], tuple(statements)))
    versions = [m.version for m in found]
    if len(set(versions)) < len(versions):
        raise ValueError("a version occurs twice")
    return sorted(found, key=lambda m: m.version)


def history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(HISTORY).parquet(path) if exists(spark, f"{path}/*") else spark.createDataFrame([], HISTORY)


def state(runs: DataFrame) -> DataFrame:
    """version, checksum, success of each version's last run."""
    last = F.max_by(F.struct("checksum", "success"), "run").alias("last")
    return runs.groupBy("version").agg(last).select("version", "last.checksum", "last.success").orderBy("version")


def pending(migrations: list[Migration], runs: DataFrame) -> list[Migration]:
    """What has not succeeded yet.

    Raises ValueError if a script that ran has changed since, or if one that has not is older than one that has.
    """
    done = {r["version"]: r["checksum"] for r in state(runs).where("success").collect()}  # a row per migration
    for m in migrations:
        if m.version in done and done[m.version] != m.checksum:
            raise ValueError(f"V{m.version} has changed since it ran")
    left = [m for m in migrations if m.version not in done]
    if left and done and left[0].version < max(done):
        raise ValueError(f"V{left[0].version} is older than V{max(done)}, which has run")
    return left


def migrate(spark: SparkSession, migrations: list[Migration], path: str, dry_run: bool = False) -> list[int]:
    """Runs what is pending by version, keeps a row of history for each, and stops at the first that fails."""
    runs = history(spark, path)
    left = pending(migrations, runs)
    if dry_run:
        return [m.version for m in left]
    number = (runs.agg(F.max("run")).first()[0] or 0) + 1
    ran = []
    for m in left:
        error = None
        try:
            for statement in m.statements:
                spark.sql(statement)
        except Exception as e:
            error = str(e)[:500]
        lake.append(spark.createDataFrame([(m.version, m.name, m.checksum, error is None, error, number)], HISTORY).coalesce(1), path)
        if error:
            raise RuntimeError(f"V{m.version} failed: {error}")
        ran.append(m.version)
    return ran
