"""Lineage over an edge table (source, target)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import checkpointed


def direct(edges: DataFrame, table: str, down: bool = True) -> DataFrame:
    a, b = ("source", "target") if down else ("target", "source")
    return edges.where(F.col(a) == table).select(F.col(b).alias("table")).distinct()


def reachable(edges: DataFrame, table: str, down: bool = True) -> DataFrame:
    """Tables that are reached from one, with the fewest steps. The table itself is among them only on a cycle.

    The edges are written once; each step joins what was new in the last one with them and leaves out what is known,
    so cycles end and a search is as deep as its longest way. Nothing but the question whether a step found anything
    comes to the driver.
    """
    a, b = ("source", "target") if down else ("target", "source")
    links = checkpointed(edges.select(F.col(a).cast("string").alias("u"), F.col(b).cast("string").alias("table")).where("table is not null").distinct())
    front = links.sparkSession.createDataFrame([(table,)], "u string")
    found, n = links.limit(0).select("table", F.lit(0).alias("steps")), 0
    while True:
        n += 1
        new = links.join(front, "u", "left_semi").select("table").distinct().join(found, "table", "left_anti")
        new = checkpointed(new.withColumn("steps", F.lit(n)))
        if new.isEmpty():
            return found
        found, front = found.unionByName(new), new.select(F.col("table").alias("u"))


def tables(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("source", "target")).alias("table")).distinct()


def column_rows(edges: DataFrame) -> DataFrame:
    """One row per declared column pair; ``columns`` is an array of struct<from,to>."""
    rows = edges.select("source", "target", F.explode_outer("columns").alias("c"))
    return rows.select("source", "target", F.col("c.from").alias("source_column"), F.col("c.to").alias("target_column"), F.lit("DECLARED").alias("origin"))
