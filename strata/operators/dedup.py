"""Which of several rows stays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first by ``order``, which has to be total for a result that can be repeated.

    Aggregates before the shuffle, so a hot key costs one row a task.
    """
    # The order's columns are those that max_by compares: latest first.
    picked = F.max_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(picked.alias("row")).select("row.*")


def replacing(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row with the largest version of each key; of equal versions the largest row."""
    return latest(df, keys, F.col(version), *[F.col(c) for c in df.columns if c not in keys and c != version])


def content_changes(df: DataFrame, key: list[str], order: list[str], content: str) -> DataFrame:
    """Rows whose content differs from that of the key's row before; rows without content all stay."""
    none = F.coalesce(F.col(content), F.lit("")) == ""
    # A row without content leaves the last content as it was.
    known = F.last(F.nullif(F.col(content), F.lit("")),
        ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__before", known).where(none | F.col("__before").isNull() | (F.col("__before") != F.col(content))).drop("__before")
