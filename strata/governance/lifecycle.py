"""Which partitions go cold, and which go."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import readable_size


def plan(partitions: DataFrame, policies: DataFrame, today: str) -> DataFrame:
    """partitions (table, dt) with policies (table, cold_days, keep_days): action and cutoff of each that is due.

    A partition goes once its whole month lies before the cutoff.
    """
    now = F.lit(today).cast("date")
    rows = partitions.join(policies, "table")
    cutoff, cold = F.date_sub(now, F.col("keep_days")), F.date_sub(now, F.col("cold_days"))
    action = F.when(F.last_day("dt") < cutoff, "DROP").when(F.col("dt") < cold, "COLD").otherwise("KEEP")
    return rows.select("table", "dt", action.alias("action"), cutoff.alias("cutoff")).where("action <> 'KEEP'")


def apply(planned: DataFrame, drop, dry_run: bool = True, cold=None) -> DataFrame:
    """An audit row per planned partition: ``drop(table, dt)`` is called for those that go, ``cold(table, dt)`` for
    those that go cold; without it, or in a dry run, they are skipped.

    The plan has a row per partition of the catalogue, which the driver acts on one by one.
    """
    audit, acts = [], {"DROP": drop, "COLD": cold}
    for row in planned.toLocalIterator():
        status, error, act = "SKIPPED", None, acts.get(row["action"])
        if not dry_run and act:
            try:
                act(row["table"], row["dt"])
                status = "APPLIED"
            except Exception as e:
                status, error = "FAILED", str(e)[:500]
        audit.append((row["table"], row["dt"], row["action"], status, error))
    return planned.sparkSession.createDataFrame(audit, "table string, dt date, action string, status string, error string")


def partition_usage(files: DataFrame) -> DataFrame:
    """From a listing (table, dt, bytes, rows): what each table holds."""
    return files.groupBy("table").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"),
        F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"))


def usage_view(usage: DataFrame) -> DataFrame:
    """Usage for reading: the largest tables first."""
    return usage.withColumn("size", readable_size(F.col("bytes"))).orderBy(F.desc("bytes"), "table")
