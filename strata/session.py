"""The session that the engine expects."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app: str = "strata", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings. On a cluster leave master and shuffle_partitions to its defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return builder.config(map=CONF | conf).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all machines share: ``spark.checkpoint.dir``.

    A session on one machine (tests) that has none gets a temporary folder; a cluster has to name one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """df, written to the shared folder, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
