"""Small helpers that the training-data operators share."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpointed, shared_folder

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def name_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that the cluster shares: ``spark.checkpoint.dir``; only a session on one machine
    (tests) may have none, and gets a temporary one.
    """
    return shared_folder(spark)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    return checkpointed(df)


def tidy(spark: SparkSession) -> None:
    """Spark deletes the shuffles and checkpoints of plans that nothing refers to when the driver's garbage is collected,
    which a small driver of large jobs seldom does by itself: searches in many turns ask for it.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """df written and its lineage cut; what was shuffled for it is deleted before the next step shuffles."""
    out = cut(df)
    del df  # its plan holds on to the shuffles
    tidy(out.sparkSession)
    return out


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def salt_of(salts: int, *columns: str | Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], salts: int, spread: list[str], how: str = "left") -> DataFrame:
    """Join with ``small`` repeated ``salts`` times, so that a hot key of ``big`` is dealt to as many tasks.

    ``small`` has at most one row a key; ``spread`` are columns of ``big`` that differ inside a key.
    Keys join null-safe.
    """
    left = big.withColumn("__salt", salt_of(salts, *spread))
    right = small.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in small.columns if c not in keys],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__rsalt"))
    on = F.col("__salt") == F.col("__rsalt")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(right, on, how).drop("__salt", "__rsalt", *[f"__{k}" for k in keys])


def best(rows: DataFrame, group: list[str], order: list[str | Column], k: int, salts: int = 64) -> DataFrame:
    """The first k rows of each group with their ``rank``. The best of some tasks' rows meet before those of all."""
    some = rows.withColumn("__some", F.pmod(F.spark_partition_id(), F.lit(salts)))
    for keys in ([*group, "__some"], group):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return some.drop("__some")


#: Words of 64 bits in a bitmap of keys: it has at most so many rows, however many keys there are.
BITMAP_WORDS = 1 << 20


def _bit(*key: str | Column) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(64 * BITMAP_WORDS))


def bitmap(keys: DataFrame, *key: str | Column) -> DataFrame:
    """The hashes of the keys as bits: __word, __bits, of at most BITMAP_WORDS rows, which bounds its broadcast."""
    at = _bit(*key)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    return keys.select(F.shiftright(at, 6).alias("__word"), one.alias("__one")).groupBy("__word").agg(F.bit_or("__one").alias("__bits"))


def free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it that no column of docs has it, whatever its case."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def with_maybe(docs: DataFrame, bits: DataFrame, *key: str | Column, maybe: str = "__maybe") -> DataFrame:
    """docs with ``maybe``: false if the key is not in the bitmap. No row is shuffled for that.

    Beyond some ten million keys more and more rows may be in it, so an exact join has to follow; the bitmap only
    saves the rows that it leaves out from taking part in that.
    """
    at, word, held = free(docs, "__at", "__word", "__bits")
    joined = docs.withColumn(at, _bit(*key)).join(F.broadcast(bits.toDF(word, held)), F.shiftright(at, 6) == F.col(word), "left")
    return joined.withColumn(maybe, F.coalesce(F.getbit(held, (F.col(at) % 64).cast("int")) == 1, F.lit(False))).drop(at, word, held)


def _renamed(docs: DataFrame, wanted: DataFrame, keys: dict[str, Column]) -> tuple[DataFrame, Column]:
    """The keys of ``wanted`` under names that docs does not have, and the null-safe condition."""
    names = free(docs, *[f"__w_{k}" for k in keys])
    same = F.lit(True)
    for name, own in zip(names, keys.values(), strict=True):
        same = same & own.eqNullSafe(F.col(name))
    return wanted.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]), same


def rows_in(docs: DataFrame, wanted: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of docs whose keys (expressions by the name of their column in ``wanted``) are in ``wanted``, null-safe."""
    [maybe] = free(docs, "__maybe")
    some = with_maybe(docs, bitmap(wanted, *keys), *keys.values(), maybe=maybe).where(F.col(maybe)).drop(maybe)
    return some.join(*_renamed(docs, wanted, keys), "left_semi")


def rows_not_in(docs: DataFrame, unwanted: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The other rows. Those that the bitmap leaves out stay where they are; the rest are compared by a join."""
    [maybe] = free(docs, "__maybe")
    marked = with_maybe(docs, bitmap(unwanted, *keys), *keys.values(), maybe=maybe)
    rest = marked.where(F.col(maybe)).drop(maybe).join(*_renamed(docs, unwanted, keys), "left_anti")
    return marked.where(~F.col(maybe)).drop(maybe).unionByName(rest)
