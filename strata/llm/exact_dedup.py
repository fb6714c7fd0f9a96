"""Exact duplicates by skew-safe combining.

First digests alone are counted, combined in tasks before they are shuffled: a text whose digest occurs once has no
equal. A bitmap of the repeated digests, whose size is bounded, leaves the other texts where they are. Those that may
have an equal meet in three steps, each of which groups by the full text and not by its digest alone:

1. local: every task combines its own equal texts before anything is shuffled,
2. salted: the tasks' rows meet by (digest, salt, text), where the salt comes from the task, so a text that
   holds a third of all rows is merged by many tasks,
3. global: the few salt winners of a text meet by (digest, text).

Documents then look up their group by digest, salted as well. That look-up is exact because step 3 has compared the
full contents under each digest: where one digest covers several texts, their documents join by text as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import bitmap, free, rows_not_in, salted_join, settled, text_of, with_maybe


def sha256_of(text: Column) -> Column:
    return F.sha2(text, 256)


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64, normalise=lambda t: t, digest=sha256_of) -> DataFrame:
    """One row per distinct text: digest, text, keep_id (largest id), group_size."""
    rows = docs.select(F.col(id_col).alias("id"), normalise(text_of(text_col)).alias("text"))
    rows = rows.select("id", "text", digest(F.col("text")).alias("digest"), F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    salted = rows.groupBy("digest", "salt", "text").agg(F.max("id").alias("winner"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "text").agg(F.max("winner").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64, normalise=lambda t: t, digest=sha256_of) -> DataFrame:
    """One row per row of ``docs``: the id, keep_id, group_size, kept, text_digest.

    Of equal (normalised) texts the largest id stays; null ids count as smallest, and a group of null ids
    keeps the null id. A null text is an empty text. Repeated rows count in group_size and share the verdict.
    An empty table gives no rows; other columns are ignored, whatever their names.
    """
    own = digest(normalise(text_of(text_col)))
    rows = settled(docs.select(F.col(id_col).alias("id"), own.alias("digest")))
    repeated = bitmap(rows.groupBy("digest").count().where("count > 1"), "digest")
    maybe = with_maybe(docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias(text_col)), repeated, own).where("__maybe")
    groups = settled(text_groups(maybe, id_col, text_col, salts, normalise, digest).select("digest", "keep_id", "group_size"))
    clashing = groups.groupBy("digest").count().where("count > 1").select("digest")
    several = groups.where("group_size > 1")
    if clashing.isEmpty():
        found = salted_join(rows, several, ["digest"], salts=16, spread=["id"])
    else:  # one digest, several texts: these join by their whole text
        clashing = settled(clashing)
        single = several.join(clashing, "digest", "left_anti")
        full = docs.select(F.col(id_col).alias("id"), normalise(text_of(text_col)).alias("text"))
        full = full.withColumn("digest", digest(F.col("text"))).join(clashing, "digest", "left_semi")
        texts = text_groups(docs, id_col, text_col, salts, normalise, digest).join(clashing, "digest", "left_semi")
        found = salted_join(rows.join(clashing, "digest", "left_anti"), single, ["digest"], salts=16, spread=["id"])
        found = found.unionByName(full.join(texts, ["digest", "text"]).drop("text").select(*found.columns))
    found = found.select("id", "digest", F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"))
    return found.select(F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_digest"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, once each, under the rules of exact_duplicates().

    Only texts that may go, or that repeat under their id, take part in a shuffle. Other columns may have any names.
    """
    found = exact_duplicates(docs, id_col, text_col, salts).select(F.col(id_col).alias("id"), F.col("text_digest").alias("digest"), "kept", "group_size")
    unsettled = settled(found.where("group_size > 1").groupBy("id", "digest").agg(F.min("kept").alias("kept"),
        F.count(F.lit(1)).alias("n")).where("not kept or n > 1"))
    own = {"id": F.col(id_col), "digest": sha256_of(text_of(text_col))}
    maybe, digest = free(docs, "__maybe", "__own")
    marked = with_maybe(docs, bitmap(unsettled, *own), *own.values(), maybe=maybe)
    stay = rows_not_in(marked.where(F.col(maybe)).drop(maybe), unsettled.where("not kept"), own)
    once = stay.withColumn(digest, own["digest"]).dropDuplicates([id_col, digest]).drop(digest)
    return marked.where(~F.col(maybe)).drop(maybe).unionByName(once)
