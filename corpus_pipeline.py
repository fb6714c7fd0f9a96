"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, mixing, SentencePiece encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents, to which the mix adds a row's place in its shards;
columns of other names are left out.

Null and empty texts fail the quality rules, so none comes further; the stages by themselves take them as empty. Null
languages and sources are groups of their own. Rows that repeat an id and its text share a verdict, and the exact
dedup leaves one of them; a null id is an id like any other there, the near-duplicate join keeps its row if no other
document links with it. Texts of any length are taken whole. Of an empty table every stage makes an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import exact_dedup, jaccard, mixing, quality, sentencepiece
from strata.llm.common import name_checkpoint_dir
from strata.llm.queries import PIECES
from strata.sources import lake

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Shards of the mix, and where a row stands in them.
SHARDS = 64
PLACE = ("mix_shard", "mix_place")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go, repeated rows together."""
    return quality.keep_good(docs, **quality.STRICT).select(*COLUMNS)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays, once; null ids count as smallest."""
    return exact_dedup.drop_exact_duplicates(docs).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents, the one with the smallest id stays; one without an id only if it links with nothing."""
    return jaccard.one_per_component(docs).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, up to three times each, shard by shard in the order drawn there.

    mix_shard, mix_place and mix_copy (the document's copies are numbered from 0) say where the mix has put a row.
    """
    rows = mixing.mixed_rows(docs.select(*COLUMNS), shards=SHARDS, copy_col="mix_copy")
    return mixing.in_shards(rows, mixing.parts_for(docs, SHARDS), SHARDS).select(*COLUMNS, *PLACE, "mix_copy")


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, lossless of every document of the mix, and its shard and place, in that order; a document's
    copies are encoded apart. Documents that no mix has placed are numbered here and stay where they are.
    """
    options = {"seed": 2024, "dropout": 0.1, "copy_col": "mix_copy"}
    if {*PLACE, "mix_copy"} <= {*docs.columns}:
        encoded = sentencepiece.encode(docs, PIECES, keep=PLACE, **options)
        return mixing.in_shards(encoded, mixing.parts_for(docs, SHARDS), SHARDS)
    copies = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy(F.lit(0))
    return sentencepiece.encode(docs.withColumn("mix_copy", F.row_number().over(copies) - 1), PIECES, **options)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing", mixture),
    ("SentencePiece encoding", pieces),
]

#: SQL can express neither the concentration steps nor the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over documents. What a stage has written goes once the next has written its own; the last
    one's input stays, as the result is read from it.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{name_checkpoint_dir(spark)}/corpus-{uuid.uuid4()}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                lake.delete(spark, before)
            before = path
    return docs
