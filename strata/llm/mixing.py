"""Mixing sources to target weights by a splitting tree of exact block quotas.

The documents of a source are dealt by keyed hash to blocks of about ``docs_per_block`` documents, or of more where
that would be too many blocks, and the blocks are permuted. A mix reads the permuted blocks from the front, as often as
the target asks, so every source has an exact quota of blocks. A tree then splits the quotas among the output shards:
each node draws, by the multivariate hypergeometric law, which of its blocks go to its left half, so that a shard's
composition is that of a random deal, while the quotas of all shards add up exactly. Shards take disjoint runs of the
permuted blocks and shuffle locally by a keyed hash: ``write_shards`` writes them in that order.

What the driver holds is one row per source (targets) and one number per source and shard (quotas): the mix's
recipe, which names its sources and which the number of documents does not change. There are at most ``MOST_BLOCKS``
blocks in all, so their table is broadcast, and only the documents of the block in which a source's target falls are
compared one by one: a mix moves each document's text once, to its shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import WORD, settled, text_of

#: Weights of the sources by code point, null last; they repeat.
WEIGHTS = (5, 2, 1)
#: Of all sources together: what bounds the broadcast table of blocks.
MOST_BLOCKS = 1 << 18


def source_targets(sizes: list[int], weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, most: int = 3) -> list[float]:
    """Targets that add up to ``share`` of all sizes; none is above ``most`` times its source's size.

    The excess of capped sources is shared anew by weight among the others until none is above.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    total, capped = share * sum(sizes), {}
    while len(capped) < len(sizes):
        open_ = [i for i in range(len(sizes)) if i not in capped]
        rest, weigh = total - sum(capped.values()), sum(weight[i] for i in open_)
        target = {i: rest * weight[i] / weigh for i in open_}
        above = [i for i in open_ if target[i] > most * sizes[i]]
        if not above:
            return [float(capped.get(i, target.get(i, 0.0))) for i in range(len(sizes))]
        capped |= {i: float(most * sizes[i]) for i in above}
    return [float(capped[i]) for i in range(len(sizes))]


def split_quotas(quotas: list[int], shards: int, seed: int) -> np.ndarray:
    """Shards x sources: how many blocks of each source each shard takes."""
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(lo: int, hi: int, blocks: np.ndarray) -> None:
        if hi - lo == 1:
            out[lo] = blocks
            return
        mid = (lo + hi) // 2
        left = int(blocks.sum()) * (mid - lo) // (hi - lo)
        drawn = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(blocks, left, method="marginals")
        split(lo, mid, drawn)
        split(mid, hi, blocks - drawn)

    split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def keyed(docs: DataFrame, seed: int, id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """The columns that a mix needs of a document."""
    return {"id": F.col(id_col), "source": F.col(source_col).cast("string"), "size": F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long"),
        "h": F.xxhash64(F.lit(seed), F.col(id_col), text_of(text_col))}


def placed_blocks(meta: DataFrame, shards: int, seed: int, most: int, weights: tuple[float, ...], share: float, docs_per_block: int) -> DataFrame:
    """One row per block: src, blk, n_blocks, source_size, target, block_start, block_end, places (the shard of the
    block's draw in each pass), runs (whether a pass takes the block whole, in part or not: 1, 2, 0).
    """
    spark = meta.sparkSession
    seen = meta.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect()  # a row per source
    seen = sorted(seen, key=lambda r: (r["source"] is None, r["source"] or ""))
    targets = source_targets([r["size"] for r in seen], weights, share, most)
    most_of_one = max(1, MOST_BLOCKS // max(1, len(seen)))
    recipe_type = T.StructType([T.StructField("src", T.StringType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("n_blocks", T.LongType())])
    recipe = spark.createDataFrame([(r["source"], r["size"], t, min(most_of_one, -(-r["n"] // docs_per_block))) for r, t in zip(seen, targets, strict=True)],
        recipe_type)
    rows = meta.join(F.broadcast(recipe), meta["source"].eqNullSafe(recipe["src"])).withColumn("blk", F.pmod("h", "n_blocks"))
    blocks = rows.groupBy("src", "blk", "n_blocks", "source_size", "target").agg(F.sum("size").alias("words"))
    permuted = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed), "src", "blk"), "blk")
    blocks = blocks.withColumns({"rank": F.row_number().over(permuted) - 1,
        "block_end": F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, 0)), "n_ranks": F.count(F.lit(1)).over(Window.partitionBy("src"))})
    blocks = settled(blocks.withColumn("block_start", F.col("block_end") - F.col("words")))
    drawn = sum((F.when(k * F.col("source_size") + F.col("block_start") < F.col("target"), 1).otherwise(0) for k in range(most)), F.lit(0))
    quota = {r["src"]: r["q"] for r in blocks.groupBy("src").agg(F.sum(drawn).alias("q")).collect()}
    bounds = np.cumsum(split_quotas([quota.get(r["source"], 0) for r in seen], shards, seed), axis=0) if seen else np.zeros((shards, 0))
    runs_type = T.StructType([T.StructField("r_src", T.StringType()), T.StructField("bounds", T.ArrayType(T.LongType()))])
    runs = spark.createDataFrame([(r["source"], [int(x) for x in bounds[:, i]]) for i, r in enumerate(seen)], runs_type)
    blocks = blocks.join(F.broadcast(runs), blocks["src"].eqNullSafe(runs["r_src"]))
    shard = lambda k: F.size(F.filter("bounds", lambda b: b <= k * F.col("n_ranks") + F.col("rank")))
    run = lambda k: F.when(k * F.col("source_size") + F.col("block_end") <= F.col("target"),
        1).when(k * F.col("source_size") + F.col("block_start") <= F.col("target"), 2).otherwise(0)
    return settled(blocks.select("src", "blk", "n_blocks", "source_size", "target", "block_start", F.array(*[shard(k) for k in range(most)]).alias("places"),
        F.array(*[run(k) for k in range(most)]).alias("runs")))


def mix(docs: DataFrame, shards: int = 64, seed: int = 7, most: int = 3, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0, docs_per_block: int = 256,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, size (words), source_size, target (its source's), copies, shards (one a copy).

    A source takes its documents in permuted order up to its target: the copy of a document is taken if more than
    half of it lies before the target, so a source's words differ from its target by half a document at most.
    Null texts have size 0, null is a source of its own, a source without words has target 0. Repeated rows count
    each. An empty table gives no rows. Texts of any length are counted whole. ``keep`` names columns of ``docs`` to
    carry along, as keep_NAME; other columns are ignored, whatever their names.
    """
    own = keyed(docs, seed, id_col, text_col, source_col)
    meta = settled(docs.select(*[c.alias(k) for k, c in own.items()]))
    places = placed_blocks(meta, shards, seed, most, weights, share, docs_per_block)
    rows = docs.select(*[c.alias(k) for k, c in own.items()], *[F.col(c).alias(f"keep_{c}") for c in keep]) if keep else meta
    sources = F.broadcast(places.select(F.col("src").alias("of"), "n_blocks").distinct())
    rows = rows.join(sources, rows["source"].eqNullSafe(F.col("of"))).withColumn("block", F.pmod("h", "n_blocks")).drop("of", "n_blocks")
    rows = rows.join(F.broadcast(places.drop("n_blocks")), rows["source"].eqNullSafe(F.col("src")) & (F.col("block") == F.col("blk")))
    # Only where a target falls into a block does the order of its documents count.
    part = F.array_contains("runs", 2)
    order = Window.partitionBy("source", "block").orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("block_start") + F.sum("size").over(order) - F.col("size") / 2
    whole = F.size(F.filter("runs", lambda r: r == 1))
    some = sum((F.when(k * F.col("source_size") + F.col("middle") <= F.col("target"), 1).otherwise(0) for k in range(most)), F.lit(0))
    rows = rows.where(~part).withColumn("copies", whole).unionByName(rows.where(part).withColumn("middle", middle).withColumn("copies", some).drop("middle"))
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies", F.slice("places", F.lit(1), F.col("copies")).alias("shards"),
        *[f"keep_{c}" for c in keep or []])


def mixed_rows(docs: DataFrame, seed: int = 7, copy_col: str | None = None, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, a row for each copy taken, with mix_shard and mix_place in it, and the
    number of the document's copy, from 0, as ``copy_col`` if that is asked for.

    Columns of ``docs`` with these names, or __copy, are left out for the operator's own. Rules for nulls and
    repeated rows are those of mix().
    """
    columns = [c for c in docs.columns if c not in ("mix_shard", "mix_place", "__copy", copy_col)]
    planned = mix(docs, seed=seed, keep=columns, **options)
    id_col = options.get("id_col", "doc_id")
    taken = planned.select(*[F.col(f"keep_{c}").alias(c) for c in columns], F.posexplode("shards").alias("__copy", "mix_shard"))
    taken = taken.withColumn("mix_place", F.xxhash64(F.lit(seed), "mix_shard", "__copy", id_col))
    return taken.withColumnRenamed("__copy", copy_col) if copy_col else taken.drop("__copy")


def parts_for(docs: DataFrame, shards: int, text_col: str = "text", part_bytes: int = 256 << 20) -> int:
    """In how many parts a shard of a mix of ``docs`` is about ``part_bytes`` large or less: a mix has about as many words as its documents."""
    held = docs.agg(F.sum(F.octet_length(text_of(text_col)))).first()[0] or 0
    return max(1, -(-held // (shards * part_bytes)))


def in_shards(mixed: DataFrame, parts: int = 1, shards: int | None = None) -> DataFrame:
    """The rows of mixed_rows() dealt to their shards and shuffled there, by place. A shard that is too large for one
    task takes several ``parts``, each shuffled. With ``shards`` (their number) each part of each is a partition of its
    own, in their order; else several may share one.
    """
    part = F.pmod("mix_place", F.lit(parts)).cast("int")
    dealt = mixed.repartitionById(shards * parts, F.col("mix_shard") * parts + part) if shards else mixed.repartition("mix_shard", part)
    return dealt.sortWithinPartitions("mix_shard", "mix_place")


def write_shards(docs: DataFrame, path: str, parts: int = 1, **options) -> None:
    """Writes the mix of ``docs`` as Parquet, a folder per shard, each in its shuffled order."""
    in_shards(mixed_rows(docs, **options), parts).write.partitionBy("mix_shard").parquet(path)
