"""Shards along a Hilbert curve.

Language, source and size are quantised to five bits each, in their order and by about equal counts; the Hilbert index
of the three puts documents that agree in several of them next to each other, and equal runs of that order become
shards, so that a manifest of each shard's ranges prunes files by any of the dimensions.

The order is never sorted in one place. The curve has 2**15 cells, a bound that does not grow with the data: one
histogram over the cells gives every cell its offset. A cell is dealt by hash to sub-cells of about
``rows_per_task`` rows, so a cell with a third of all rows is ranked by many tasks.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import cut, text_of

BITS, DIMS = 5, 3


def hilbert_index(axes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the Hilbert curve of each row of ``axes`` (rows x dims, each below 2**bits)."""
    x = axes.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the rotations from the coarsest level on
        bit, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            turned = (x[i] & bit) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, dims):  # Gray code
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1, (1 << level) - 1, 0)
    x ^= flip
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


@F.pandas_udf(T.IntegerType())
def curve(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series(hilbert_index(np.stack([a.to_numpy(), b.to_numpy(), c.to_numpy()], axis=1)).astype(np.int32))


def as_number(name: Column) -> Column:
    """The first seven bytes of a name as a number, which keeps their order; null comes first."""
    head = F.substring(name.cast("string").cast("binary"), 1, 7)
    return F.coalesce(F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long"), F.lit(-1).cast("long"))


def cuts_of(docs: DataFrame, names: tuple[str, str]) -> list[list[int]]:
    """For each name, the 31 quantiles of its numbers. A frequent name is several of them, so that its cell and the
    next are as far apart as it has rows.
    """
    at = [k / (1 << BITS) for k in range(1, 1 << BITS)]
    row = docs.agg(*[F.percentile_approx(as_number(F.col(n)), at, 10_000).alias(f"q{k}") for k, n in enumerate(names)]).first()
    return [sorted(q or []) for q in row]


def cell_of(number: Column, cuts: list[int]) -> Column:
    return sum((F.when(number > c, n).otherwise(0) for c, n in Counter(cuts).items()), F.lit(0)).cast("int")


def log_cell(size: Column) -> Column:
    """Sixteenths of an octave: at most 1008 cells for any size that a long can hold."""
    return F.floor(F.log2(size.cast("double")) * 16).cast("int")


def hilbert_shards(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", names: tuple[str, str] = ("lang", "source"),
    rows_per_task: int = 1000) -> DataFrame:
    """One row per document: id, size (UTF-8 bytes plus 1), text_crc32, name_a, name_b, curve cell, shard, slot.

    Row counts of shards differ by one at most; slots of a shard run from 0 without gaps. Null texts have size 1,
    null names a cell of their own. Rows that repeat are told apart by nothing and take neighbouring slots.
    Names are quantised by quantiles of their first bytes, sizes by equal counts over the exact histogram of their
    logarithms. Texts are read whole; other columns are ignored, whatever their names.
    """
    text = text_of(text_col)
    meta = docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("crc"),
        F.col(names[0]).cast("string").alias("name_a"), F.col(names[1]).cast("string").alias("name_b"))
    meta = cut(meta.withColumn("log", log_cell(F.col("size"))))
    first, second = cuts_of(meta, ("name_a", "name_b"))
    seen = sorted((r["log"], r["count"]) for r in meta.groupBy("log").count().collect())  # at most 1008 rows
    total, before, cells = sum(n for _, n in seen), 0, []
    for log, n in seen:
        cells += [F.lit(log), F.lit(min((1 << BITS) - 1, (before + n // 2) * (1 << BITS) // max(total, 1)))]
        before += n
    size_cell = F.create_map(*cells)[F.col("log")] if cells else F.lit(0)
    named = cell_of(as_number(F.col("name_a")), first), cell_of(as_number(F.col("name_b")), second)
    placed = cut(meta.select("id", "size", "crc", "name_a", "name_b", curve(*named, size_cell.cast("int")).alias("cell")))

    counts = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))  # at most 2**15 rows, whatever the data
    counts = counts.withColumn("cell_start", F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)))
    counts = cut(counts.select("cell", F.coalesce("cell_start", F.lit(0)).alias("cell_start"), F.ceil(F.col("n") / rows_per_task).cast("int").alias("subs")))
    rows = placed.join(F.broadcast(counts), "cell")
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("id", "crc", "size", F.lit(17)), F.col("subs")).cast("int"))
    parts = rows.groupBy("cell", "sub").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("cell", "sub", F.coalesce(F.sum("n").over(Window.partitionBy("cell").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("sub_start"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("cell", "sub").orderBy("id", "crc", "size")) - 1)
    at = F.col("cell_start") + F.col("sub_start") + F.col("rank")
    out = ranked.join(parts, ["cell", "sub"]).withColumn("at", at.cast("long"))
    # Shard k holds the positions from floor(k * total / shards) on.
    low = lambda k: F.expr(f"({k} * {total}L) div {shards}")
    guess = F.expr(f"(at * {shards}L) div {max(total, 1)}L")
    out = out.withColumn("guess", guess)
    out = out.withColumn("shard", F.when(low("(guess + 1)") <= F.col("at"), F.col("guess") + 1).otherwise(F.col("guess")))
    return out.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "name_a", "name_b", "cell",
        F.col("shard").cast("int").alias("shard"), (F.col("at") - low("shard")).alias("slot"))


def manifest(placed: DataFrame) -> DataFrame:
    """Ranges of each shard of hilbert_shards(), by which a reader leaves out files: rows, bytes, least and greatest of
    both names and of the size, and how many names are null. Rows of any id count once each.
    """
    ranges = [f(c).alias(f"{n}_{c}") for c in ("name_a", "name_b", "size") for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in ("name_a", "name_b")]
    return placed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("bytes"), *ranges, *nulls)
