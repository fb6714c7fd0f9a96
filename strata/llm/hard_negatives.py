"""Hard negatives by blocked dense matrix products.

Anchors go in blocks of a bounded number of bytes. A block is broadcast, and every task multiplies it with its
candidates, tile by tile: float64 products of whole numbers are exact below 2^53, and a tile that might exceed that is
multiplied in integers. Tasks keep the best of each anchor alone, so what they send does not grow with the candidates.

1. The first pass keeps each anchor's best rows of its own label, which merge over tasks.
2. The second keeps, for each anchor and positive, the best rows of other labels in the window of scores that the
   positive allows.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import best, cut, name_checkpoint_dir

#: Bytes of a broadcast block of anchors; one anchor at least.
BLOCK_BYTES = 16 << 20
#: Anchors and candidates of a tile.
TILE = 512
EXACT, LONG = 2**53, 2**63
#: What takes the places that are still free: nothing scores less, no id is larger.
NO_SCORE, NO_ID = -LONG, LONG - 1


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, in doubles; components whose result is no long saturate."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """No null, no null component, none that is not finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """The vectors as rows; shorter ones end with zeros."""
    sizes = np.diff(np.asarray(vectors.offsets))
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers; those beyond 64 bits saturate."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    most = lambda x: max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    bound = most(a) * most(b) * width
    if bound < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < LONG:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -LONG, LONG - 1).astype(np.int64)


class Best:
    """Each row's k best pairs of score and id so far: higher scores first, then smaller ids."""

    def __init__(self, rows: int, k: int) -> None:
        self.scores = np.full((rows, k), NO_SCORE, dtype=np.int64)
        self.ids = np.full((rows, k), NO_ID, dtype=np.int64)

    def offer(self, first: int, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        """Scores of rows from ``first`` on with the candidates ``ids``, where ``allowed``."""
        last = slice(first, first + len(scores))
        score, worst_id = self.scores[last, -1:], self.ids[last, -1:]
        row, col = np.nonzero(allowed & ((scores > score) | ((scores == score) & (ids < worst_id))))
        if not len(row):
            return
        k, some = self.scores.shape[1], np.unique(row)
        rows = np.concatenate([row, np.repeat(some, k)])
        values = np.concatenate([scores[row, col], self.scores[first + some].ravel()])
        named = np.concatenate([ids[col], self.ids[first + some].ravel()])
        order = np.lexsort((named, ~values, rows))  # ~v falls as v rises, without overflow
        rows, values, named = rows[order], values[order], named[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kept = place < k
        self.scores[first + rows[kept], place[kept]] = values[kept]
        self.ids[first + rows[kept], place[kept]] = named[kept]

    def found(self, each: int = 1, part: int = 0) -> pa.RecordBatch:
        """row * each + part, id, score of every place that is taken."""
        row, place = np.nonzero(self.ids != NO_ID)
        return pa.RecordBatch.from_arrays([pa.array(row * each + part), pa.array(self.ids[row, place]), pa.array(self.scores[row, place])],
            names=["row", "id", "score"])


def tiles(batches, block: dict):
    """The tile's anchors as a slice, scores, candidate ids, whether labels agree, whether ids agree."""
    vectors, ids, labels = block["vectors"], block["ids"], block["labels"]
    for batch in batches:
        named, label, rows = batch.column(0).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2))
        order = np.argsort(named, kind="stable")  # of equal scores the first one offered stays
        named, label, rows = named[order], label[order], rows[order]
        for c in range(0, len(named), TILE):
            some = slice(c, c + TILE)
            for a in range(0, len(ids), TILE):
                own = slice(a, a + TILE)
                yield own, products(vectors[own], rows[some]), named[some], labels[own, None] == label[some], ids[own, None] == named[some]


def first_pass(block, k: int):
    """In a task: row (of the block), id, score of its best candidates of the same label."""

    def work(batches):
        held = Best(len(block.value["ids"]), k)
        for own, scores, named, same, itself in tiles(batches, block.value):
            held.offer(own.start, scores, named, same & ~itself)
        yield held.found()

    return work


def second_pass(block, k: int):
    """In a task: row (of the block's windows: anchor times positives, and positive), id, score of the best in each window."""

    def work(batches):
        low, high = block.value["low"], block.value["high"]
        n, each = low.shape
        held = [Best(n, k) for _ in range(each)]
        for own, scores, named, same, itself in tiles(batches, block.value):
            other = ~same & ~itself
            for j in range(each):
                held[j].offer(own.start, scores, named, other & (scores >= low[own, j, None]) & (scores <= high[own, j, None]))
        yield from (h.found(each, j) for j, h in enumerate(held))

    return work


def windows(positives: np.ndarray, there: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest negative score for each positive's: low * p <= 100 * s <= high * p. Empty where none is there."""
    p = positives.astype(object)
    least, most = -((-low * p) // 100), (high * p) // 100
    least[~there], most[~there] = 1, 0
    clip = lambda x: np.clip(x, -LONG, LONG - 1).astype(np.int64)
    return clip(least), clip(most)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label", scale: int = 256,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` and ``label_col`` are expressions over ``rows``. Rows with a null id, label or vector, or a component
    that is null or not finite, take no part. A score is the inner product of components scaled and rounded down. An
    anchor's positives are its first ``positives`` rows of the same label and another id; each positive's negatives are
    the first ``negatives`` rows of another label and id with low * positive_score <= 100 * negative_score <= high *
    positive_score. Higher scores come first, ties by smaller id.

    A shorter vector counts as ended with zeros; an empty one scores 0 with all. Repeated candidates are rows of their
    own, each with its rank; repeated anchors are one. Scores beyond 64 bits saturate. An anchor without positives, or a
    positive without negatives, gives no rows, and so does an empty table. Other columns are ignored.
    """
    spark = rows.sparkSession
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    clean = rows.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull() & label.isNotNull())
    clean = cut(clean.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        whole_components(F.col(vector_col), scale).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor")))
    candidates = clean.select("id", "label", "vector")
    anchors = clean.where("anchor").select("id", "label", "vector").distinct()
    said = anchors.agg(F.count(F.lit(1)).alias("n"), F.sum(8 * F.size("vector") + 16).alias("bytes"), F.max(8 * F.size("vector") + 16).alias("most")).first()
    # Dealt by their hash, blocks are alike in size; half a block is left for chance, and wide vectors count as all.
    blocks = max(1, -(-2 * max(said["n"] * said["most"] if said["n"] else 0, said["bytes"] or 0) // block_bytes))
    anchors = cut(anchors.withColumn("block", F.pmod(F.xxhash64("id", "label", "vector"), F.lit(blocks))).repartitionByRange("block"))
    folder = f"{name_checkpoint_dir(spark)}/negatives-{uuid.uuid4()}"
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=none")
    for b in range(blocks if said["n"] else 0):
        held = anchors.where(F.col("block") == b).select("id", "label", "vector").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        block = {"ids": held["id"].to_numpy(), "labels": held["label"].to_numpy(), "vectors": matrix(held["vector"].combine_chunks())}
        shared = spark.sparkContext.broadcast(block)
        near = best(candidates.mapInArrow(first_pass(shared, positives), "row long, id long, score long"), ["row"], [F.desc("score"), "id"], positives)
        near = near.toArrow()  # of one block's anchors, so bounded
        at = (near["row"].to_numpy(), near["rank"].to_numpy() - 1)
        chosen = {c: np.zeros((held.num_rows, positives), dtype=np.int64) for c in ("id", "score")}
        there = np.zeros((held.num_rows, positives), dtype=bool)
        chosen["id"][at], chosen["score"][at], there[at] = near["id"].to_numpy(), near["score"].to_numpy(), True
        least, most = windows(chosen["score"], there, low, high)
        allowed = spark.sparkContext.broadcast(block | {"low": least, "high": most})
        hard = best(candidates.mapInArrow(second_pass(allowed, negatives), "row long, id long, score long"), ["row"], [F.desc("score"), "id"], negatives)
        row, place = np.nonzero(there)
        pairs = spark.createDataFrame(pa.table({"row": row * positives + place, "anchor_id": block["ids"][row],
            "positive_id": chosen["id"][row, place], "positive_score": chosen["score"][row, place]}))
        hard.join(F.broadcast(pairs), "row").select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score")).write.parquet(f"{folder}/block={b}")
        shared.destroy()
        allowed.destroy()
    return spark.read.schema(schema).parquet(folder).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
