"""Ranked lexical search over inverted treaps.

The index is cut by documents: a task takes its documents in blocks. In a block every term of a query has a treap of
its postings: a search tree by place (the order of ids), a heap by impact (equal impacts by a hash of the place, so the
tree stays shallow). A query walks the treaps of its terms together, over ranges of places:

* a range's bound is the sum of its treaps' roots, each times the term's weight: nothing inside can score more,
* ranges whose bound cannot enter the best k so far are pruned; of the others the most promising ones are next,
* such a range is split at the root of its weightiest treap. All treaps are split there by their paths to that place,
  which also give what the document scores, and the subtrees for the ranges on either side.

The best k of one block are the threshold of the next one in the task. Tasks send their best k of each query alone.

Before that, one pass over the texts writes postings for the queries' terms, and counts of documents and terms; weights
come from these. Queries are broadcast in blocks of a bounded number of terms.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import best, cut, name_checkpoint_dir, text_of

#: Terms of queries in a broadcast block; one query at least.
BLOCK_TERMS = 1 << 18
#: Documents and postings in a block of treaps.
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 14, 1 << 21
#: Numbers in a table of ranges by terms, which bounds the memory of a walk.
WALK = 1 << 24
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Every byte as it counts in terms: ASCII letters in lower case, digits, all that is not ASCII; the rest separates.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
NONE = -1


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(_KEPT).split()


def impact(tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What an occurrence pattern adds for a weight of 1; n is the document's number of terms."""
    m = 100 - 25 + (25 * n * docs) // length
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


@dataclass
class Treaps:
    """One treap a term over a block's documents. Nodes are postings, sorted by term and place."""

    place: np.ndarray
    impact: np.ndarray
    left: np.ndarray
    right: np.ndarray
    root: dict[int, int]


def build(term: np.ndarray, place: np.ndarray, impacts: np.ndarray) -> Treaps:
    """Treaps of postings that are sorted by term and place."""
    rank = (impacts << 20) | ((place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
    left, right, root = [NONE] * len(term), [NONE] * len(term), {}
    ranks, ends = rank.tolist(), np.flatnonzero(np.diff(term)) + 1
    bounds = [0, *ends.tolist(), len(term)]
    for a, b in zip(bounds, bounds[1:], strict=False):
        path: list[int] = []  # the rightmost one, from the root on
        for i in range(a, b):
            under, r = NONE, ranks[i]
            while path and ranks[path[-1]] < r:
                under = path.pop()
            left[i] = under
            if path:
                right[path[-1]] = i
            path.append(i)
        if path:
            root[int(term[a])] = path[0]
    return Treaps(place, impacts, np.array(left, dtype=np.int32), np.array(right, dtype=np.int32), root)


def _inside(t: Treaps, node: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The roots of subtrees as far as they lie between low and high."""
    node, on = node.copy(), np.arange(len(node))
    while len(on):
        on = on[node[on] != NONE]
        way = t.place[node[on]]
        small, large = way <= low[on], way >= high[on]
        node[on] = np.where(small, t.right[node[on]], np.where(large, t.left[node[on]], node[on]))
        on = on[small | large]
    return node


def split(t: Treaps, node: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For subtrees (``node``, looked at between low and high only) and a place for each: the roots of what is before
    and behind the place, and the impact there (0: none).

    A subtree also holds places beyond its range; on the path to a place, the first node inside of a range is its root.
    """
    before, behind, here = np.full(len(node), NONE, dtype=np.int32), np.full(len(node), NONE, dtype=np.int32), np.zeros(len(node), dtype=np.int64)
    rest = np.flatnonzero(node != NONE)
    node = node[rest]
    while len(rest):
        way, found = t.place[node], at[rest]
        less, same = way < found, way == found
        new = less & (way > low[rest]) & (before[rest] == NONE)
        before[rest[new]] = node[new]
        new = (way > found) & (way < high[rest]) & (behind[rest] == NONE)
        behind[rest[new]] = node[new]
        if same.any():
            hit, own = rest[same], node[same]
            here[hit] = t.impact[own]
            new = before[hit] == NONE
            before[hit[new]] = _inside(t, t.left[own[new]], low[hit[new]], at[hit[new]])
            new = behind[hit] == NONE
            behind[hit[new]] = _inside(t, t.right[own[new]], at[hit[new]], high[hit[new]])
        node = np.where(less, t.right[node], t.left[node])
        on = ~same & (node != NONE)
        rest, node = rest[on], node[on]
    return before, behind, here


class Top:
    """The k best of (score, key) so far: higher scores first, then smaller keys."""

    def __init__(self, k: int) -> None:
        self.k, self.scores, self.keys = k, np.zeros(0, dtype=np.int64), []

    @property
    def least(self) -> int:
        """What enters scores at least so much."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def offer(self, scores: np.ndarray, keys: list) -> None:
        rows = sorted([*zip(self.scores.tolist(), self.keys, strict=True), *zip(scores.tolist(), keys, strict=True)], key=lambda x: (-x[0], x[1]))[: self.k]
        self.scores, self.keys = np.array([s for s, _ in rows], dtype=np.int64), [key for _, key in rows]


def walk(t: Treaps, terms: np.ndarray, weights: np.ndarray, top: Top, keys: list) -> int:
    """Offers to ``top`` every document that may enter it; returns how many were scored. keys: of each place, in order."""
    roots = np.array([t.root.get(int(x), NONE) for x in terms], dtype=np.int32)
    there = (roots != NONE) & (weights > 0)
    if not there.any():
        return 0
    weights, scored = weights[there], 0
    add = lambda n: np.where(n == NONE, 0, t.impact[n]) * weights
    # A range has the roots of its treaps, its bound, and the places around it.
    nodes, low, high = roots[there][None], np.array([-1]), np.array([len(keys)])
    bounds = add(nodes).sum(axis=1)
    each = max(1, min(512, (1 << 18) // len(weights)))
    while True:
        left = np.flatnonzero(bounds >= top.least)
        if not len(left):
            return scored
        if len(left) > each:
            first = np.argpartition(-bounds[left], each - 1)
            now, left = left[first[:each]], left[first[each:]]
        else:
            now, left = left, left[:0]
        own, lo, hi = nodes[now], low[now], high[now]
        at = t.place[own[np.arange(len(own)), add(own).argmax(axis=1)]].astype(np.int64)
        wide = own.shape[1]
        parts = split(t, own.ravel(), np.repeat(at, wide), np.repeat(lo, wide), np.repeat(hi, wide))
        before, behind, here = (x.reshape(own.shape) for x in parts)
        scores, scored = (here * weights).sum(axis=1), scored + len(at)
        good = np.flatnonzero(scores >= top.least)
        top.offer(scores[good], [keys[p] for p in at[good].tolist()])
        new = np.concatenate([before, behind])
        nodes, bounds = np.concatenate([nodes[left], new]), np.concatenate([bounds[left], add(new).sum(axis=1)])
        low, high = np.concatenate([low[left], lo, at]), np.concatenate([high[left], at, hi])


def _posted(shared):
    """Per document: id, n (all its terms), and its numbers of the queries' terms and how often they occur."""

    def work(batches):
        known = shared.value
        for batch in batches:
            n, sizes, terms, tfs = [], [0], [], []
            for text in batch.column(1).to_pylist():
                words = terms_of(text)
                n.append(len(words))
                if len(words) < len(known):
                    found = [(known[w], c) for w, c in Counter(words).items() if w in known]
                else:
                    counts = Counter(words)
                    found = [(known[w], counts[w]) for w in counts.keys() & known.keys()]
                terms += [t for t, _ in found]
                tfs += [c for _, c in found]
                sizes.append(len(terms))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(x, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), lists(terms), lists(tfs)], names=["id", "n", "terms", "tfs"])

    return work


def _blocks(batches, most_docs: int):
    """The documents of a task with postings, as blocks of record batches."""
    held, docs, postings = [], 0, 0
    for batch in batches:
        offsets = np.asarray(batch.column(2).offsets)
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + BLOCK_POSTINGS - postings, side="right")) - 1
            end = min(max(end, start + 1), start + most_docs - docs, batch.num_rows)
            held.append(batch.slice(start, end - start))
            docs, postings = docs + end - start, postings + int(offsets[end] - offsets[start])
            start = end
            if docs >= most_docs or postings >= BLOCK_POSTINGS:
                yield held
                held, docs, postings = [], 0, 0
    if held:
        yield held


def _ranked(shared, k: int):
    """Per query its best documents of the task: row (of the block of queries), id, score."""

    def work(batches):
        held = shared.value
        queries, docs, length = held["queries"], held["docs"], held["length"]
        tops = [Top(k) for _ in queries]
        widest = max([1, *(len(terms) for terms, _ in queries)])
        for block in _blocks(batches, max(1, min(BLOCK_DOCS, WALK // widest))):
            rows = pa.Table.from_batches(block).combine_chunks()
            ids, n = rows["id"].to_pylist(), rows["n"].to_numpy()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
            keys = [(ids[i] is None, ids[i] or 0) for i in order]
            places = np.empty(len(ids), dtype=np.int32)
            places[order] = np.arange(len(ids))
            lists = rows["terms"].combine_chunks()
            doc = np.repeat(np.arange(len(ids)), np.diff(np.asarray(lists.offsets)))
            term, tf = lists.flatten().to_numpy(), rows["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            by = np.lexsort((places[doc], term))
            treaps = build(term[by], places[doc][by], impact(tf, n[doc], docs, length)[by])
            for top, (terms, weights) in zip(tops, queries, strict=True):
                walk(treaps, terms, weights, top, keys)
        row = np.repeat(np.arange(len(tops)), [len(t.keys) for t in tops])
        ids = [None if missing else i for t in tops for missing, i in t.keys]
        yield pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), pa.array(ids, pa.int64()), pa.array(np.concatenate([np.zeros(0, dtype=np.int64),
            *(t.scores for t in tops)]))], names=["row", "id", "score"])

    return work


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, terms (with repeats), n (how many); items without terms are left out."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = F.regexp_extract_all(F.translate(text_of(text_col), upper, lower), F.lit(TERMS), F.lit(0))
    return items.select(F.col(id_col).alias("item"), terms.alias("terms")).where(F.size("terms") > 0).withColumn("n", F.size("terms"))


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item id, rank, the id of the document, score: each item's k best documents with a score above 0.

    Terms are runs of ASCII letters and digits and of all characters that are not ASCII, A-Z in lower case. Documents
    and terms are counted over all documents; null texts have no terms. Repeated terms of an item count as often. Equal
    scores come by ascending id; documents without an id count like others and come last among equals. Repeated
    documents are rows of their own, and so are repeated items (each is ranked by itself; one without an id has a null id).
    Ids are whole numbers. Empty tables, and items without terms, give no rows. Texts are read whole; other columns are ignored.
    """
    spark = docs.sparkSession
    queries = cut(item_terms(items, item_id_col, item_text_col))
    said = queries.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
    blocks = max(1, -(-2 * (said["all"] or 0) // max(block_terms, said["most"] or 0)))
    queries = cut(queries.withColumn("block", F.pmod(F.xxhash64("item", "terms"), F.lit(blocks))).repartitionByRange("block"))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    folder = f"{name_checkpoint_dir(spark)}/ranked-{uuid.uuid4()}"
    schema = f"{item_id_col} {items.schema[item_id_col].dataType.simpleString()}, rank int, {id_col} long, score long"
    spark.createDataFrame([], schema).write.parquet(f"{folder}/block=none")
    for b in range(blocks if said["all"] else 0):
        held = queries.where(F.col("block") == b).select("item", "terms").collect()  # a block's items, so bounded
        if not held:
            continue
        known = {t: i for i, t in enumerate(sorted({t.encode() for q in held for t in q["terms"]}))}
        shared = spark.sparkContext.broadcast(known)
        postings = cut(texts.mapInArrow(_posted(shared), "id long, n long, terms array<int>, tfs array<int>").where("n > 0"))
        counts = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = {r["term"]: r["df"] for r in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
        weights = np.array([weight(counts[0], df.get(i, 0)) for i in range(len(known))], dtype=np.int64)
        asked = []
        for q in held:
            own = Counter(known[t.encode()] for t in q["terms"])
            terms = np.array(sorted(own), dtype=np.int32)
            asked.append((terms, weights[terms] * np.array([own[t] for t in terms.tolist()], dtype=np.int64)))
        plan = spark.sparkContext.broadcast({"queries": asked, "docs": counts[0], "length": counts[1] or 1})
        some = postings.where(F.size("terms") > 0).mapInArrow(_ranked(plan, k), "row long, id long, score long")
        found = best(some, ["row"], [F.desc("score"), F.asc_nulls_last("id")], k)
        named = spark.createDataFrame([(i, q["item"]) for i, q in enumerate(held)], f"row long, {schema.split(',')[0]}")
        found.join(F.broadcast(named), "row").select(item_id_col, "rank", F.col("id").alias(id_col), "score").write.parquet(f"{folder}/block={b}")
        shared.destroy()
        plan.destroy()
    return spark.read.schema(schema).parquet(folder).select(item_id_col, "rank", id_col, "score")
