"""Benchmark decontamination: Wu-Manber search for the windows of benchmark items in whole documents.

Texts become their words in lower case with one space around each, as bytes; a window is such a string of consecutive
words, so it occurs exactly where its words do. Windows are dealt to classes by length (each class has a least length
of its own, so that a short item doesn't shorten the steps of all):

* a shift table says, for each block of bytes that occurs in the beginnings of the windows, how far the next possible
  end is; blocks that occur in none skip nearly a whole beginning,
* where the shift is 0, a bucket by that block (the beginnings' suffix) holds the windows by their beginnings,
* direct comparison of the whole window confirms an occurrence.

Windows are broadcast in blocks of a bounded size. One block is one pass over the documents without a shuffle; with
more blocks, what each finds meets by the digest of the text.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import cut, rows_not_in, text_of

WINDOW = 10
#: Bytes of windows (and items' names) in a broadcast block.
BLOCK_BYTES = 4 << 20
#: A class's beginnings are no longer than this, which bounds the shift table.
LONGEST_BEGINNING = 64
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Every byte as it counts in words: ASCII letters in lower case, digits, all that is not ASCII; the rest separates.
_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_KEPT).split()


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """item, words: the distinct windows of each item, as texts with a space around each word."""
    words = F.regexp_extract_all(F.translate(text_of(text_col), UPPER, LOWER), F.lit(WORDS), F.lit(0))
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    rows = rows.select("item", "w", F.explode(starts).alias("at"))
    return rows.select("item", F.concat(F.lit(" "), F.array_join(F.slice("w", F.col("at"), window), " "), F.lit(" ")).alias("words")).distinct()


class Tables:
    """The tables of one class of windows, all at least as long as its beginnings."""

    def __init__(self, windows: list[bytes]) -> None:
        self.m = m = min(LONGEST_BEGINNING, min(map(len, windows)))
        #: Long enough that few blocks of a text occur in the beginnings by chance.
        self.wide = wide = min(m, 1 + math.ceil(math.log(2 * m * len(windows), 16)))
        self.far = m - wide + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = defaultdict(lambda: defaultdict(list))
        for w in windows:
            beginning = w[:m]
            for end in range(wide, m + 1):
                block = beginning[end - wide : end]
                if m - end < self.shift.get(block, self.far):
                    self.shift[block] = m - end
            self.buckets[beginning[m - wide :]][beginning].append(w)

    def occurrences(self, text: bytes):
        """(start, window) of every occurrence."""
        m, wide, far, shift, end, n = self.m, self.wide, self.far, self.shift.get, self.m, len(text)
        while end <= n:
            block = text[end - wide : end]
            step = shift(block, far)
            if step:
                end += step
                continue
            start = end - m
            for window in self.buckets[block].get(text[start:end], ()):
                if text.startswith(window, start):
                    yield start, window
            end += 1


class Search:
    """Finds the windows of items in texts."""

    def __init__(self, pairs: list[tuple[str, bytes]]) -> None:
        self.items: dict[bytes, list[str]] = defaultdict(list)
        for item, window in pairs:
            self.items[window].append(item)
        classes: dict[int, list[bytes]] = defaultdict(list)
        for window in self.items:
            classes[min(len(window), LONGEST_BEGINNING).bit_length()].append(window)
        self.tables = [Tables(ws) for ws in classes.values()]

    def spans(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit words as merged (start, end) and the items."""
        text = b" " + b" ".join(words) + b" "
        found = {hit for t in self.tables for hit in t.occurrences(text)}
        if not found:
            return np.zeros((0, 2), dtype=np.int64), set()
        spaces = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)
        starts = np.searchsorted(spaces, np.array([start for start, _ in found]))
        spans = sorted(zip(starts.tolist(), (starts + [w.count(b" ") - 1 for _, w in found]).tolist(), strict=True))
        merged = [list(spans[0])]
        for start, end in spans[1:]:
            if start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        return np.array(merged), {item for w in {w for _, w in found} for item in self.items[w]}


FOUND = "n_words long, hits array<struct<start:long,end:long>>, items array<string>"


def _searched(shared, keyed: bool):
    """Per document its id, n_words, hits and items; or, if keyed, those of the documents with hits by their texts' digests."""

    def work(batches):
        search = Search(shared.value)
        for batch in batches:
            keys, n_words, hits, items = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                spans, named = search.spans(words)
                if keyed and not named:
                    continue
                keys.append(xxhash.xxh3_128_digest(text.encode()) if keyed else None)
                n_words.append(len(words))
                hits.append([{"start": a, "end": b} for a, b in spans.tolist()])
                items.append(sorted(named))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()) if keyed else batch.column(0), pa.array(n_words, pa.int64()),
                pa.array(hits, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(items, pa.list_(pa.string()))],
                names=["key", "n_words", "hits", "items"])

    return work


def _counted(batches):
    for batch in batches:
        texts = batch.column(1).to_pylist()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary()),
            pa.array([len(words_of(t)) for t in texts], pa.int64())], names=["id", "key", "n_words"])


def merged_spans(spans: DataFrame) -> DataFrame:
    """key, hits: of rows (key, start, end), the spans of each key, sorted and without overlaps; touching ones join."""
    order = Window.partitionBy("key").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    apart = spans.withColumn("apart", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    joined = apart.withColumn("island", F.sum("apart").over(order.rowsBetween(Window.unboundedPreceding, 0))).groupBy("key", "island")
    joined = joined.agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return joined.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("hits"))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
    item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the id, n_words, hits (spans of words, end exclusive, apart from each other), items.

    Words are in lower case (A-Z only). A window is ``window`` consecutive words of an item; an item of fewer words, but
    not none, is one window. Every word inside an occurrence of a window is hit, and the items with an occurring window
    are listed once each, sorted as texts. Null texts have no words. Items without an id have the empty id; repeated
    items count once. Repeated rows of ``docs`` are rows of their own. An empty ``docs`` gives no rows; without items
    nothing is hit. Texts are searched whole; other columns are ignored.
    """
    spark = docs.sparkSession
    pairs = cut(item_windows(items, item_id_col, item_text_col, window))
    total = pairs.agg(F.sum(F.octet_length("words") + F.octet_length("item") + 64)).first()[0] or 0
    blocks = -(-total // block_bytes)
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def block(b: int):
        rows = pairs.where(F.pmod(F.xxhash64("words", "item"), F.lit(max(blocks, 1))) == b).toArrow()
        return spark.sparkContext.broadcast([(i, w.encode()) for i, w in zip(rows["item"].to_pylist(), rows["words"].to_pylist(), strict=True)])

    if blocks <= 1:
        return texts.mapInArrow(_searched(block(0), False), f"key {kind}, {FOUND}").withColumnRenamed("key", id_col)
    found = None
    for b in range(blocks):
        # Equal texts have equal hits, so one row a text is enough.
        hit = texts.mapInArrow(_searched(block(b), True), f"key binary, {FOUND}").select("key", "hits", "items")
        hit = cut(hit.groupBy("key").agg(F.first("hits").alias("hits"), F.first("items").alias("items")))
        found = hit if found is None else found.unionByName(hit)
    named = found.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    every = merged_spans(found.select("key", F.inline("hits"))).join(named, "key")
    rows = texts.mapInArrow(_counted, f"id {kind}, key binary, n_words long").join(every, "key", "left")
    return rows.select(F.col("id").alias(id_col), "n_words", F.coalesce("hits", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def without_contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which nothing is hit, with all their columns. Rows that repeat an id go together."""
    found = contamination(docs, items, id_col, text_col, **options)
    hit = cut(found.where(F.size("hits") > 0).select(F.col(id_col).alias("id")).distinct())
    return rows_not_in(docs, hit, {"id": F.col(id_col)})
