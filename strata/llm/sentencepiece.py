"""SentencePiece encoding with seeded merge-dropout, and decoding.

Byte-pair merging as an agenda: of all neighbouring symbols whose concatenation is a piece, the pair with the best
score (the leftmost of equals) merges, until none is left. With dropout a candidate (start, middle, end of its two
symbols) is skipped if the keyed hash of (seed, document, position, start, middle, end) falls below ``dropout``. A
candidate arises once at most, so asking the hash when it arises is the same as asking when the agenda pops it.

No piece reaches over a space or a line feed except at its start, so texts are cut into chunks there, and a chunk's
segmentation depends on its text and on what is skipped alone. Every occurrence asks the hash for each of its own
candidates and is merged by itself; nothing of one occurrence's draws serves another. Occurrences of one length are
merged side by side in columns: a turn takes each one's best candidate, merges it, and offers the two candidates that
arise beside it. What a worker remembers is a chunk's characters and first candidates before any draw. Characters
without a piece, and the piece mark itself when it stands in a text, become byte pieces, so decoding is lossless.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Chunks up to this many characters are merged in columns (places take six bits), longer ones one by one.
WIDE = 62
#: So many chunks are merged side by side: a block's columns stay in a core's cache.
BLOCK = 8192
#: A worker forgets chunks when it knows so many.
REMEMBERED = 250_000
#: Characters that are encoded at a time, which bounds a worker's memory.
SLICE_CHARS = 1_000_000
NONE = np.int32(2**31 - 1)
U = np.uint64


def load_pieces(model_file: str) -> dict:
    """What the executors need of a model file: pieces in the order of their ids, scores and kinds.

    The vocabulary is a few tens of thousands of pieces, whatever the data, and goes out with the tasks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    if any(re.search(f"[^{MARK}]{MARK}|.\n|\n.", p) for p, s in zip(pieces, special, strict=True) if not s):
        raise ValueError("a piece reaches over a space or a line feed")
    scores, byte = [model.get_score(i) for i in range(size)], [model.is_byte(i) for i in range(size)]
    return {"pieces": pieces, "scores": scores, "special": special, "byte": byte,
        "digest": hashlib.sha256(repr((pieces, scores, special, byte)).encode("utf-8", "surrogatepass")).hexdigest()}


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


ALL = 2**64 - 1


def mixed_one(x: int) -> int:
    """The same of one number."""
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & ALL
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & ALL
    return x ^ (x >> 31)


class CharIds(dict):
    """Ids of characters. One without a piece is its byte piece, or gets an id beyond the vocabulary if it has several
    bytes; neither is in a pair. A space is the piece mark; a mark that stands in a text is not.
    """

    def __init__(self, ids: dict[str, int], spelt: dict[int, int], size: int):
        super().__init__((c, i) for c, i in ids.items() if len(c) == 1 and c not in (MARK, " "))
        if MARK in ids:
            self[" "] = ids[MARK]
        self.spelt, self.size, self.others = spelt, size, []

    def __missing__(self, char: str) -> int:
        self[char] = i = self.spelt[ord(char)] if char < "\x80" else self.size + len(self.others)
        if i >= self.size:
            self.others.append(char)
        return i


class Codec:
    def __init__(self, vocabulary: dict, seed: int = 0, dropout: float = 0.0):
        self.seed = seed
        self.least = U(min(int(dropout * 2.0**64), 2**64 - 1))
        plain = [not s and not b for s, b in zip(vocabulary["special"], vocabulary["byte"], strict=True)]
        self.ids = {p: i for i, (p, ok) in enumerate(zip(vocabulary["pieces"], plain, strict=True)) if ok}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(vocabulary["pieces"]) if vocabulary["byte"][i]}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        self.size = len(plain)
        self.by_rank = np.array(sorted(range(self.size), key=lambda i: (-vocabulary["scores"][i], i)), dtype=np.int32)
        self.rank = np.zeros(self.size, dtype=np.int32)
        self.rank[self.by_rank] = np.arange(self.size, dtype=np.int32)
        self.raw = [bytes([int(p[3:5], 16)]) if b else b"" if s else p.replace(MARK, " ").encode() for p, s, b in zip(vocabulary["pieces"],
            vocabulary["special"], vocabulary["byte"], strict=True)] + ["\ufffd".encode()]
        self.raw_array = pa.array(self.raw, pa.binary())
        self.raw_len = np.array([len(x) for x in self.raw], dtype=np.int64)
        self.pairs = {}
        for p, i in self.ids.items():
            for k in range(1, len(p)):
                left, right = self.ids.get(p[:k]), self.ids.get(p[k:])
                if left is not None and right is not None:
                    self.pairs[left << 21 | right] = i
        self.index_pairs()
        place = np.arange(64, dtype=U)
        at = place[:, None, None] << U(42) ^ place[None, :, None] << U(21) ^ place[None, None, :]
        self.place_hash = mixed(at + U(0x9E3779B97F4A7C15)).ravel()
        self.forget()

    def index_pairs(self) -> None:
        """A hash table in arrays: the rank of what a pair of ids merges to."""
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        ranks = self.rank[np.fromiter(self.pairs.values(), np.int64, len(keys))]
        bits = max(4, int(4 * len(keys)).bit_length())
        self.shift, self.slots = U(64 - bits), np.full(1 << bits, -1, dtype=np.int64)
        self.slot_rank, self.probes = np.full(1 << bits, NONE, dtype=np.int32), 0
        slot = self.slot_of(keys)
        while len(keys):
            self.probes += 1
            first = np.zeros(len(keys), dtype=bool)
            first[np.unique(slot, return_index=True)[1]] = True
            first &= self.slots[slot] < 0
            self.slots[slot[first]], self.slot_rank[slot[first]] = keys[first], ranks[first]
            keys, ranks, slot = keys[~first], ranks[~first], (slot[~first] + 1) % len(self.slots)

    def slot_of(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(U) * U(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the merged pieces; NONE where a pair merges to none."""
        want = left.astype(np.int64) << 21 | right
        slot = self.slot_of(want)
        held = self.slots[slot]
        rank = np.where(held == want, self.slot_rank[slot], NONE)
        open_ = np.nonzero((held != want) & (held >= 0))[0]
        slot = slot[open_]
        for _ in range(self.probes):
            if not len(open_):
                break
            slot = (slot + 1) % len(self.slots)
            held, wanted = self.slots[slot], want[open_]
            rank[open_] = np.where(held == wanted, self.slot_rank[slot], NONE)
            on = (held != wanted) & (held >= 0)
            open_, slot = open_[on], slot[on]
        return rank

    # --- what the worker remembers of chunks
    def forget(self) -> None:
        self.codes: dict[str, int] = {}
        self.chunks: list[str] = []
        self.chars = CharIds(self.ids, self.bytes, self.size)
        self.sym, self.first = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
        self.lens, self.starts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def learn(self) -> None:
        """Characters and first candidates of the chunks that are new; of long ones the length alone."""
        new = self.chunks[len(self.lens) :]
        if not new:
            return
        lens = np.fromiter(map(len, new), np.int64, len(new))
        short = [c for c in new if len(c) <= WIDE]
        sym = np.fromiter(map(self.chars.__getitem__, "".join(short)), np.int32)
        first = np.full(len(sym), NONE, dtype=np.int32)
        if len(sym):
            own = lens[lens <= WIDE]
            place = np.arange(len(sym)) - np.repeat(np.cumsum(own) - own, own)
            rank = self.ranks_of(sym[:-1], sym[1:])
            inside = (place[1:] > 0) & (rank != NONE)
            first[:-1][inside] = rank[inside] << 6 | place[:-1][inside]
        held = np.where(lens <= WIDE, lens, 0)
        self.starts = np.concatenate([self.starts, len(self.sym) + np.cumsum(held) - held])
        self.lens = np.concatenate([self.lens, lens])
        self.sym, self.first = np.concatenate([self.sym, sym]), np.concatenate([self.first, first])

    # --- merging
    def skipped(self, keys: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed(keys ^ self.place_hash[start << 12 | middle << 6 | end]) < self.least

    def merged(self, codes: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks of n characters in a row, and how many each has. A column per chunk, a row per place."""
        m = len(codes)
        at = self.starts[codes][None, :] + np.arange(n)[:, None]
        sym, best_at = self.sym[at], self.first[at]
        if self.least:
            for i in range(n - 1):
                best_at[i][mixed(keys ^ self.place_hash[i << 12 | (i + 1) << 6 | (i + 2)]) < self.least] = NONE
        after = np.repeat(np.arange(1, n + 1, dtype=np.int8)[:, None], m, axis=1)
        before = np.repeat(np.arange(-1, n, dtype=np.int8)[:, None], m, axis=1)
        sym_, best_, after_, before_ = sym.ravel(), best_at.ravel(), after.ravel(), before.ravel()
        while True:
            best = best_at.min(axis=0)
            col = np.nonzero(best != NONE)[0]
            if not len(col):
                break
            best = best[col]
            start = (best & 63).astype(np.int64)
            here = start * m + col
            middle = after_[here].astype(np.int64) * m + col
            end = after_[middle].astype(np.int64)
            new = self.by_rank[best >> 6]
            sym_[here], sym_[middle] = new, -1
            best_[here], best_[middle] = NONE, NONE
            after_[here] = end
            beyond = end * m + col
            before_[beyond] = start
            # The candidates that arise: with what follows, and with what stands before.
            has = np.nonzero(end < n)[0]
            prev = before_[here].astype(np.int64)
            had = np.nonzero(prev >= 0)[0]
            i, j = np.concatenate([start[has], prev[had]]), np.concatenate([end[has], start[had]])
            c = np.concatenate([col[has], col[had]])
            left, right = np.concatenate([new[has], sym_[prev[had] * m + col[had]]]), np.concatenate([sym_[beyond[has]], new[had]])
            rank = self.ranks_of(left, right)
            place = i * m + c
            best_[place] = NONE
            ok = np.nonzero(rank != NONE)[0]
            i, j, c, place, rank = i[ok], j[ok], c[ok], place[ok], rank[ok]
            if self.least and len(ok):
                stays = np.nonzero(~self.skipped(keys[c], i, j, after_[j * m + c].astype(np.int64)))[0]
                i, place, rank = i[stays], place[stays], rank[stays]
            best_[place] = rank << 6 | i.astype(np.int32)
        there = sym >= 0
        return sym.T[there.T], there.sum(axis=0)

    def segment_one(self, chunk: str, key: int) -> list[int]:
        """By an agenda on a heap, with the key of an occurrence; for long chunks."""
        n, least = len(chunk), int(self.least)
        sym = list(map(self.chars.__getitem__, chunk))
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j < n and (new := self.pairs.get(sym[i] << 21 | sym[j])) is not None:
                if not least or not mixed_one(key ^ mixed_one(((i << 42 ^ j << 21 ^ nxt[j]) + 0x9E3779B97F4A7C15) & ALL)) < least:
                    heapq.heappush(agenda, (int(self.rank[new]), i, j, nxt[j]))

        for i in range(n - 1):
            push(i, i + 1)
        gone = [False] * n
        while agenda:
            _, i, j, end = heapq.heappop(agenda)
            if gone[i] or gone[j] or nxt[i] != j or nxt[j] != end:
                continue
            sym[i] = self.pairs[sym[i] << 21 | sym[j]]
            gone[j], nxt[i] = True, end
            if end < n:
                prv[end] = i
            push(prv[i], i)
            push(i, end)
        return [s for s, g in zip(sym, gone, strict=True) if not g]

    def encode(self, texts: list[str], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has. docs: a 64-bit key per document."""
        if len(self.chunks) > REMEMBERED:
            self.forget()
        cut, codes, chunks = re.compile("\n| +[^ \n]*|[^ \n]+").findall, self.codes, self.chunks
        split = [cut(" " + text) if text else [] for text in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        for part in set().union(*split).difference(codes):
            codes[part] = len(chunks)
            chunks.append(part)
        flat = np.fromiter(map(codes.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        if not len(flat):
            return np.zeros(0, dtype=np.int32), counts
        self.learn()
        place = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        keys = mixed(np.repeat(docs.astype(U), counts) + mixed(place.astype(U) + U(self.seed & (2**63 - 1))))
        size = self.lens[flat]
        order = np.argsort(size, kind="stable")
        n, found = np.zeros(len(flat), dtype=np.int64), []
        bounds = np.searchsorted(size[order], np.arange(1, WIDE + 2))
        for wide, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True), start=1):
            for a in range(lo, hi, BLOCK):
                rows = order[a : min(a + BLOCK, hi)]
                ids, n[rows] = self.merged(flat[rows], keys[rows], wide)
                found.append((rows, ids))
        for row in order[bounds[-1] :].tolist():
            ids = self.segment_one(chunks[flat[row]], int(keys[row]))
            n[row] = len(ids)
            found.append((np.array([row]), np.array(ids, dtype=np.int32)))
        ends = np.cumsum(n)
        out = np.zeros(int(ends[-1]), dtype=np.int32)
        for rows, ids in found:
            own = n[rows]
            out[np.repeat(ends[rows] - np.cumsum(own), own) + np.arange(len(ids))] = ids
        totals = np.diff(np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])])
        return self.with_bytes(out, totals)

    def with_bytes(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece as their bytes."""
        if not self.chars.others or ids.max(initial=0) < self.size:
            return ids, counts
        spelt = [[self.bytes[b] for b in c.encode("utf-8", "surrogatepass")] for c in self.chars.others]
        lens, values = np.fromiter(map(len, spelt), np.int64), np.fromiter((x for some in spelt for x in some), np.int32)
        other = ids >= self.size
        which = np.where(other, ids - self.size, 0)
        n = np.where(other, lens[which], 1)
        out = np.repeat(ids, n)
        within = np.arange(len(out)) - np.repeat(np.cumsum(n) - n, n)
        from_bytes = np.repeat(other, n)
        out[from_bytes] = values[np.repeat((np.cumsum(lens) - lens)[which], n)[from_bytes] + within[from_bytes]]
        text = np.repeat(np.arange(len(counts)), counts)
        return out, np.bincount(text, weights=n, minlength=len(counts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; an id that is none becomes a replacement character."""
        if not len(ids):
            return [b""] * len(counts)
        if len(odd := np.flatnonzero((ids < 0) | (ids >= self.size))):
            ids = ids.copy()
            ids[odd] = self.size  # the last of raw
        joined = b"".join(map(self.raw.__getitem__, ids.tolist())) if len(ids) < 1000 else self.raw_array.take(pa.array(ids)).buffers()[2].to_pybytes()
        ends = np.concatenate([[0], np.cumsum(self.raw_len[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        return [joined[a:b].removeprefix(b" ") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_codecs: dict[tuple, Codec] = {}


def codec(vocabulary: dict, *key) -> Codec:
    """One per Python worker, model and setting."""
    if (found := _codecs.get(own := (vocabulary["digest"], *key))) is None:
        _codecs.clear()
        found = _codecs[own] = Codec(vocabulary, *key)
    return found


def slices(texts: list[str]) -> Iterator[slice]:
    lo, chars = 0, 0
    for k, text in enumerate(texts):
        chars += len(text)
        if chars >= SLICE_CHARS or k + 1 - lo >= 2000:
            yield slice(lo, k + 1)
            lo, chars = k + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


def encode(docs: DataFrame, model_file: str, seed: int = 0, dropout: float = 0.1, id_col: str = "doc_id", text_col: str = "text",
    copy_col: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: the id, ids (pieces), n_tokens, lossless (the ids decode to the text), and the columns in ``keep``.

    A null text is an empty one, whose ids are empty. The keyed hash is seeded and takes the document's id and the
    position, so reruns agree and repeated rows get the same ids, unless ``copy_col`` tells them apart; a null id counts
    as 0, and so does one that is no whole number (it is returned as null). Texts are encoded whole, whatever their
    length. Rows stay in the order of ``docs``. Other columns are ignored.
    """
    vocabulary = load_pieces(model_file)

    def work(batches):
        own = codec(vocabulary, seed, dropout)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keys = batch.column(2).to_numpy(zero_copy_only=False)
            for part in slices(texts):
                some = texts[part]
                ids, counts = own.encode(some, keys[part])
                back = own.decode(ids, counts)
                lossless = [b == t.encode("utf-8", "surrogatepass") for b, t in zip(back, some, strict=True)]
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(counts), pa.array(lossless, pa.bool_()),
                    *(c.slice(part.start, part.stop - part.start) for c in batch.columns[3:])], names=["id", "ids", "n_tokens", "lossless", *kept])

    number, kept = F.col(id_col).try_cast("long"), [f"keep_{c}" for c in keep]
    rows = docs.select(number.alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.xxhash64(F.lit(seed), F.coalesce(number, F.lit(0)), *([copy_col] if copy_col else [])).alias("key"),
        *[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)])
    types = "".join(f", {k} {docs.schema[c].dataType.simpleString()}" for c, k in zip(keep, kept, strict=True))
    out = rows.mapInArrow(work, f"id long, ids array<int>, n_tokens long, lossless boolean{types}")
    return out.withColumnsRenamed({"id": id_col, **dict(zip(kept, keep, strict=True))})


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The texts again: the id, text. Null or empty ids give an empty text; ids that are in no vocabulary, and bytes that
    are no UTF-8, become replacement characters.
    """
    vocabulary = load_pieces(model_file)

    def work(batches):
        own = codec(vocabulary)
        for batch in batches:
            lists = batch.column(1)
            counts = np.diff(np.asarray(lists.offsets))
            texts = own.decode(np.asarray(lists.flatten()), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())],
                names=["id", "text"])

    rows = encoded.select(F.col(id_col).try_cast("long").alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(work, "id long, text string").withColumnRenamed("id", id_col)
