"""Hard negatives, decontamination and ranked search against brute force, and what they do with odd tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import decontamination, hard_negatives, lexical
from strata.llm.hard_negatives import products

VECTORS = "vec_id long, embedding array<float>, label int, id long, score string, row int"


def mined(df):
    return sorted(tuple(r) for r in df.collect())


def brute_negatives(rows, positives=5, negatives=3):
    clean = [(i, [math.floor(256 * float(np.float32(x))) for x in v], k) for i, v, k, *_ in rows
        if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, v, k in clean:
        if i % 10:
            continue
        others = sorted(((-score(v, w), j, m) for j, w, m in clean if j != i))
        for p, j, _ in [o for o in others if o[2] == k][:positives]:
            fit = [(s, n) for s, n, m in others if m != k and 50 * -p <= 100 * -s <= 95 * -p][:negatives]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n) in enumerate(fit, 1)]
    return sorted(out)


def vectors(n, seed=1, width=6):
    r = random.Random(seed)
    rows = [(i, [r.choice([-0.5, -0.25, 0.1, 0.3, 0.5, 0.75]) for _ in range(width)], r.randrange(3), i, "x", 0) for i in range(n)]
    return rows + [(n + i, [0.5] * width, i % 3, 0, "hot", 1) for i in range(n // 2)]  # a third of all rows is one vector


@pytest.mark.parametrize("block_bytes", [600, 1 << 20])
def test_hard_negatives_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    rows = [*vectors(60), (-10, [0.5, 0.25], 0, 1, "short", 2), (-20, [], 1, 1, "empty", 2), (None, [0.5] * 6, 1, 1, "", 2), (500, None, 1, 1, "", 2),
        (510, [0.5, None], 1, 1, "", 2), (520, [float("nan")] * 6, 1, 1, "", 2), (530, [float("inf")] * 6, 1, 1, "", 2), (540, [0.5] * 6, None, 1, "", 2)]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), F.col("vec_id") % 10 == 0, block_bytes=block_bytes)
    assert mined(got) == brute_negatives(rows) != []


def test_hard_negatives_of_odd_tables(spark):
    empty = hard_negatives.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 10 == 0)
    assert empty.count() == 0 and empty.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    rows = [(0, [1.0], 1, 0, "", 0), (0, [1.0], 1, 0, "", 0), (1, [1.0], 1, 0, "", 0), (2, [0.9], 2, 0, "", 0), (2, [0.9], 2, 0, "", 0)]
    got = mined(hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 10 == 0))
    assert got == [(0, 1, 1, 2, 65536, 58880), (0, 1, 2, 2, 65536, 58880)]  # repeated candidates are rows, repeated anchors one
    assert hard_negatives.hard_negatives(spark.createDataFrame(rows, VECTORS), F.lit(False)).count() == 0


def test_products_are_exact_at_every_size():
    for bits in (10, 26, 30, 40):
        a = np.array([[2**bits + 1, -3], [2**bits - 1, 7]], dtype=np.int64)
        want = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(p, q, strict=True)))) for q in a] for p in a]
        assert products(a, a).tolist() == want


DOCS = "doc_id long, text string, item string, n_words long, key string"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_contamination(docs, items, window):
    out = []
    for i, text, *_ in docs:
        w, hit, named = words(text), set(), set()
        for item, body, *_ in items:
            b = words(body)
            for k in range(max(len(b) - window + 1, 1) if b else 0):
                part = b[k : k + window]
                for j in range(len(w) - len(part) + 1):
                    if w[j : j + len(part)] == part:
                        hit |= set(range(j, j + len(part)))
                        named.add("" if item is None else str(item))
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(named))))
    return sorted(out, key=str)


def odd_texts(seed=3):
    r = random.Random(seed)
    vocabulary = ["a", "b", "ab", "Aa", "ÀÉ", "x1", "9", "the", "İ", "ab"]
    some = lambda n: r.choice([" ", "-", "\n", "  "]).join(r.choice(vocabulary) for _ in range(n))
    items = [(i, some(r.choice([1, 3, 4, 5, 9, 14])), "c", 0, "") for i in range(12)] + [(3, some(6), "c", 0, ""), (None, some(5), "c", 0, ""), (70, None, "", 0, ""), (71, "?!", "", 0, "")]
    docs = [(i, some(r.choice([0, 1, 4, 30, 60])), "c", 0, "") for i in range(40)] + [(100 + k, f"{some(3)} {t[1]}, {some(4)}", "c", 0, "") for k, t in enumerate(items) if t[1]]
    return docs + [(200, None, "c", 0, ""), (201, "", "c", 0, ""), (None, items[1][1], "c", 0, ""), (7, "repeated " + items[2][1], "c", 0, ""), (7, "repeated " + items[2][1], "c", 0, "")], items


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_contamination_against_brute_force(spark, block_bytes):
    docs, items = odd_texts()
    frames = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame([(i, t, w) for i, t, _, _, w in items], "item_id long, text string, words string")
    got = decontamination.contamination(*frames, window=4, block_bytes=block_bytes).collect()
    flat = sorted(((r["doc_id"], r["n_words"], tuple(i for s in r["hits"] for i in range(s["start"], s["end"])), tuple(r["items"])) for r in got), key=str)
    assert flat == brute_contamination(docs, items, 4)
    assert all(a["end"] < b["start"] or a["end"] <= b["start"] for r in got for a, b in zip(r["hits"], r["hits"][1:], strict=False))
    clean = decontamination.without_contamination(*frames, window=4, block_bytes=block_bytes)
    hit = {i for i, _, h, _ in flat if h}
    assert clean.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d[0]) for d in docs if d[0] not in hit)


def test_contamination_of_empty_tables_and_long_texts(spark):
    docs, items = spark.createDataFrame([(1, "a b " * 200_000 + "once upon a time", "", 0, "")], DOCS), spark.createDataFrame([(5, "Once upon a time")], "item_id long, text string")
    nothing = spark.createDataFrame([], docs.schema), spark.createDataFrame([], items.schema)
    assert decontamination.contamination(docs, items).first()["hits"][0].asDict() == {"start": 400_000, "end": 400_004}
    assert decontamination.contamination(nothing[0], items).count() == 0
    assert decontamination.contamination(docs, nothing[1]).first().asDict() == {"doc_id": 1, "n_words": 400_004, "hits": [], "items": []}


def test_shifts_skip_most_positions():
    windows = [f" {hashlib.sha256(str(i).encode()).hexdigest()[:50]} ".encode() for i in range(1000)]
    tables = decontamination.Tables(windows)
    text = b" ".join(hashlib.sha256(str(i).encode()).hexdigest().encode() for i in range(5000, 9000)) + windows[7]

    class Looked(dict):
        n = 0

        def get(self, *a):
            Looked.n += 1
            return dict.get(self, *a)

    tables.shift = Looked(tables.shift)
    assert [w for _, w in tables.occurrences(text)] == [windows[7]]
    assert Looked.n < len(text) / 8


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_ranked(docs, items, k):
    own = [(i, Counter(terms(t)), len(terms(t))) for i, t, *_ in docs]
    n, length = sum(c > 0 for *_, c in own), sum(c for *_, c in own)
    df = Counter(t for _, tf, _ in own for t in tf)
    out = []
    for item, text, *_ in items:
        scored = []
        for i, tf, c in own:
            s = 0
            for t in terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    s += w * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * (75 + (25 * c * n) // length)))
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, rank, None if missing else i, -s) for rank, (s, missing, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def search_table(seed=5):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    some = lambda n: " ".join(r.choices(vocabulary, [1 / (i + 1) for i in range(60)], k=n)).title()
    docs = [(r.randrange(10**6), some(r.choice([1, 5, 20, 80])), "x", 0, "") for _ in range(300)]
    docs += [(10**7 + i, "w1 w2 w40", "x", 0, "") for i in range(150)]  # a third of all rows ties
    docs += [(None, "w2 w40 w41", "x", 0, ""), (-5, None, "x", 0, ""), (-6, "", "x", 0, ""), (docs[0][0], docs[0][1], "x", 0, "")]
    items = [(i, some(r.choice([1, 3, 12, 40]))) for i in range(15)] + [(15, None), (16, "?"), (17, "unknown"), (None, "w40 W40 w1"), (3, "w59")]
    return docs, items


@pytest.mark.parametrize(("block_terms", "block_docs"), [(1 << 18, 1 << 14), (120, 37)])
def test_search_against_brute_force(spark, monkeypatch, block_terms, block_docs):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", block_docs)
    docs, items = search_table()
    got = lexical.ranked(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, "item_id long, text string"), k=7, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_ranked(docs, items, 7)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b", "", 0, "")], DOCS), spark.createDataFrame([(5, "A")], "item_id long, text string")
    nothing = spark.createDataFrame([], docs.schema), spark.createDataFrame([], items.schema)
    assert lexical.ranked(nothing[0], items).count() == 0
    assert lexical.ranked(docs, nothing[1]).count() == 0
    assert [r[:3] for r in lexical.ranked(docs, items).collect()] == [(5, 1, 1)]


def test_walk_prunes_and_blocks_are_cut_by_postings(monkeypatch):
    r = random.Random(2)
    term = np.repeat(np.arange(4), 2000).astype(np.int64)
    place = np.concatenate([np.sort(r.sample(range(4000), 2000)) for _ in range(4)]).astype(np.int32)
    impacts = np.array([r.randrange(1, 100) for _ in term], dtype=np.int64)
    treaps = lexical.build(term, place, impacts)
    weights, top = np.array([50, 3, 2, 1]), lexical.Top(5)
    scored = lexical.walk(treaps, np.arange(4), weights, top, list(range(4000)))
    every = Counter()
    for t, p, i in zip(term.tolist(), place.tolist(), impacts.tolist(), strict=True):
        every[p] += int(weights[t]) * i
    assert list(zip(top.keys, top.scores.tolist(), strict=True)) == sorted(every.items(), key=lambda x: (-x[1], x[0]))[:5]
    assert scored < len(every) / 2
