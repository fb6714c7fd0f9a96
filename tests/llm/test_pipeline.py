"""The pipeline against brute force: what each stage keeps of what its predecessor kept."""

import importlib
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing

quality = importlib.import_module("tests.llm.test_quality")
near = importlib.import_module("tests.llm.test_jaccard")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(4)
    rows = []
    for i, (_, text, *_) in enumerate(near.corpus(6, n_groups=25, most=5, passage=False)):
        rows.append((i, text, r.choice(["en", "de"]), r.choice(["a", "b", None]), 0))
    for i, (_, text, lang, source, *_) in enumerate(quality.corpus(3)):
        rows.append((1000 + i, text, lang, source, 0))
    return rows + [(2000 + i, rows[i][1], "en", "b", 0) for i in range(0, 300, 5)]


def test_run(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    _, kept = quality.strict(spark, rows)
    stay = [row for row, k in zip(rows, kept, strict=True) if k]
    largest = defaultdict(int)
    for i, text, *_ in stay:
        largest[text] = max(largest[text], i)
    stay = [row for row in stay if largest[row[1]] == row[0]]
    component = near.brute(stay)
    stay = [row for row in stay if component[row[0]][1] == row[0]]
    assert 50 < len(stay) < len(rows)

    assert all(r["lossless"] for r in got) and {r["doc_id"] for r in got} <= {row[0] for row in stay}
    copies, words = defaultdict(int), {row[0]: len(row[1].split()) for row in stay}
    for r in got:
        copies[r["doc_id"]] += 1
    assert max(copies.values()) <= 3
    order = [(r["mix_shard"], r["mix_place"]) for r in got]
    assert order == sorted(order) and len({s for s, _ in order}) > 1  # encoded shards in their drawn order
    several = defaultdict(list)
    for r in got:
        several[r["doc_id"]].append(r["ids"])
    assert any(a != b for a, b, *_ in (x for x in several.values() if len(x) > 1))
    names = sorted({row[3] for row in stay}, key=lambda s: (s is None, s or ""))
    own = [[row for row in stay if row[3] == name] for name in names]
    targets = mixing.source_targets([sum(words[row[0]] for row in mine) for mine in own])
    for mine, target in zip(own, targets, strict=True):
        assert abs(sum(copies[row[0]] * words[row[0]] for row in mine) - target) <= max(words[row[0]] for row in mine) / 2 + 1e-9


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame(corpus()[:80], SCHEMA)
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns + (["mix_shard", "mix_place", "mix_copy"] if name == "mixing" else [])
        assert stage(spark, docs.limit(0), "").count() == 0


def test_stages_take_nulls_repeats_and_other_columns(spark):
    """Each stage by itself: nulls in every column, repeated rows, a very long text, columns that operators use inside."""
    rows = corpus()[:60]
    rows += [(None, rows[3][1], None, None, None), (None, None, None, None, None), (9001, None, "en", "a", 0), (9002, "", None, "b", 0), rows[5], rows[5],
        (9003, "word and more " * 20_000, "en", "a", 0), (9004, rows[5][1], "en", "a", 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    odd = ["id", "row_key", "digest", "salt", "h", "size", "block", "copies", "component_id", "kept", "text_key", "mix_shard", "key"]
    docs = docs.select("*", *[F.lit("x").alias(c) for c in odd]).repartition(3)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        got = out.collect()
        if name == "quality rules":
            assert all(r["text"] for r in got) and sum(r["doc_id"] == rows[5][0] for r in got) in (0, 3)
        elif name == "exact dedup":
            assert len(got) == len({r[1] or "" for r in rows}) and Counter(r["text"] or "" for r in got) == Counter({r[1] or "" for r in rows})
        elif name == "n-gram Jaccard join":
            assert sum(r["text"] is None or r["text"] == "" for r in got) == 3 and sum(r["doc_id"] == 9004 for r in got) == 0
        elif name == "mixing":
            assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
        else:
            assert len(got) == len(rows) and all(r["lossless"] for r in got)
        if name != "SentencePiece encoding":
            assert out.columns == corpus_pipeline.COLUMNS + (["mix_shard", "mix_place", "mix_copy"] if name == "mixing" else [])


def test_steps_release_what_they_shuffled(spark, monkeypatch):
    """The driver is told to let go of each step's plans and shuffles, in the stages that once did so only at the end."""
    from strata.llm import common

    calls = []
    monkeypatch.setattr(common, "tidy", lambda spark: calls.append(1))
    docs = spark.createDataFrame([(i, f"word{i % 3} of a text", "en", "web", 16) for i in range(6)], "doc_id long, text string, lang string, source string, n_chars long")
    for stage in (corpus_pipeline.exact_duplicates, corpus_pipeline.mixture):
        calls.clear()
        assert stage(spark, docs, "").count() > 0 and len(calls) >= 3
