import random
import re

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import sentencepiece as sp
from strata.llm.queries import PIECES

TEXTS = ["", "a", "  a  b ", "x\ny", "▁ literal ▁▁", "日本語 🎉", "a" * 3000 + " " + "th" * 200, "<s> </s> <0x41>\t\r\x00", " " * 70 + "z",
    "internationalization of the thing", "\n\n"]


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load_pieces(PIECES)


def encoded(codec, texts):
    ids, counts = codec.encode(texts, np.arange(len(texts), dtype=np.uint64))
    ends = np.concatenate([[0], np.cumsum(counts)])
    assert codec.decode(ids, counts) == [t.encode() for t in texts]
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)]


def test_without_dropout_it_is_the_library(vocabulary):
    texts = [t for t in TEXTS if "▁" not in t]
    assert encoded(sp.Codec(vocabulary), texts) == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(texts)


def finaliser(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain_agenda(vocabulary, chunk, key, dropout):
    """Of all neighbours that make a piece and are not skipped, the best merges, until none is left."""
    ids = {p: i for i, p in enumerate(vocabulary["pieces"]) if not vocabulary["special"][i] and not vocabulary["byte"][i]}
    spans = [(i, i + 1) for i in range(len(chunk))]
    said = lambda a, b: None if sp.MARK in chunk[a:b] else chunk[a:b].replace(" ", sp.MARK)
    while True:
        best = None
        for (a, b), (_, c) in zip(spans, spans[1:]):
            if (new := ids.get(said(a, c))) is None or ids.get(said(a, b)) is None or ids.get(said(b, c)) is None:
                continue
            skipped = finaliser(key ^ finaliser(((a << 42 ^ b << 21 ^ c) + 0x9E3779B97F4A7C15) % 2**64)) < min(int(dropout * 2.0**64), 2**64 - 1)
            if not skipped and (best is None or (-vocabulary["scores"][new], new, a) < best[0]):
                best = (-vocabulary["scores"][new], new, a), (a, b, c)
        if best is None:
            break
        a, b, c = best[1]
        spans = [s for s in spans if s not in ((a, b), (b, c))] + [(a, c)]
        spans.sort()
    byte = {int(p[3:5], 16): i for i, p in enumerate(vocabulary["pieces"]) if vocabulary["byte"][i]}
    return [x for a, b in spans for x in ([ids[said(a, b)]] if said(a, b) in ids else [byte[v] for v in chunk[a:b].encode()])]


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_against_a_plain_agenda(vocabulary, dropout):
    r = random.Random(1)
    words = ["".join(r.choice("theandoré▁漢🎉\x00") for _ in range(r.randint(0, 20))) for _ in range(300)] + ["internationalization"] * 30 + ["x" * 80, "\n",
        "the" * 30]
    r.shuffle(words)
    texts = [" ".join(words[:150]), " ".join(words[150:]), "", "a"]
    codec = sp.Codec(vocabulary, 9, dropout)
    for k, (text, found) in enumerate(zip(texts, encoded(codec, texts), strict=True)):
        parts = re.findall("\n| +[^ \n]*|[^ \n]+", " " + text) if text else []
        keys = [finaliser((k + finaliser(i + 9)) % 2**64) for i in range(len(parts))]
        assert found == [x for part, key in zip(parts, keys, strict=True) for x in plain_agenda(vocabulary, part, key, dropout)]


def test_dropout_varies_and_repeats(vocabulary):
    text = ["the international thing " * 40] * 3
    one, other = encoded(sp.Codec(vocabulary, 1, 0.3), text), encoded(sp.Codec(vocabulary, 2, 0.3), text)
    assert one == encoded(sp.Codec(vocabulary, 1, 0.3), text) and one != other and one[0] != one[1]
    assert len(one[0]) > len(encoded(sp.Codec(vocabulary), text)[0])
    everything = encoded(sp.Codec(vocabulary, 1, 1.0), ["abc"])[0]
    assert len(everything) == 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=60), max_size=4))
def test_any_text_is_decoded(vocabulary, texts):
    encoded(sp.Codec(vocabulary, 7, 0.2), texts)


def test_forgetting_changes_nothing(vocabulary, monkeypatch):
    want = encoded(sp.Codec(vocabulary, 1, 0.3), TEXTS)
    monkeypatch.setattr(sp, "REMEMBERED", 2)
    codec = sp.Codec(vocabulary, 1, 0.3)
    for _ in range(2):
        assert encoded(codec, TEXTS) == want


def test_dataframes(spark, vocabulary):
    rows = [(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, None, 2), (0, TEXTS[0], 3), (99, "word " * 60_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int").repartition(3)
    out = sp.encode(docs, PIECES, seed=5, dropout=0.2)
    found = out.collect()
    assert len(found) == len(rows) and all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in found)
    back = sp.decode(out, PIECES).collect()
    assert sorted((str(r[0]), r[1]) for r in back) == sorted((str(i), t or "") for i, t, _ in rows)
    again = {(r["doc_id"], tuple(r["ids"])) for r in sp.encode(docs.coalesce(1), PIECES, seed=5, dropout=0.2).collect()}
    assert again == {(r["doc_id"], tuple(r["ids"])) for r in found}
    assert sp.encode(docs.limit(0), PIECES).count() == 0


def spelt(codec, chunk, key):
    ids, _ = codec.with_bytes(np.array(codec.segment_one(chunk, key), dtype=np.int32), np.array([0]))
    return ids.tolist()


def test_every_occurrence_draws_alone(vocabulary):
    """A frequent word takes many segmentations, each by its own keys, and those are the agenda's."""
    word, n = " internationalization", 3000
    codec = sp.Codec(vocabulary, 9, 0.2)
    ids, _ = codec.encode([word[1:] + word * (n - 1)], np.array([5], dtype=np.uint64))
    keys = sp.mixed(np.full(n, 5, dtype=np.uint64) + sp.mixed(np.arange(n, dtype=np.uint64) + np.uint64(9)))
    want = [spelt(codec, word, int(k)) for k in keys]
    assert ids.tolist() == [x for some in want for x in some]
    assert len({tuple(x) for x in want}) > 40
    mixed = [" the", " thing", "日本語の国", " internationalization", "\n", " " + "a" * 30, " " + "th" * 40]
    r = random.Random(2)
    chunks = [r.choice(mixed) for _ in range(2000)]
    chunks[0] = " the"
    ids, _ = codec.encode(["".join(chunks)[1:]], np.array([6], dtype=np.uint64))
    parts = re.findall("\n| +[^ \n]*|[^ \n]+", "".join(chunks))
    keys = sp.mixed(np.full(len(parts), 6, dtype=np.uint64) + sp.mixed(np.arange(len(parts), dtype=np.uint64) + np.uint64(9)))
    assert ids.tolist() == [x for c, k in zip(parts, keys, strict=True) for x in spelt(codec, c, int(k))]


def test_only_long_chunks(vocabulary):
    assert len(encoded(sp.Codec(vocabulary, 1, 0.2), ["a" * 100])[0]) > 1


def test_copies_differ(spark):
    docs = spark.createDataFrame([(1, "the international thing " * 20, k) for k in range(3)], "doc_id long, text string, place long")
    found = {tuple(r["ids"]) for r in sp.encode(docs, PIECES, dropout=0.2, copy_col="place").collect()}
    assert len(found) == 3


def test_models_that_are_alike_have_their_own_codecs(vocabulary):
    other = vocabulary | {"scores": [*vocabulary["scores"][:-1], 1.0], "digest": "another"}
    assert sp.codec(vocabulary, 1) is sp.codec(vocabulary, 1) and sp.codec(vocabulary, 1) is not sp.codec(other, 1)


def test_ids_of_no_vocabulary_and_odd_document_ids(spark):
    back = sp.decode(spark.createDataFrame([("x", [-1, 10**6]), ("2", None), (None, [])], "doc_id string, ids array<int>"), PIECES)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == [("2", ""), ("None", ""), ("None", "\ufffd\ufffd")]
    docs = spark.createDataFrame([("x", "a b", 1), ("7", "a b", 2)], "doc_id string, text string, n int")
    got = sp.encode(docs, PIECES, keep=("n",)).collect()
    assert [(r["doc_id"], r["lossless"], r["n"]) for r in got] == [(None, True, 1), (7, True, 2)]
