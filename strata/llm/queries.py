"""The queries of the training-data operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import chat, decontamination, exact_dedup, hard_negatives, jaccard, lexical, licences, line_dedup, mixing, pii, quality, sentencepiece, sharding
from strata.llm.common import cut, table
from strata.llm.licence_texts import FILED, whole_text

#: Where the public tokenizers' files are.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def op1_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no paths of their own. They lie in eight folders under source/lang; a short one that ends with a
    word of licences has the name of a licence file, and lies in its folder or, if its id is even, above the folders.
    Every source/lang also has a folder with the whole text of a licence.
    """
    base = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")))
    folder = F.concat_ws("/", base, F.concat(F.lit("d"), F.pmod("doc_id", F.lit(8)).cast("string")))
    named = (F.length("text") < 1000) & F.substring_index("text", "\n", -1).rlike(r"(?i)licen[cs]e")
    file = F.concat_ws("/", F.when(F.col("doc_id") % 2 == 0, base).otherwise(folder), F.concat(F.lit("LICENSE."), F.col("doc_id").cast("string")))
    path = F.when(named, file).otherwise(F.concat_ws("/", folder, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"), base.alias("base"))
    # Every source/lang has a whole licence text in a folder of its own, by its name; ids of these are negative.
    own = F.pmod(F.xxhash64("base"), F.lit(1 << 40))
    texts = F.array(*[F.lit(whole_text(name)) for name in FILED])
    # They are cut, as Spark would look for words in the licence of every document.
    filed = cut(docs.select("base").distinct()).select((-1 - own).alias("doc_id"), F.get(texts, F.pmod(own, F.lit(len(FILED))).cast("int")).alias("text"),
        F.concat_ws("/", "base", F.lit("legal"), F.lit("terms.txt")).alias("path"))
    return licences.scan(docs.drop("base").unionByName(filed), "path")


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents"), PIECES, seed=2024, dropout=0.1)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.personal_data(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in [*pii.KINDS, *pii.ADDED.values()]])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < len(pii.KINDS))
    protected = F.filter("spans", lambda s: (s["kind"] < len(pii.KINDS)) | (s["kind"] == 6))
    return found.select("doc_id", *[n(k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)], F.sha2(said(base), 256).alias("base_sha256"),
        said("spans").alias("spans"), F.size(protected).cast("long").alias("n_protected"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("text_digest", "text_sha256")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    chats = chat.read_back(chat.format_chats(turns.unionByName(extra)))
    texts = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform("loss_spans", lambda s: chat.unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))), "")
    chats = chats.select("conv_id", "formatted", F.size("turns").cast("long").alias("n_turns"), F.sha2(texts, 256).alias("turns_sha256"), loss.alias("loss"))
    return chats.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.hilbert_shards(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.marked_lines(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.transform("removed", lambda i: i.cast("string")), ",").alias("removed"), "removed_chars")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.mix(table(spark, sf_dir, "documents"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"),
        F.array_join(F.transform("shards", lambda s: s.cast("string")), ",").alias("shards"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"), **quality.STRICT)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("distance", 6).alias("distance"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose id is divisible by 50; every seventh label is noise."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label_col=label)


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_licences, op2_sentencepiece, op3_pii, op4_exact_dedup, op5_chat, op6_hilbert_sharding, op7_line_dedup, op8_mixing,
        op9_quality, op10_jaccard, op11_hard_negatives,
        op12_decontamination, op13_lexical, pipeline)}


OP4 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op5_sql() -> str:
    escaped = "replace(t.text, '\\', '\\\\')"
    for c in chat.CONTROLS:
        escaped = f"replace({escaped}, '{c}', '{c[0]}\\{c[1:]}')"
    wide = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length({escaped}) AS n, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n + CASE WHEN before IS NOT DISTINCT FROM role THEN {len(chat.MORE)} ELSE {wide} + length(role) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


OP11 = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, list_inner_product(a.v, r.v)::BIGINT AS score
  FROM e a JOIN e r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


OP12 = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), starts AS (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + 9], ' ') AS t FROM starts
), places AS (
  SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM windows))
), found AS (
  SELECT r, i, k, item_id FROM places JOIN windows USING (k, t)
), words AS (
  SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS j FROM found) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS named FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""


OP13 = """
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL
), c AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0
), q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark
), p AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
), t AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM p, c GROUP BY term, n_docs
), s AS (
  SELECT item_id, r, doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN t USING (term), c GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4, "op5_chat": op5_sql(), "op11_hard_negatives": OP11, "op12_decontamination": OP12,
        "op13_lexical": OP13}
