from collections import defaultdict

from pyspark.sql import functions as F

from strata.llm.exact_dedup import drop_exact_duplicates, exact_duplicates

SCHEMA = "doc_id long, text string, digest string, n int"
ROWS = [(1, "a", "x", 1), (2, "b", None, 2), (3, "a", "y", 3), (4, None, "z", 4), (5, "", "z", 5), (6, "b", "z", 6), (6, "b", "z", 6), (None, "c", "z", 7),
    (None, "a", "z", 8), (7, "x" * 200_000, "", 1), (8, "x" * 200_000, "", 1)]


def brute(rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[text or ""].append(i)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, best[t or ""], len(groups[t or ""]), i == best[t or ""]) for i, t, *_ in rows), key=str)


def got(df):
    return sorted((tuple(r)[:4] for r in df.collect()), key=str)


def test_against_brute_force(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert got(exact_duplicates(docs, salts=4)) == brute(ROWS)


def test_digests_that_collide(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    assert got(exact_duplicates(docs, digest=lambda t: F.length(t).cast("string"))) == brute(ROWS)
    assert got(exact_duplicates(docs, digest=lambda t: F.lit("same"))) == brute(ROWS)


def test_empty_and_dropping(spark):
    assert exact_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame(ROWS, SCHEMA)
    stay = drop_exact_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted((str(r["doc_id"]) for r in stay.collect())) == ["3", "5", "6", "8", "None"]


def test_columns_of_any_name_stay(spark):
    from strata.llm import common, decontamination, jaccard, quality

    docs = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "doc_id long, text string")
    odd = docs.select("*", *[F.lit(f"{i}").alias(c) for i, c in enumerate(["__at", "__word", "__bits", "__maybe", "__own", "__w_id", "__w_digest", "__MAYBE_", "__w_row_key", "lang", "source"])])
    stay = drop_exact_duplicates(odd)
    assert stay.columns == odd.columns and sorted((r["doc_id"], r["__own"], r["__MAYBE_"]) for r in stay.collect()) == [(2, "4", "7"), (3, "4", "7")]
    for rows in (jaccard.one_per_component(odd), quality.keep_good(odd), decontamination.without_contamination(odd, spark.createDataFrame([(1, "b")], "item_id long, text string"))):
        assert rows.columns == odd.columns
    kept = common.rows_in(odd, docs.where("doc_id < 3").select(F.col("doc_id").alias("id")), {"id": F.col("doc_id")})
    assert kept.columns == odd.columns and kept.count() == 2
