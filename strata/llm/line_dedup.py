"""Line dedup by the spread of lines over distinct sites.

A line that many sites carry is boilerplate. Lines are hashed, and one aggregation, in tasks first and then across
them, merges a HyperLogLog sketch of the sites per line hash. Lines whose estimate is clear of their threshold by more
than ``margin`` are decided by it; those near the threshold get an exact distinct count, for which only they are read
again. Lines seen fewer times than the threshold cannot be on so many sites.

Lines of less than ``long_words`` words are boilerplate from ``least_sites`` sites on. Long lines are not repeated by
chance: they are from ``long_sites`` sites on, if they stand in different texts: copies of one whole text are no
boilerplate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, bitmap, cut, salted_join, text_of, with_maybe

#: The characters that are no word's.
SPACE = " \t\n\x0b\f\r"


def trimmed(line: Column | str) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_hash(line: Column) -> Column:
    """128 bits, so that different lines don't meet at any size; white space at the ends does not count."""
    return F.unhex(F.substring(F.sha2(trimmed(line), 256), 1, 32))


def site_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site: str | Column = "source") -> DataFrame:
    """id, row_key, site, text_key, line (from 0), chars, words, hash of every line with a word."""
    place = F.col(site) if isinstance(site, str) else site
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row_key"),
        F.coalesce(place.cast("string"), F.lit("\x00")).alias("site"), F.xxhash64(text).alias("text_key"),
        F.posexplode(F.split(text, "\n", -1)).alias("line", "said"))
    rows = rows.where(trimmed("said") != "")
    return rows.select("id", "row_key", "site", "text_key", "line", F.length("said").alias("chars"), F.regexp_count("said", F.lit(WORD)).alias("words"),
        line_hash(F.col("said")).alias("hash"))


def spread_of(lines: DataFrame, least_sites: int = 10, lg_k: int = 12, long_words: int = 50, long_sites: int = 2) -> DataFrame:
    """hash, least (the line's threshold), sites (estimated) of the lines that are seen often enough for it."""
    # A line of so many words has as many characters and spaces between them; others need no count of words.
    long = F.when(F.col("chars") >= 2 * long_words - 1, F.col("words") >= long_words).otherwise(False)
    seen = lines.select("hash", "site", "text_key", long.alias("long")).groupBy("hash").agg(
        F.count(F.lit(1)).alias("n"), F.first("long").alias("long"), F.min("text_key").alias("one"), F.max("text_key").alias("other"),
        F.hll_sketch_agg("site", F.lit(lg_k)).alias("sketch"))
    seen = seen.withColumn("least", F.when(F.col("long"), long_sites).otherwise(least_sites))
    seen = seen.where((F.col("n") >= F.col("least")) & (~F.col("long") | (F.col("one") != F.col("other"))))
    return cut(seen.select("hash", "least", F.hll_sketch_estimate("sketch").cast("long").alias("sites")))


def near_threshold(spread: DataFrame, margin: float = 0.2) -> DataFrame:
    """The lines that an estimate cannot decide."""
    return spread.where(F.col("sites").between(F.floor(F.col("least") * (1 - margin)), F.ceil(F.col("least") * (1 + margin))))


def exact_sites(lines: DataFrame, near: DataFrame) -> DataFrame:
    """hash, sites (counted) of the lines in ``near``. Only their distinct sites are shuffled."""
    maybe = with_maybe(lines.select("hash", "site"), bitmap(near, "hash"), "hash").where("__maybe").select("hash", "site").distinct()
    return maybe.join(near.select("hash"), "hash", "left_semi").groupBy("hash").agg(F.count(F.lit(1)).alias("sites"))


def boilerplate(lines: DataFrame, margin: float = 0.2, **thresholds) -> DataFrame:
    """hash of the lines on at least as many sites as their threshold says, with sites: estimated, or exact near it."""
    spread = spread_of(lines, **thresholds)
    near = near_threshold(spread, margin)
    clear = spread.join(near.select("hash"), "hash", "left_anti").where(F.col("sites") >= F.col("least")).select("hash", "sites")
    exact = exact_sites(lines, near).join(near.select("hash", "least"), "hash").where(F.col("sites") >= F.col("least")).select("hash", "sites")
    return cut(clear.unionByName(exact))


def marked_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site: str | Column = "source", **thresholds) -> DataFrame:
    """One row per row of ``docs``: the id, row_key, n_lines (with a word), removed (line numbers), removed_chars.

    Null texts have no lines, a null site is a site of its own, repeated rows have equal results. An empty table
    gives no rows. Lines without a word are never boilerplate. Texts are read whole, and other columns are ignored,
    whatever their names.
    """
    lines = site_lines(docs, id_col, text_col, site)
    found = boilerplate(lines, **thresholds).select("hash")
    # A line that stands in a third of all texts is dealt to many tasks.
    likely = with_maybe(lines.select("id", "row_key", "line", "chars", "hash"), bitmap(found, "hash"), "hash").where("__maybe").drop("__maybe")
    hits = salted_join(likely, found, ["hash"], 16, ["row_key", "line"], "inner").groupBy("id",
        "row_key").agg(F.sort_array(F.collect_set(F.struct("line", "chars"))).alias("hits"))
    hits = hits.select(F.col("id").alias("h_id"), F.col("row_key").alias("h_key"), "hits")
    text = text_of(text_col)
    worded = F.size(F.filter(F.split(text, "\n", -1), lambda x: trimmed(x) != ""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row_key"), worded.cast("long").alias("n_lines"))
    rows = rows.join(hits, rows["id"].eqNullSafe(hits["h_id"]) & (rows["row_key"] == hits["h_key"]), "left")
    removed = F.coalesce(F.transform("hits", lambda h: h["line"]), F.array().cast("array<int>"))
    chars = F.coalesce(F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + h["chars"]), F.lit(0).cast("long"))
    return rows.select(F.col("id").alias(id_col), "row_key", "n_lines", removed.alias("removed"), chars.alias("removed_chars"))


def without_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the lines taken out of the text; texts without boilerplate stay as they are, null included.

    Texts of any length are one row; repeated rows stay and are treated alike. Names that begin with ``__`` are for
    the operator's own columns.
    """
    marks = marked_lines(docs, id_col, text_col, **options).where(F.size("removed") > 0).select(F.col(id_col).alias("__id"), F.col("row_key").alias("__row"),
        F.col("removed").alias("__removed")).dropDuplicates(["__id", "__row"])
    rows = docs.withColumn("__key", F.xxhash64(F.col(id_col), text_of(text_col)))
    rows = rows.join(marks, rows[id_col].eqNullSafe(marks["__id"]) & (rows["__key"] == marks["__row"]), "left")
    gone = F.map_from_arrays("__removed", "__removed")
    kept = F.array_join(F.filter(F.split(text_col, "\n", -1), lambda _, i: ~F.map_contains_key(gone, i)), "\n")
    return rows.withColumn(text_col, F.when(F.col("__removed").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)
