"""License scans: TF-IDF cosine of header lines and licence files to templates, and inheritance by directory.

Every line of every text, and every whole text, is a sparse vector: a word's weight is how often the unit has it, times
the inverse frequency that the word has among all lines of the corpus. Only what depends on the templates leaves the
executors: the frequencies of their words.

Few units can be like a template at all. Of each template heavy, rare words are set apart, until the others together are
too light: a unit with none of the words set apart cannot reach the threshold, whatever else it holds. Texts that
hold such a word give their lines and themselves as units, whose cosines are sums of products over joins by word.

A text without a licence of its own inherits that of the nearest ancestor directory with a licence file: distinct
directories are exploded to their ancestors and joined by path.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import salted_join, settled, text_of
from strata.llm.licence_texts import BOILERPLATE, TEMPLATES

TOKEN = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"
#: The weight of a word that is in every line.
LEAST = 0.1
FILE_NAME = r"(?i)(?:^|/)(?:licen[cs]e|copying|notice|unlicense)(?:[.-][a-z0-9.-]+)?$"


def tokens_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", text.lower())


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def counted(words: Column) -> Column:
    """The distinct words of an array with their numbers, by runs of the sorted array."""
    first = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
    runs = lambda s: F.transform(F.array(first(s)),
        lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("tf"))))
    some = F.when(F.size(words) > 0, F.array(F.array_sort(words))).otherwise(F.array().cast("array<array<string>>"))
    return F.flatten(F.flatten(F.transform(some, runs)))


class Vectors:
    """The templates as vectors, under the corpus's weights."""

    def __init__(self, templates: dict[str, list[str]], idf: dict[str, float]):
        self.rows, self.weights, self.idf = [], [], idf
        for licence, texts in templates.items():
            for k, text in enumerate(texts):
                own = {w: n * idf[w] for w, n in Counter(tokens_of(text)).items()}
                size = math.sqrt(sum(v * v for v in own.values()))
                self.weights.append((own, size))
                self.rows += [(licence, k, w, v * idf[w] / size) for w, v in sorted(own.items())]

    def needed(self, least: float) -> set[str]:
        """Words of which a unit needs one at least to reach a cosine of ``least`` with any template.

        Words that weigh much in a template and are in few lines of the corpus come first, so that few units have one.
        """
        found = set()
        for own, size in self.weights:
            rest = size * size
            for word, weight in sorted(own.items(), key=lambda x: (-x[1] * x[1] * math.exp(self.idf[x[0]]), x[0])):
                if math.sqrt(max(rest, 0.0)) < least * size * (1 - 1e-9):
                    break
                found.add(word)
                rest -= weight * weight
        return found


def holds(words: Column, needed: set[str]) -> Column:
    return F.exists(words, lambda w: w.isin(*sorted(needed)))


def scored(units: DataFrame, keys: list[str], weights: DataFrame, vectors: Vectors, least: float, salts: int) -> DataFrame:
    """Units are distinct by their keys. keys, licence, cosine of the best template of each unit (column ``words``) that reaches ``least``, and lead: how much
    less the best template of any other licence has (all of the cosine, if none reaches ``least``).
    """
    units = units.where(holds(F.col("words"), vectors.needed(least)))
    terms = settled(units.select(*keys, F.explode(counted(F.col("words"))).alias("t")).select(*keys, "t.term", "t.tf"))
    names = [f"n_{k}" for k in keys]
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"n_{k}"))
    # The templates' words are a fixed list, whatever the data. Those with k = -1 give the part of the norm that they make up,
    # which is enough to leave out most units before the corpus's weights are joined.
    table = F.broadcast(terms.sparkSession.createDataFrame(vectors.rows + [("", -1, w, v) for w, v in sorted(vectors.idf.items())],
        "licence string, k int, term string, part double"))
    part = F.col("tf") * F.col("part")
    dots = terms.join(table, "term").groupBy(*keys, "licence", "k").agg(F.sum(F.when(F.col("k") < 0, part * part).otherwise(part)).alias("dot"))
    every = dots.groupBy(*keys).agg(F.max(F.when(F.col("k") < 0, F.col("dot"))).alias("known"), F.collect_list(F.when(F.col("k") >= 0,
        F.struct("licence", "k", "dot"))).alias("dots"))
    near = F.filter("dots", lambda d: d["dot"] >= least * (1 - 1e-6) * F.sqrt("known"))
    dots = settled(every.select(*keys, near.alias("dots")).where(F.size("dots") > 0))
    ends = dots.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])
    terms = terms.join(ends, same, "left_semi")
    own = settled(weights.join(terms.select("term").distinct(), "term", "left_semi"))
    weighed = salted_join(terms, own, ["term"], salts, keys, "inner")
    norms = settled(weighed.groupBy(*keys).agg(F.sqrt(F.sum(F.pow(F.col("tf") * F.col("weight"), 2))).alias("norm")))
    dots = dots.join(norms.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], "norm"), same)
    dots = dots.select(*keys, "norm", F.explode("dots").alias("d")).select(*keys, "norm", "d.licence", "d.dot")
    dots = dots.select(*keys, "licence", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= least)
    each = dots.groupBy(*keys, "licence").agg(F.max("cosine").alias("cosine"))
    ordered = F.array_sort(F.collect_list(F.struct(boilerplate(F.col("licence")), (-F.col("cosine")).alias("minus"), "licence")))
    best = each.groupBy(*keys).agg(ordered.alias("all"))
    lead = F.coalesce(F.get("all", F.lit(1))["minus"], F.lit(0.0)) - F.get("all", F.lit(0))["minus"]
    return settled(best.select(*keys, F.get("all", F.lit(0))["licence"].alias("licence"), (-F.get("all", F.lit(0))["minus"]).alias("cosine"), F.round(lead, 9).alias("lead")))


def boilerplate(licence: Column) -> Column:
    return licence.isin(BOILERPLATE).alias("any")


def ancestors(directory: Column) -> Column:
    """The directory and those above it, up to the root ''."""
    parts = F.split(directory, "/")
    return F.array_distinct(F.concat(F.array(F.lit("")),
        F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))))


def line_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """term, n: in how many lines it stands; the term '' stands for lines with any word."""
    lines = docs.select(F.explode(F.split(text_of(text_col), "\n", -1)).alias("said")).select(F.array_distinct(tokens(F.col("said"))).alias("words"))
    return lines.where(F.size("words") > 0).select(F.explode(F.array_append("words",
        F.lit(""))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def scan(docs: DataFrame, path: str | Column, id_col: str = "doc_id", text_col: str = "text", header: float = 0.6, file: float = 0.5,
    templates: dict[str, list[str]] = TEMPLATES, salts: int = 16) -> DataFrame:
    """One row per row of ``docs``: the id, path, own_licence, cosine, line (-1: the whole text), is_file, licence,
    inherited_from (directory), lead (of own_licence over the next licence in that line or text).

    Words that any licence may say of itself ("all rights reserved") name a licence only where nothing else does.

    A file is a licence file if its whole text is like a template, no less than any of its lines, or if its name says
    so and a line is; it speaks for its directory, by its highest cosine (boilerplate last), then by path and name. A header's licence
    stands before an inherited one. Null texts are empty, a null path is the root's; repeated rows have equal results;
    an empty table gives no rows. Texts are compared whole, whatever their length; other columns are ignored, whatever
    their names.
    """
    text = text_of(text_col)
    where = F.coalesce(F.col(path) if isinstance(path, str) else path, F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text, where).alias("row_key"), where.alias("path"), text.alias("text"))
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in tokens_of(t)})
    frequencies = settled(line_frequencies(docs, text_col))
    seen = {r["term"]: r["n"] for r in frequencies.where(F.col("term").isin("", *vocabulary)).collect()}  # words of the templates
    total = seen.get("", 0)
    vectors = Vectors(templates, {w: math.log((1 + total) / (1 + seen.get(w, 0))) + LEAST for w in vocabulary})
    weights = frequencies.where("term <> ''").select("term", (F.log(F.lit(1.0 + total) / (1 + F.col("n"))) + LEAST).alias("weight"))

    likely = rows.select("id", "row_key", "text").where(holds(tokens(F.col("text")), vectors.needed(min(header, file))))
    likely = settled(likely.dropDuplicates(["id", "row_key"]))
    keys = ["id", "row_key", "line"]
    lines = likely.select("id", "row_key", F.posexplode(F.split("text", "\n", -1)).alias("line", "said")).select(*keys, tokens(F.col("said")).alias("words"))
    of_lines = scored(lines, keys, weights, vectors, header, salts)
    of_texts = scored(likely.select("id", "row_key", F.lit(-1).alias("line"), tokens(F.col("text")).alias("words")), keys, weights, vectors, file, salts)
    best = F.min(F.struct(boilerplate(F.col("licence")), (-F.col("cosine")).alias("minus"), "line", "licence", "lead"))
    own = of_lines.unionByName(of_texts).groupBy("id", "row_key").agg(best.alias("best"))
    own = settled(own.select(F.col("id").alias("o_id"), F.col("row_key").alias("o_key"), F.col("best.licence").alias("own_licence"),
        (-F.col("best.minus")).alias("cosine"), F.col("best.line").alias("line"), F.col("best.lead").alias("lead")))

    paths = rows.select("id", "row_key", "path")
    named = paths.join(own, paths["id"].eqNullSafe(own["o_id"]) & (paths["row_key"] == own["o_key"]), "left").drop("o_id", "o_key")
    is_file = F.col("own_licence").isNotNull() & ((F.col("line") < 0) | F.col("path").rlike(FILE_NAME))
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    named = settled(named.select("id", "row_key", "path", directory.alias("directory"), "own_licence", "cosine", "line", "lead",
        F.coalesce(is_file, F.lit(False)).alias("is_file")))
    holders = named.where("is_file").groupBy("directory").agg(F.min(F.struct(boilerplate(F.col("own_licence")), (-F.col("cosine")).alias("minus"), "path", "own_licence")).alias("best"))
    holders = holders.select(F.col("directory").alias("holder"), F.col("best.own_licence").alias("licence"))
    ways = named.where("own_licence is null").select("directory").distinct()
    ways = ways.select("directory", F.explode(ancestors(F.col("directory"))).alias("holder"))
    # Every directory comes to the root and to the shallow ones, which are dealt to many tasks.
    nearest = salted_join(ways, holders, ["holder"], salts, ["directory"],
        "inner").groupBy("directory").agg(F.max_by(F.struct("holder", "licence"), F.length("holder")).alias("near"))
    nearest = settled(nearest.select("directory", F.col("near.holder").alias("inherited_from"), F.col("near.licence").alias("inherited")))
    final = salted_join(named, nearest, ["directory"], salts, ["id", "row_key"])
    return final.select(F.col("id").alias(id_col), "path", "own_licence", "cosine", "line", "is_file", F.coalesce("own_licence", "inherited").alias("licence"),
        F.when(F.col("own_licence").isNull(), F.col("inherited_from")).alias("inherited_from"), "lead")
