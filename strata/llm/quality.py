"""Quality rules: base counts, and robust multivariate outliers per language and source.

Whole texts give counts in one narrow pass of Spark expressions. Ratios of the counts, log-transformed and rounded
to 1/256, form a vector per document. For each (language, source) the minimum-covariance-determinant estimate is
found by concentration steps: from several starts on, the ``support`` share of rows with the smallest distances gives
the next mean and covariance, and the estimate with the least determinant wins. A document whose Mahalanobis distance
is beyond the cut-off is rejected.

Vectors are whole numbers, so sums of their moments do not depend on the order in which tasks finish; they are added
per cell of the rounded distances, of which a group has a few thousand at most. No group is gathered anywhere: all
that a group needs is sums and histograms of bounded size, and each step is one plan.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, rows_not_in, salted_join, settled, text_of

SCALE = 256
#: Least standard deviation of each coordinate, in the units of its transform. More than half of a group may agree
#: in a coordinate exactly, which would make any other value infinitely far.
FLOORS = {"log_words": 0.75, "log_word_length": 0.25, "log_symbols": 0.4, "log_dup_lines": 1.0, "log_repeats": 1.0}
NAMES = list(FLOORS)
#: Floors that stand in only for a smaller spread: the largest value of each coordinate is beyond the cut-off alone.
MINIMA = {"log_words": 0.5, "log_word_length": 0.05, "log_symbols": 0.2, "log_dup_lines": 0.75, "log_repeats": 0.63}
#: The share of clean rows that the cut-off may reject if they are normal.
FALSE_REJECTIONS = 1e-6
#: Concentration ends by itself, as the subsets are finite in number; beyond so many steps something is wrong.
MOST_STEPS = 100


def chi_square_quantile(p: float, dims: int) -> float:
    """By Wilson and Hilferty's approximation."""
    z = NormalDist().inv_cdf(p)
    return dims * (1 - 2 / (9 * dims) + z * (2 / (9 * dims)) ** 0.5) ** 3


def window(words: str, i: Column) -> Column:
    """The 3-word window at i; words hold no spaces, so different windows differ as strings."""
    return F.concat_ws(" ", F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))


def twins(rows: str) -> Column:
    """The elements of a sorted array that share their key with a neighbour."""
    same = lambda x, i: F.coalesce(F.get(rows, i)["key"] == x["key"], F.lit(False))
    return F.filter(rows, lambda x, i: same(x, i - 1) | same(x, i + 1))


def text_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, row_key, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text, F.col(lang_col), F.col(source_col)).alias("row_key"),
        F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), text.alias("text"))
    rows = rows.select("id", "row_key", "lang", "source", F.regexp_extract_all("text", F.lit(WORD), 0).alias("words"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    # Hashes find the windows that may repeat; these few are then compared as strings.
    hashes = F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)).alias("key"), i.alias("i")))
    chars = F.aggregate("words", F.lit(0).cast("long"), lambda n, w: n + F.length(w))
    rows = rows.select("id", "row_key", "lang", "source", "n_symbols", F.size("words").cast("long").alias("n_words"), chars.alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), "words",
        F.sort_array(hashes).alias("hashes"))
    rows = rows.select(*[c for c in rows.columns if c != "hashes"], twins("hashes").alias("maybe"))
    rows = rows.select(*[c for c in rows.columns if c not in ("maybe", "words")],
        F.sort_array(F.transform("maybe", lambda x: F.struct(window("words", x["i"]).alias("key"), x["i"].alias("i")))).alias("windows"))
    rows = rows.select(*[c for c in rows.columns if c != "windows"], twins("windows").alias("again"))
    inside = F.array_distinct(F.flatten(F.transform("again", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))
    return rows.select(*[c for c in rows.columns if c != "again"], F.size(inside).cast("long").alias("n_repeat_words"))


def vector() -> dict[str, Column]:
    """Transformed statistics as whole multiples of 1/256."""
    percent = lambda n, of: 100 * F.col(n) / F.greatest(F.col(of), F.lit(1))
    values = {"log_words": F.col("n_words"), "log_word_length": F.col("word_chars") / F.greatest("n_words", F.lit(1)),
        "log_symbols": percent("n_symbols", "word_chars"), "log_dup_lines": percent("n_dup_lines", "n_lines"),
        "log_repeats": percent("n_repeat_words", "n_words")}
    return {k: F.round(F.log1p(v.cast("double")) * SCALE).cast("long") for k, v in values.items()}


GROUP = ["level", "lang", "source"]
#: Levels of groups: all rows (lang and source are null), a language (source is null), a source of a language.
ALL, LANG, SOURCE = 0, 1, 2


def levels_of(good: DataFrame, least_rows: int, wider: bool) -> DataFrame:
    """lang, source, level (of the group that judges the rows; null: none), and pools (levels that the rows count in).

    Groups of fewer than ``least_rows`` rows are judged by their language, and by all rows if that has too few, too.
    Rows of a group count in a wider one only if that judges some group.
    """
    groups = settled(good.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("rows")))
    langs = groups.groupBy(F.col("lang").alias("l_lang")).agg(F.sum("rows").alias("lang_rows"), F.min("rows").alias("fewest"))
    rows = groups.join(langs, F.col("lang").eqNullSafe(F.col("l_lang")))
    few = langs.where(F.col("lang_rows") < least_rows).limit(1).count() > 0
    own, of_lang = F.col("rows") >= least_rows, F.col("lang_rows") >= least_rows
    level = F.when(own, SOURCE)
    level = level.when(of_lang, LANG).otherwise(ALL) if wider else level
    pools = [F.when(own, SOURCE)]
    if wider:
        pools += [F.when(of_lang & (F.col("fewest") < least_rows), LANG), F.lit(ALL if few else None).cast("int")]
    return settled(rows.select("lang", "source", level.alias("level"), F.array_compact(F.array(*pools)).alias("pools")))


def in_group(rows: DataFrame, level: str) -> DataFrame:
    """Rows as members of their group at the level, whose lang and source are null where it is wider than these."""
    lang, source = F.when(F.col(level) >= LANG, F.col("lang")), F.when(F.col(level) >= SOURCE, F.col("source"))
    return rows.withColumns({"level": F.col(level), "lang": lang, "source": source})


def squared_distance(rows: DataFrame) -> DataFrame:
    """Adds d2 by forward substitution with the Cholesky factor l_i_j of the row's group."""
    for i, name in enumerate(NAMES):
        rest = F.col(name) / F.lit(float(SCALE)) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * F.col(f"z_{j}")
        rows = rows.withColumn(f"z_{i}", rest / F.col(f"l_{i}_{i}"))
    d2 = sum((F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(NAMES))), F.lit(0.0))
    return rows.withColumn("d2", d2).drop(*[f"z_{i}" for i in range(len(NAMES))])


def cell(d2: Column) -> Column:
    """Distances on a logarithmic grid of a few thousand values, so their quantiles are exact and small."""
    return F.floor(F.log2(1 + F.least(d2, F.lit(1e15))) * SCALE).cast("int")


def floored(variance: Column, name: str, minima: dict[str, float] | None) -> Column:
    """With ``minima``, a floor counts only where the variance is less; else ``FLOORS`` are added."""
    return F.greatest(variance, F.lit(minima[name] ** 2)) if minima else variance + FLOORS[name] ** 2


def moments() -> dict[str, Column]:
    """What adds up to a mean and a covariance. Vectors are whole numbers, so sums don't depend on their order."""
    p = len(NAMES)
    out = {"h": F.count(F.lit(1))} | {f"s_{i}": F.sum(x) for i, x in enumerate(NAMES)}
    return out | {f"s_{i}_{j}": F.sum(F.col(NAMES[i]) * F.col(NAMES[j])) for i in range(p) for j in range(i + 1)}


def estimate(sums: DataFrame, keys: list[str], minima: dict[str, float] | None = None) -> DataFrame:
    """Mean m_i, Cholesky factor l_i_j and logarithm of the determinant from the moments of each key."""
    p = len(NAMES)
    est = sums.withColumns({f"m_{i}": F.col(f"s_{i}").cast("double") / F.col("h") / SCALE for i in range(p)})
    est = est.withColumns({f"c_{i}_{j}": F.col(f"s_{i}_{j}").cast("double") / F.col("h") / SCALE**2 - F.col(f"m_{i}") * F.col(f"m_{j}") for i in range(p) for j in range(i + 1)})
    est = est.withColumns({f"c_{i}_{i}": floored(F.col(f"c_{i}_{i}"), x, minima) for i, x in enumerate(NAMES)})
    for j in range(p):  # column by column, so that each is one projection
        rest = lambda i, j=j: F.col(f"c_{i}_{j}") - sum((F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)), F.lit(0.0))
        est = est.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(rest(j), F.lit(1e-9))))
        est = est.withColumns({f"l_{i}_{j}": rest(i) / F.col(f"l_{j}_{j}") for i in range(j + 1, p)}) if j + 1 < p else est
    return with_log_det(est.select(*keys, *ESTIMATE))


#: The columns of an estimate, besides the logarithm of its determinant.
ESTIMATE = [*[f"m_{i}" for i in range(len(NAMES))], *[f"l_{i}_{j}" for i in range(len(NAMES)) for j in range(i + 1)]]


def with_log_det(est: DataFrame) -> DataFrame:
    return est.withColumn("log_det", sum((2 * F.log(f"l_{i}_{i}") for i in range(len(NAMES))), F.lit(0.0)))


def concentrated(measured: DataFrame, keys: list[str], support: float, minima: dict[str, float] | None) -> DataFrame:
    """The next estimate of each key: that of the ``support`` share of its rows with the smallest distances.

    Moments are added per cell of the distances, in tasks first; a key has a few thousand cells at most, over which
    they are added up to the cell where the share is reached.
    """
    sums = moments()
    cells = measured.groupBy(*keys, "cell").agg(*[c.alias(k) for k, c in sums.items()])
    order = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("h").over(order), F.lit(0))).withColumn("all", F.sum("h").over(Window.partitionBy(*keys)))
    inside = cells.where(F.col("before") <= F.floor(F.lit(support) * (F.col("all") - 1)))
    return estimate(inside.groupBy(*keys).agg(*[F.sum(k).alias(k) for k in sums]), keys, minima)


def least(estimates: DataFrame, keys: list[str], *ties: str) -> DataFrame:
    """Of several estimates of a key, that with the least determinant."""
    best = F.min_by(F.struct(*ESTIMATE, "log_det"), F.struct("log_det", *ties)).alias("best")
    return estimates.groupBy(*keys).agg(best).select(*keys, "best.*")


def same_group() -> Column:
    same = F.lit(True)
    for g in GROUP:
        same = same & F.col(g).eqNullSafe(F.col(f"g_{g}"))
    return same


#: A start from a few rows takes so many of them, if the keyed hash spreads evenly.
FEW = 12


def quality(docs: DataFrame, id_col: str = "doc_id", support: float = 0.75, steps: int | None = None, least_rows: int = 50, tail: float = FALSE_REJECTIONS, salts: int = 32,
    minima: dict[str, float] | None = MINIMA, wider: bool = True, starts: int = 3, **columns) -> DataFrame:
    """One row per document: the id, row_key, counts, base_failed, distance (null for base failures), kept.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated 3-word windows. Others are
    rejected beyond the chi-square quantile of 1 - ``tail``, after distances are scaled so that a group's median is
    that of a chi-square variable. Groups of fewer than ``least_rows`` rows are judged by the estimate of their
    language, or of all rows if the language has too few, with ``wider``, and else reject nothing. Null languages and
    sources are groups of their own, null texts are empty, repeated rows have equal verdicts, an empty table gives
    no rows. Texts are read whole; other columns are ignored, whatever their names. Floors on the spreads (``FLOORS``,
    added, or ``minima``, where the spread is less) keep ordinary variation near a constant coordinate inside.

    The first start is the groups' medians and median deviations, the others are a few rows each by keyed hash. With
    ``steps`` None, each start takes two steps, the least determinant goes on, and steps end for a group when its
    determinant no longer falls.
    """
    rows = text_counts(docs, id_col, **columns)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = settled(rows.withColumn("base_failed", failed).withColumns(vector()))
    good = rows.where("not base_failed").select("id", "row_key", "lang", "source", *NAMES)
    levels = levels_of(good, least_rows, wider)
    good = salted_join(good, levels.select("lang", "source", "pools"), ["lang", "source"], salts, ["id", "row_key"], "inner")
    good = settled(in_group(good.withColumn("pool", F.explode("pools")), "pool").drop("pools", "pool"))

    groups = settled(good.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("rows"), *[F.percentile(x, 0.5).alias(f"med_{x}") for x in NAMES]))
    near = lambda table, how="inner": salted_join(good, table, GROUP, salts, ["id", "row_key"], how)
    spread = near(groups).groupBy(*GROUP).agg(*[F.percentile(F.abs(F.col(x) - F.col(f"med_{x}")), 0.5).alias(f"mad_{x}") for x in NAMES])
    spread = spread.select(*[F.col(g).alias(f"g_{g}") for g in GROUP], *[f"mad_{x}" for x in NAMES])
    start = groups.join(spread, same_group()).drop(*[f"g_{g}" for g in GROUP])
    diagonal = {f"l_{i}_{j}": F.lit(0.0) if i != j else F.sqrt(floored((1.4826 * F.col(f"mad_{x}") / SCALE) ** 2, x,
        minima)) for i, x in enumerate(NAMES) for j in range(i + 1)}
    est = start.select(*GROUP, F.lit(0).alias("start"), *[(F.col(f"med_{x}") / SCALE).alias(f"m_{i}") for i, x in enumerate(NAMES)],
        *[c.alias(k) for k, c in diagonal.items()])
    est = with_log_det(est).select(*GROUP, "start", *ESTIMATE, "log_det")
    if starts > 1:
        some = near(groups.select(*GROUP, "rows")).withColumn("start", F.explode(F.sequence(F.lit(1), F.lit(starts - 1))))
        some = some.where(F.pmod(F.xxhash64("start", "id", "row_key"), F.col("rows")) < FEW)
        sums = some.groupBy(*GROUP, "start").agg(*[c.alias(k) for k, c in moments().items()])
        est = est.unionByName(estimate(sums, [*GROUP, "start"], minima))
    est = settled(est)
    measured = lambda e: squared_distance(near(e)).withColumn("cell", cell(F.col("d2")))
    for _ in range(2 if steps is None else steps):
        est = settled(concentrated(measured(est), [*GROUP, "start"], support, minima))
    est = settled(least(est, GROUP, "start"))
    for _ in range(MOST_STEPS if steps is None else 0):
        after = concentrated(measured(est), GROUP, support, minima).withColumn("step", F.lit(1)).unionByName(est.withColumn("step", F.lit(0)))
        fell = F.min(F.when(F.col("step") == 1, F.col("log_det"))) < F.min(F.when(F.col("step") == 0, F.col("log_det"))) - 1e-9
        best = F.min_by(F.struct(*ESTIMATE, "log_det"), F.when(F.col("step") == 1, F.col("log_det") + 1e-9).otherwise(F.col("log_det"))).alias("best")
        after = settled(after.groupBy(*GROUP).agg(best, fell.alias("fell")).select(*GROUP, "best.*", "fell"))
        est = after.drop("fell")
        if after.where("fell").isEmpty():
            break
    middle = F.pow(F.lit(2.0), (F.percentile("cell", 0.5) + 0.5) / SCALE) - 1
    middle = measured(est).groupBy(*GROUP).agg(middle.alias("middle"))
    middle = middle.select(*[F.col(g).alias(f"g_{g}") for g in GROUP], "middle")
    est = settled(est.join(middle, same_group()).drop(*[f"g_{g}" for g in GROUP]))
    p = len(NAMES)
    scaled = F.col("d2") * chi_square_quantile(0.5, p) / F.greatest(F.col("middle"), F.lit(chi_square_quantile(0.5, p)))
    judged = in_group(salted_join(rows, levels.select("lang", "source", F.col("level").alias("by")), ["lang", "source"], salts, ["id", "row_key"]), "by")
    final = squared_distance(salted_join(judged, est, GROUP, salts, ["id", "row_key"])).withColumn("distance", F.when(~F.col("base_failed"), scaled))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= chi_square_quantile(1 - tail, p), F.lit(True))
    return final.select(F.col("id").alias(id_col), "row_key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        kept.alias("kept"), "distance")


#: What the op9 query and the pipeline judge by, which are the defaults. Other settings leave small groups unjudged or end early.
STRICT = {"minima": MINIMA, "steps": None, "tail": FALSE_REJECTIONS, "wider": True, "starts": 3}


def keep_good(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that quality() keeps, under its rules. Only rows that may go take part in a shuffle."""
    text, lang, source = (options.get(k, k.removesuffix("_col")) for k in ("text_col", "lang_col", "source_col"))
    rejected = settled(quality(docs, id_col, **options).where("not kept").select(F.col(id_col).alias("id"), "row_key").distinct())
    return rows_not_in(docs, rejected, {"id": F.col(id_col), "row_key": F.xxhash64(F.col(id_col), text_of(text), F.col(lang), F.col(source))})
