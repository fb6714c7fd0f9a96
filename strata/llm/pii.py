"""Personal data, and information-theoretic sanitisation of the terms that reveal it.

Base spans (email, ip, card, phone) come from regular expressions over whole texts, and so do credentials. Each distinct
value is a protected entity c. The terms of the lines that mention it are what an attacker sees with it. Over the
lines of the corpus,

    IC(c)     = log2(N / n(c))                          what a mention of c tells
    PMI(c, t) = log2(n(c, t) * N / (n(c) * n(t)))       how much of that t gives away

where N are the lines with a term, n(t) those with t, n(c) those with c, n(c, t) those with both. t discloses the share
PMI / IC of c. In a text that mentions c, a term whose share is at least ``remove`` is removed wherever it stands, and
one whose share is at least ``generalise`` is generalised: cut to its longest beginning that discloses less, counted
over all terms that begin so. A pair counts from ``support`` lines on. With one, the default, a term of few lines
beside a unique value is taken to reveal it.

All of it is Spark expressions, joins and aggregations. Counts are combined before they are shuffled; occurrences of
hot entities or terms are dealt by salts. Whole texts take part in no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import cut, rows_in, salted_join, text_of

#: The kinds in their order, with what finds them. They match the spans of the plain patterns that can be valid, but
#: neither recurse nor try a long run again from each of its characters. A card or phone number is a maximal run, so
#: its number of digits is part of the pattern.
KINDS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){7,14}+(?![\x20().-]*+[0-9])",
}
#: Kinds of spans that the method adds to the four above.
ADDED = {4: "term_generalised", 5: "term_removed", 6: "secret"}
#: The value of something that is named as a credential.
SECRET = r"(?i)(?<=\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|private[_-]?key)[\"']{0,1}\s{0,3}[:=]\s{0,3}[\"']{0,1})[A-Za-z0-9_./+=-]{16,}+"
PATTERNS = {**dict(enumerate(KINDS.values())), 6: SECRET}
#: What a text has to hold for a kind to be looked for at all.
NEEDS = {0: r"@", 1: r"[0-9]\.[0-9]", 2: r"(?:[0-9][\x20-]?){15}[0-9]", 3: r"\+[0-9]", 6: r"(?i)token|secret|passw|key"}
PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
BEFORE, AFTER = r"(?<![^\s\"'(\[])", r"(?![^\s.,;:!?\"')\]])"
TERM = BEFORE + r"\p{L}{3,}+" + AFTER
SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"


def valid(kind: int, match: Column) -> Column:
    if kind == 1:
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == 2:
        return F.call_function("luhn_check", F.regexp_replace(match, r"[^0-9]", ""))
    return F.lit(True)


def placed(text: Column, pattern: Column, make, kind: str) -> Column:
    """make(match, start) of every match, in order: the texts between matches say where these are."""
    found = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"), F.split(text, pattern, -1).alias("between"))
    step = lambda between: lambda acc, m: F.struct(
        (acc["i"] + 1).alias("i"),
        (acc["at"] + F.length(F.get(between, acc["i"])) + F.length(m)).alias("at"),
        F.concat(acc["out"], make(m, acc["at"] + F.length(F.get(between, acc["i"])))).alias("out"),
    )
    start = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    return F.get(F.transform(F.array(found), lambda f: F.aggregate(f["matches"], start, step(f["between"]))["out"]), F.lit(0))


def spans_of(text: Column) -> Column:
    """kind, start, end, value of the base kinds and of secrets, by kind and start."""
    each = []
    for k, pattern in PATTERNS.items():
        make = lambda m, start, k=k: F.when(valid(k, m),
            F.array(F.struct(F.lit(k).alias("kind"), start.cast("int").alias("start"), (start + F.length(m)).cast("int").alias("end"),
            m.alias("value")))).otherwise(F.array().cast(SPAN))
        each.append(F.when(text.rlike(NEEDS[k]), placed(text, F.lit(pattern), make, SPAN)).otherwise(F.array().cast(SPAN)))
    return F.concat(*each)


def entity_of(span: Column) -> Column:
    digits = span["kind"].isin(2, 3)
    return F.concat_ws(":", span["kind"],
        F.when(digits, F.regexp_replace(span["value"], "[^0-9]", "")).when(span["kind"] == 6, span["value"]).otherwise(F.lower(span["value"])))


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, row_key, spans (kind, start, end), mentions (the lines that hold spans, each with its entities)."""
    text = text_of(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row_key"), text.alias("text"))
    rows = rows.withColumn("spans", spans_of(F.col("text")))
    # No pattern reaches over a line feed, so a span's line is what stands around it up to the nearest ones.
    line = lambda s: F.concat(F.substring_index(F.substring("text", F.lit(1), s["start"]), "\n", -1), s["value"],
        F.substring_index(F.substring("text", s["end"] + 1, F.length("text")), "\n", 1))
    rows = rows.withColumn("lines", F.transform("spans",
        lambda s: F.struct((s["start"] - F.length(F.substring_index(F.substring("text", F.lit(1), s["start"]), "\n", -1))).alias("at"),
        entity_of(s).alias("entity"))))
    firsts = F.array_distinct(F.transform("lines", lambda x: x["at"]))
    mentions = F.transform(firsts, lambda at: F.struct(line(F.get("spans", F.array_position(F.transform("lines", lambda x: x["at"]), at).cast("int") - 1)).alias("line"), F.array_distinct(F.transform(F.filter("lines", lambda x: x["at"] == at), lambda x: x["entity"])).alias("entities")))
    rows = rows.withColumn("mentions", mentions)
    return rows.select("id", "row_key", F.transform("spans",
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("found"), "mentions").withColumnRenamed("found",
        "spans")


def terms_of(line: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(line), F.lit(TERM), F.lit(0)))


def mention_lines(found: DataFrame) -> DataFrame:
    """One row per line that holds entities: id, row_key, entities, terms."""
    lines = found.where(F.size("mentions") > 0).select("id", "row_key", F.explode("mentions").alias("m"))
    return lines.select("id", "row_key", "m.entities", terms_of(F.col("m.line")).alias("terms"))


def line_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """term, n_t: in how many lines it stands; the term '' stands for lines with any term."""
    lines = docs.select(F.explode(F.split(text_of(text_col), "\n", -1)).alias("line")).select(terms_of(F.col("line")).alias("terms"))
    return lines.where(F.size("terms") > 0).select(F.explode(F.array_append("terms",
        F.lit(""))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))


def pairs_of(lines: DataFrame) -> DataFrame:
    return lines.select("id", "row_key", F.explode("entities").alias("entity"), "terms").select("id", "row_key", "entity", F.explode("terms").alias("term"))


def share_of(together: Column, entity: Column, term: Column, total: float) -> Column:
    """PMI as a share of IC; an entity of every line tells nothing, and nothing discloses it."""
    tells = F.log2(F.lit(max(total, 1.0)) / entity)
    return F.when(tells > 0, F.log2(together * F.lit(max(total, 1.0)) / (entity * F.greatest(term, together))) / tells).otherwise(F.lit(0.0))


def disclosures(lines: DataFrame, words: DataFrame, support: int = 1, generalise: float = 0.7, remove: float = 0.9) -> DataFrame:
    """entity, term, n_ct, n_c, share, action (4 or 5) of every pair that discloses at least ``generalise`` of the entity."""
    together = cut(pairs_of(lines).groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_ct")).where(F.col("n_ct") >= support))
    entities = lines.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count(F.lit(1)).alias("n_c"))
    pairs = together.join(entities, "entity").join(words, "term")
    pairs = pairs.withColumn("share", share_of(F.col("n_ct"), F.col("n_c"), F.col("n_t"), total_of(words))).where(F.col("share") >= generalise)
    return cut(pairs.select("entity", "term", "n_ct", "n_c", "share", F.when(F.col("share") >= remove, 5).otherwise(4).alias("action")))


def total_of(words: DataFrame) -> float:
    row = words.where("term = ''").first()
    return float(row["n_t"]) if row else 0.0


def generalised(telling: DataFrame, words: DataFrame, generalise: float = 0.7) -> DataFrame:
    """entity, term, general: the longest beginning of a term to generalise that discloses less than ``generalise``
    of the entity, of all terms that begin so; no row if each discloses as much.
    """
    begins = lambda: F.explode(F.transform(F.sequence(F.lit(1), F.length("term") - 1),
        lambda k: F.substring("term", F.lit(1), k))).alias("general")
    wanted = telling.where("action = 4").select("entity", "term", "n_ct", "n_c", begins())
    every = words.where(F.length("term") > 1).select("n_t", begins()).groupBy("general").agg(F.sum("n_t").alias("n_g"))
    weaker = wanted.join(every, "general").where(share_of(F.col("n_ct"), F.col("n_c"), F.col("n_g"), total_of(words)) < generalise)
    return weaker.groupBy("entity", "term").agg(F.max_by("general", F.length("general")).alias("general"))


def told(docs: DataFrame, hits: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """h_id, h_key, added: kind, start, end and general of every place where a text holds one of its telling terms.

    ``hits`` has id, row_key, tells (map from term to its kind and beginning) of the texts that hold some.
    """
    text = text_of(text_col)
    own = docs.select(F.col(id_col).alias("d_id"), F.xxhash64(F.col(id_col), text).alias("d_key"), text.alias("d_text"))
    near = rows_in(own, hits.select("id", "row_key"), {"id": F.col("d_id"), "row_key": F.col("d_key")})
    near = salted_join(near.dropDuplicates(["d_id", "d_key"]), hits.select(F.col("id").alias("d_id"), F.col("row_key").alias("d_key"), "tells"),
        ["d_id", "d_key"], 1, ["d_key"], "inner")
    # The forms in which the terms stand in the text are letters alone, so they are a pattern as they are.
    forms = F.filter(F.array_distinct(F.regexp_extract_all("d_text", F.lit(TERM), F.lit(0))), lambda f: F.map_contains_key(F.col("tells"), F.lower(f)))
    pattern = F.concat(F.lit(BEFORE + "(?:"), F.array_join(forms, "|"), F.lit(")" + AFTER))
    kind = "array<struct<kind:int,start:int,end:int,general:string>>"
    make = lambda m, start: F.array(F.struct(F.element_at("tells", F.lower(m))["kind"].alias("kind"), start.cast("int").alias("start"),
        (start + F.length(m)).cast("int").alias("end"), F.element_at("tells", F.lower(m))["general"].alias("general")))
    near = near.withColumn("pattern", pattern)
    return near.select(F.col("d_id").alias("h_id"), F.col("d_key").alias("h_key"), placed(F.col("d_text"), F.col("pattern"), make, kind).alias("added"))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16, support: int = 1, generalise: float = 0.7,
    remove: float = 0.9, beginnings: bool = False) -> DataFrame:
    """One row per row of ``docs``: the id, row_key, spans (kind, start, end, general; ordered by kind and start).

    Kinds 0 to 3 are the base's, 4 and 5 terms to generalise and to remove, 6 secrets. Null texts are empty. Repeated
    rows have equal spans, and count each. A null id is an id like any other. An empty table gives no rows. Texts are
    searched whole. Of several entities that a term discloses, the strictest decides. ``general`` is filled for kind 4
    if ``beginnings`` are asked for. Other columns are ignored, whatever their names.
    """
    found = cut(found_spans(docs, id_col, text_col))
    lines = cut(mention_lines(found))
    words = cut(line_counts(docs, text_col))
    telling = disclosures(lines, words, support, generalise, remove)
    if beginnings:
        general = generalised(telling, words, generalise).select(F.col("entity").alias("g_entity"), F.col("term").alias("g_term"), "general")
        telling = cut(telling.join(general, (F.col("entity") == F.col("g_entity")) & (F.col("term") == F.col("g_term")), "left").drop("g_entity", "g_term"))
    else:
        telling = telling.withColumn("general", F.lit(None).cast("string"))
    hits = salted_join(pairs_of(lines), telling.select("entity", "term", "action", "general"), ["entity", "term"], salts, ["id", "row_key"], "inner")
    # Of beginnings, the shortest discloses least.
    strict = F.struct((-F.col("action")).alias("minus"), F.length("general").alias("n"), F.col("general"))
    hits = hits.groupBy("id", "row_key", "term").agg(F.min(strict).alias("s"))
    tells = F.map_from_entries(F.collect_list(F.struct("term", F.struct((-F.col("s.minus")).cast("int").alias("kind"), F.col("s.general").alias("general")))))
    hits = cut(hits.groupBy("id", "row_key").agg(tells.alias("tells")))
    added = told(docs, hits, id_col, text_col)
    base = found.select("id", "row_key", F.transform("spans",
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        F.lit(None).cast("string").alias("general"))).alias("base"))
    both = base.join(added, base["id"].eqNullSafe(added["h_id"]) & (base["row_key"] == added["h_key"]), "left")
    none = F.array().cast("array<struct<kind:int,start:int,end:int,general:string>>")
    return both.select(F.col("id").alias(id_col), "row_key", F.array_sort(F.concat("base", F.coalesce("added", none))).alias("spans"))


def sanitised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with the column ``sanitised``: base spans become <KIND>, secrets <SECRET>, removed terms <REMOVED>,
    and generalised terms their beginning and an asterisk, or <WORD> if no beginning discloses less. Of overlapping
    spans, the first, at equal starts the longest, counts. A null text's result is empty. Names that begin with ``__``
    are for the operator's own columns.
    """
    spans = personal_data(docs, id_col, text_col, beginnings=True, **options).select(F.col(id_col).alias("__id"), F.col("row_key").alias("__row"),
        F.col("spans").alias("__found")).dropDuplicates(["__id", "__row"])
    rows = docs.withColumn("__key", F.xxhash64(F.col(id_col), text_of(text_col)))
    rows = rows.join(spans, rows[id_col].eqNullSafe(spans["__id"]) & (rows["__key"] == spans["__row"]), "left")
    text = text_of(text_col)
    ordered = F.array_sort(F.transform("__found",
        lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"), s["general"].alias("general"))))
    rows = rows.withColumn("__spans", ordered)
    labels = F.create_map(*[F.lit(x) for k, v in [*enumerate(KINDS), (5, "removed"), (6, "secret")] for x in (k, f"<{v.upper()}>")])
    # A beginning is of the lower-case term; what stands in the text keeps its own letters.
    begun = lambda s: F.concat(F.substring(text, s["start"] + 1, F.length(s["general"])), F.lit("*"))
    named = lambda s: F.when(s["kind"] == 4, F.coalesce(begun(s), F.lit("<WORD>"))).otherwise(F.element_at(labels, s["kind"]))
    step = lambda acc, s: F.when(s["start"] < acc["at"],
        acc).otherwise(F.struct((-s["minus_end"]).alias("at"),
        F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), named(s))).alias("out")))
    done = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    rows = rows.withColumn("__done", done)
    clean = F.concat(F.array_join("__done.out", ""), F.substring(text, F.col("__done.at") + 1, F.length(text)))
    return rows.withColumn("sanitised", clean).select(*docs.columns, "sanitised")
