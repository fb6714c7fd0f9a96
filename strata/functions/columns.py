"""Column expressions with the engine's null, zero and error rules. All are built-in functions of Spark."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The end of a current version.
FAR_FUTURE = "2099-12-31 00:00:00"
#: Names of the codes in the source records.
GENDERS = {1: "female", 2: "male", 3: "non-binary"}
RELEASE_TYPES = {1: "首映", 2: "限定上映", 3: "院线", 4: "数字", 5: "实体", 6: "电视"}


def zero_as_null(c: Column) -> Column:
    """0 means unknown."""
    return F.nullif(c, F.lit(0))


def parse_date(c: Column) -> Column:
    """yyyy-MM-dd; null for anything else."""
    return F.try_to_date(c, "yyyy-MM-dd")


def lenient_date(c: Column) -> Column:
    """A date, or the date of an ISO instant; null for anything else."""
    return parse_date(F.substring(F.trim(c), 1, 10))


def parse_instant(c: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSZ; null for anything else."""
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def code_name(c: Column, names: dict, other: str) -> Column:
    out = None
    for code, name in names.items():
        out = F.when(c == code, name) if out is None else out.when(c == code, name)
    return out.otherwise(other)


def gender_name(c: Column) -> Column:
    return code_name(c, GENDERS, "unknown")


def release_type_name(c: Column) -> Column:
    return code_name(c, RELEASE_TYPES, "其他")


def flag(c: Column) -> Column:
    """1 for true; 0 for false and null."""
    return F.when(c, 1).otherwise(0)


def is_director(job: Column) -> Column:
    return flag(F.lower(job) == "director")


def safe_divide(a: Column, b: Column) -> Column:
    """Null where b is null or 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def change_ratio(now: Column, before: Column) -> Column:
    """(now - before) / before; 0 where that is not known."""
    return F.coalesce(safe_divide(now - before, before), F.lit(0.0))


def growth_ratio(now: Column, base: Column) -> Column:
    """now / base; 0 for a base that is not positive."""
    return F.when(base > 0, now / base).otherwise(F.lit(0.0))


def surrogate_key(*parts: Column | str) -> Column:
    """A 64-bit key of a version."""
    return F.xxhash64(*parts)


def content_hash(*columns: str) -> Column:
    """SHA-256 of the columns' texts; null counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def event_id(kind: Column, entity: Column, ingest: Column) -> Column:
    return F.sha2(F.concat_ws(":", kind, entity.cast("string"), ingest.cast("string")), 256)


def deterministic_id(*parts: Column) -> Column:
    """The first 32 hex digits of the SHA-256 of the parts, joined by U+0001; null is the word null."""
    return F.substring(F.sha2(F.concat_ws("\x01", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]), 256), 1, 32)


def md5_base64(c: Column) -> Column:
    return F.base64(F.unhex(F.md5(c)))


def company_name(c: Column) -> Column:
    """Without a bracketed suffix."""
    return F.regexp_replace(c, r"\s*\(.*?\)\s*$", "")


def influence(popularity: Column, works: Column, vote: Column) -> Column:
    known = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    return known(popularity) + 2 * known(works) + 10 * known(vote)


def latency_ms(event_ms: Column, now_ms: Column) -> Column:
    return F.greatest(F.lit(0), now_ms - event_ms)


#: Beyond so many milliseconds from event to arrival, latency is too high.
MOST_LATENCY_MS = 300_000


def too_late(event_ms: Column, now_ms: Column, most_ms: int = MOST_LATENCY_MS) -> Column:
    return latency_ms(event_ms, now_ms) > most_ms


def alert_id(kind: Column, entity: Column, window_start: Column) -> Column:
    return F.concat_ws(":", kind, entity.cast("string"), F.unix_millis(window_start).cast("string"))


def display_name(title: Column, name: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), name)


def dt_from_path(path: Column) -> Column:
    return parse_date(F.nullif(F.regexp_extract(path, r"/dt=(\d{4}-\d{2}-\d{2})", 1), F.lit("")))


def export_date(dt: Column) -> Column:
    """MM_dd_yyyy, as daily exports are named."""
    return F.date_format(dt, "MM_dd_yyyy")


def start_of_day_ms(dt: Column) -> Column:
    """Epoch milliseconds of the day's midnight."""
    return F.unix_millis(dt.cast("date").cast("timestamp"))


def day_of_ms(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def date_windows(start: Column, end: Column, days: int = 14) -> Column:
    """[start, end] cut to closed windows of at most ``days`` days, as structs (start, end); none if start is after end."""
    starts = F.when(start <= end, F.sequence(start, end, F.expr(f"interval {days} days"))).otherwise(F.array().cast("array<date>"))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.date_add(s, days - 1), end).alias("end")))


def month_of(dt: Column) -> Column:
    return F.date_format(dt, "yyyyMM")


def iso_day_of_week(dt: Column) -> Column:
    """1 is Monday."""
    return F.weekday(dt) + 1


def mask_secret(c: Column) -> Column:
    """Four characters at either end of 12 or more; shorter ones not at all. Null stays."""
    return F.when(F.length(c) >= 12, F.concat(F.substring(c, 1, 4), F.lit("****"), F.right(c, F.lit(4)))).when(c.isNotNull(), F.lit("****"))


#: Names whose values are secret, in texts and parameters, and in headers.
SECRET_NAMES = ["access_token", "api-key", "api_key", "apikey", "passwd", "password", "pwd", "refresh_token", "secret", "secret-key", "secret_key", "session_id",
    "token"]
SECRET_HEADERS = ["authorization", "cookie", "proxy-authorization", "set-cookie", "x-api-key", "x-clickhouse-key"]


def mask_text(c: Column) -> Column:
    """Secrets in URLs, headers, key=value pairs and quoted keys; a quoted value goes up to its closing quote."""
    names, headers = "|".join(sorted(SECRET_NAMES, key=len, reverse=True)), "|".join(sorted(SECRET_HEADERS, key=len, reverse=True))
    c = F.regexp_replace(c, r"(?i)(://)[^/\s:@]+:[^/\s@]+@", "$1****:****@")
    c = F.regexp_replace(c, rf"(?im)(^|[^\w-])({headers})(\"?\s*+:\s*+\"?+)(?!bearer\s)[^\r\n\"]+", "$1$2$3****")
    c = F.regexp_replace(c, r"(?i)\b(bearer)\s+[A-Za-z0-9._~+/=-]+", "$1 ****")
    c = F.regexp_replace(c, r"\beyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "****")
    c = F.regexp_replace(c, rf"(?i)(?<![\w-])({names})(\"?\s*[=:]\s*)\"(?:[^\"\\]|\\.)*\"", '$1$2"****"')
    return F.regexp_replace(c, rf"(?i)(?<![\w-])({names})(\"?\s*[=:]\s*)(?!\")[^\s&,;}}]+", "$1$2****")


def mask_header(name: Column, value: Column) -> Column:
    """The value of a header; a secret one's not at all."""
    return F.when(F.lower(name).isin(SECRET_HEADERS) & value.isNotNull(), F.lit("****")).otherwise(value)


def readable_size(n: Column, largest: str = "TiB") -> Column:
    """B, KiB, MiB, GiB, TiB with two decimals; ``largest`` is the last of these units that is used."""
    out = F.format_string("%.2f B", n.cast("double"))
    units = ["KiB", "MiB", "GiB", "TiB"]
    for k, unit in enumerate(units[: units.index(largest) + 1], start=1):
        out = F.when(n >= 1024**k, F.format_string(f"%.2f {unit}", n / float(1024**k))).otherwise(out)
    return out


def split_table_name(c: Column) -> tuple[Column, Column]:
    """(database, table); names with a colon are labels of the graph."""
    database = F.when(c.contains(":"), "graph").when(c.contains("."), F.substring_index(c, ".", 1)).otherwise("default")
    return database, F.when(c.contains(":"), F.substring_index(c, ":", -1)).otherwise(F.regexp_replace(c, r"^[^.]*\.", ""))


def references(spark: SparkSession, expression: str) -> list[str]:
    """The columns that an expression names, once each, in order, as Spark's parser reads it: dotted if they are
    qualified, whatever words they are made of. Raises ParseException for what is no expression.
    """
    found: dict[str, None] = {}
    each = lambda seq: [seq.apply(i) for i in range(seq.length())]

    def visit(node, bound: frozenset[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "LambdaFunction":
            bound = bound | {each(a.nameParts())[0] for a in each(node.arguments())}
        elif kind in ("UnresolvedAttribute", "UnresolvedNamedLambdaVariable"):
            parts = each(node.nameParts())
            if parts[0] not in bound:
                found[".".join(parts)] = None
        for child in each(node.children()):
            visit(child, bound)

    visit(spark._jsparkSession.sessionState().sqlParser().parseExpression(expression), frozenset())
    return list(found)


def identifiers(rows: DataFrame, column: str, to: str = "names") -> DataFrame:
    """rows with the columns that the expressions in ``column`` name; null for what is no expression. Each distinct
    expression is parsed once, on the driver: they are definitions, which don't grow with the data they are about.
    """
    spark = rows.sparkSession

    def names(text: str) -> list[str] | None:
        try:
            return references(spark, text)
        except ParseException:
            return None

    distinct = rows.select(column).where(F.col(column).isNotNull()).distinct()
    parsed = spark.createDataFrame([(r[0], names(r[0])) for r in distinct.toLocalIterator()], f"__text string, {to} array<string>")
    return rows.join(parsed, F.col(column) == F.col("__text"), "left").drop("__text")


def canonical_json(c: Column) -> Column:
    """JSON with its keys sorted at every depth; null for what is no JSON, or repeats a key in an object. A variant keeps
    its keys sorted, so parsing and writing one does it; numbers lose zeros that say nothing (1.50 is 1.5).
    """
    return F.to_json(F.try_parse_json(c))
