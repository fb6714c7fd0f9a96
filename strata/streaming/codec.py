"""Event texts to typed rows; what is no event goes to a dead-letter branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sources.schemas import ENTITY_TYPES, EVENT_TYPES, POPULARITY


def field(parsed: Column, snake: str, camel: str) -> Column:
    """A field as text, under its snake_case or camelCase name."""
    return F.coalesce(F.try_variant_get(parsed, f"$.{snake}", "string"), F.try_variant_get(parsed, f"$.{camel}", "string"))


def decode(messages: DataFrame, column: str = "value") -> DataFrame:
    """messages with the event's columns and ``valid``; invalid rows keep their text alone.

    A text is parsed once; only a payload is cut out of it as it stands.
    """
    text, parsed = F.col(column), F.col("__parsed")
    messages = messages.withColumn("__parsed", F.try_parse_json(text))

    def long(snake: str, camel: str) -> Column:
        """A field that is a JSON number; a text of digits is none."""
        kind = lambda name: F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant"))
        number = lambda name: F.when(kind(name).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(parsed, f"$.{name}", "bigint"))
        return F.coalesce(number(snake), number(camel))

    rows = messages.withColumns({
        "event_type": F.upper(field(parsed, "event_type", "eventType")),
        "entity_type": F.lower(field(parsed, "entity_type", "entityType")),
        "entity_id": long("entity_id", "entityId"),
        "event_ms": long("event_time", "eventTime"),
        "event_id": field(parsed, "event_id", "eventId"),
        "content_hash": field(parsed, "content_hash", "contentHash"),
        "payload": F.coalesce(F.get_json_object(text, "$.payload"), F.lit("{}")),
        "schema_version": F.coalesce(long("schema_version", "schemaVersion"), F.lit(1)).cast("int"),
        "source": F.coalesce(F.try_variant_get(parsed, "$.source", "string"), F.lit("unknown")),
    })
    valid = F.col("event_type").isin(EVENT_TYPES) & F.col("entity_type").isin(ENTITY_TYPES) & F.col("entity_id").isNotNull() & F.col("event_ms").isNotNull()
    rows = rows.withColumn("ingest_ms", F.coalesce(long("ingest_time", "ingestTime"), F.col("event_ms"))).withColumn("valid", F.coalesce(valid, F.lit(False)))
    return rows.drop("__parsed").withColumn("event_time", F.timestamp_millis("event_ms")).withColumn("dt", F.to_date("event_time"))


def of_types(events: DataFrame, *entity_types: str) -> DataFrame:
    """The events of some entity types, e.g. movies only."""
    return events.where(F.col("entity_type").isin([t.lower() for t in entity_types]))


def good(decoded: DataFrame) -> DataFrame:
    return decoded.where("valid").drop("valid")


def dead_letters(decoded: DataFrame, column: str = "value") -> DataFrame:
    return decoded.where("not valid").select(column)


def popularity(events: DataFrame) -> DataFrame:
    """Numbers of a popularity payload; what is no number is null."""
    return events.withColumn("p", F.from_json("payload", POPULARITY)).withColumns({"title": F.coalesce("p.title", F.lit("")),
        "list_name": F.coalesce("p.list_name", F.lit("")), "popularity": F.col("p.popularity"), "vote_average": F.col("p.vote_average"),
        "vote_count": F.col("p.vote_count")}).drop("p")


#: Where rows of a stream go: by the time of the event, as text where the table has text.
ODS_COLUMNS = ["event_id", "event_type", "entity_type", "entity_id", "event_time", "ingest_time", "source", "schema_version", "content_hash", "payload", "dt"]


def to_ods(events: DataFrame) -> DataFrame:
    """Good events as rows of the raw event table: dt is the day of the event in UTC, a missing payload is {}."""
    return events.select(*[F.timestamp_millis("ingest_ms").alias(c) if c == "ingest_time" else F.coalesce("payload",
        F.lit("{}")).alias(c) if c == "payload" else F.col(c) for c in ODS_COLUMNS])


def to_observations(events: DataFrame) -> DataFrame:
    """Popularity events as rows of the real-time table."""
    rows = popularity(events.where("event_type = 'POPULARITY_OBSERVED'"))
    return rows.select("dt", "event_time", "entity_type", "entity_id", "title", "list_name", "popularity", "vote_average", "vote_count", "event_id")
