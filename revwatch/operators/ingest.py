"""Routing of raw records: parse guard, required keys, allowlist, enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from revwatch.functions.columns import computed_once
from revwatch.functions.text import JSON_SPACES, iso_timestamp
from revwatch.operators.matching import match_entity
from revwatch.sources.allowlist import Needle

# Routes a record can take.
SKIPPED = "skipped"  # no text at all
MALFORMED = "malformed"  # text that is not JSON: counted, not kept
DLQ = "dlq"  # JSON we cannot use: kept with the reason
FILTERED = "filtered"  # not a monitored page
CLEANED = "cleaned"  # a monitored page: goes out raw and enriched

# Queue topics and the metadata of an enriched record.
RAW_TOPIC, CLEANED_TOPIC, DLQ_TOPIC = "raw_events", "cleaned_events", "dlq_events"
METADATA_SOURCE, METADATA_VERSION = "wikimedia_sse", "1.0"
MISSING_FIELDS = "Missing required fields"

NOT_AN_OBJECT = "Record is not a JSON object"
TITLE_NOT_TEXT = "Title is not a text"


def _decoded(records: DataFrame) -> DataFrame:
    """Add the parsed text and whether it holds an object.

    Text that parses and begins with a brace is an object; asking the parsed
    value for its schema would cost more.
    """
    opens = F.startswith(F.btrim("value", F.lit(JSON_SPACES)), F.lit("{"))
    return computed_once(records, {"_json": F.try_parse_json("value"), "_is_object": opens})


def _member(key: str) -> Column:
    """A member of the record as it came: null if absent, a JSON null if null."""
    return F.variant_get("_json", f"$.{key}", "variant")


def _has_key(key: str) -> Column:
    """Present, even with a null value."""
    return _member(key).isNotNull()


def _as_text(member: str) -> Column:
    return F.try_variant_get(member, "$", "string")


def _without(member: str) -> Column:
    """The object text, trimmed, without a member it may already have."""
    others = F.map_filter(F.from_json("value", "map<string,variant>"), lambda k, _: k != member)
    return F.when(_has_key(member), F.to_json(others)).otherwise(
        F.btrim("value", F.lit(JSON_SPACES))
    )


def _opened(text: str) -> Column:
    """An object text up to its closing brace."""
    return F.substring(F.col(text), F.lit(1), F.length(text) - 1)


def _metadata(now: Column) -> Column:
    return F.to_json(
        F.struct(
            iso_timestamp(now).alias("ingestion_timestamp"),
            F.lit(METADATA_SOURCE).alias("source"),
            F.lit(METADATA_VERSION).alias("version"),
            F.col("canonical_entity"),
        )
    )


def route_events(
    records: DataFrame,
    allowlist: Sequence[Needle],
    now: Column | None = None,
    match_strategy: str | None = None,
) -> DataFrame:
    """Add ``route``, ``key``, ``canonical_entity``, ``enriched`` and ``error`` to records.

    ``records`` has a ``value`` column with one JSON text per row. The text is
    parsed once; everything is expression work plus the allowlist join, so the
    same call serves a stream and a batch.
    """
    clock = F.current_timestamp() if now is None else now
    parsed = (
        _decoded(records)
        .withColumns({"_title": _member("title"), "_wiki": _member("wiki")})
        .withColumns(
            {
                "_complete": F.col("_title").isNotNull() & F.col("_wiki").isNotNull(),
                "_title_is_text": F.coalesce(F.schema_of_variant("_title") == "STRING", F.lit(False)),
                "title": _as_text("_title"),
                "wiki": _as_text("_wiki"),
            }
        )
        .drop("_title", "_wiki")
    )
    matched = match_entity(parsed, allowlist, strategy=match_strategy)
    error = (
        F.when(~F.col("_is_object"), NOT_AN_OBJECT)
        .when(~F.col("_complete"), MISSING_FIELDS)
        .when(~F.col("_title_is_text"), TITLE_NOT_TEXT)
    )
    route = (
        F.when(F.coalesce(F.col("value"), F.lit("")) == "", SKIPPED)
        .when(F.col("_json").isNull(), MALFORMED)
        .when(F.col("error").isNotNull(), DLQ)
        .when(F.col("canonical_entity").isNull(), FILTERED)
        .otherwise(CLEANED)
    )
    cleaned = F.col("route") == CLEANED
    return (
        matched.withColumn("error", F.when(F.col("_json").isNotNull(), error))
        .withColumn("route", route)
        .withColumns(
            {
                "key": F.when(cleaned, F.concat("wiki", F.lit(":"), "title")),
                "_kept": F.when(cleaned, _without("_metadata")),
            }
        )
        # The text is spliced, so members we do not know survive as they came.
        .withColumn(
            "enriched",
            F.concat(_opened("_kept"), F.lit(',"_metadata":'), _metadata(clock), F.lit("}")),
        )
        .select(*records.columns, "route", "key", "canonical_entity", "enriched", "error")
    )


def dlq_record(original: Column, error: Column, now: Column, target: Column | None = None) -> Column:
    """JSON text of a dead letter; ``original_event`` stays nested JSON."""
    fields = [
        F.try_parse_json(original).alias("original_event"),
        error.alias("error"),
        iso_timestamp(now).alias("timestamp"),
    ]
    if target is not None:
        fields.append(target.alias("target_topic"))
    return F.to_json(F.struct(*fields))


def queue_records(routed: DataFrame, now: Column | None = None) -> DataFrame:
    """The queue messages of routed records: ``topic``, ``key``, ``value``.

    A cleaned record yields two messages and a dead letter one, in a single pass
    over the input. The result can be written with Spark's queue sink or split
    by topic into tables.
    """
    clock = F.current_timestamp() if now is None else now

    def message(topic: str, key: Column, value: Column) -> Column:
        return F.struct(F.lit(topic).alias("topic"), key.alias("key"), value.alias("value"))

    no_key = F.lit(None).cast("string")
    sent = F.when(
        F.col("route") == CLEANED,
        F.array(
            message(RAW_TOPIC, F.col("key"), F.col("value")),
            message(CLEANED_TOPIC, F.col("key"), F.col("enriched")),
        ),
    ).when(
        F.col("route") == DLQ,
        F.array(message(DLQ_TOPIC, no_key, dlq_record(F.col("value"), F.col("error"), clock))),
    )
    return routed.select(F.inline(sent))


def _counters() -> list[Column]:
    def of(*routes: str) -> Column:
        return F.count_if(F.col("route").isin(*routes))

    return [
        of(DLQ, FILTERED, CLEANED).alias("processed"),
        of(FILTERED).alias("filtered"),
        # A cleaned record goes to two topics, a dead letter to one.
        (of(CLEANED) * 2 + of(DLQ)).alias("sent"),
        (of(MALFORMED) + F.count_if(F.col("error").isNotNull() & (F.col("error") != MISSING_FIELDS)))
        .alias("errors"),
    ]


def route_counters(routed: DataFrame) -> DataFrame:
    """One row: records processed, filtered, sent and in error."""
    return routed.agg(*_counters())


def observed_routes(routed: DataFrame, observation: Observation | str = "ingest") -> DataFrame:
    """``routed`` as it is; what consumes it yields the counters of :func:`route_counters` too.

    A batch reads them from its ``Observation`` once the consuming job has ended; a stream
    reports them, under the name given, with its progress. The consumer has to be a plan
    without a shuffle behind this point, as the writing of the messages is: the tasks of
    a write count once however often they are run again, those of a shuffle would not.
    """
    return routed.observe(observation, *_counters())


def unfiltered_records(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Every decodable object, keyed by its ``id``, with an arrival stamp added."""
    clock = F.current_timestamp() if now is None else now
    stamp = F.concat(F.lit('"_ingestion_timestamp":"'), iso_timestamp(clock), F.lit('"}'))
    objects = _decoded(records).filter("_json IS NOT NULL AND _is_object")
    member = objects.withColumns({"_id": _member("id"), "_kept": _without("_ingestion_timestamp")})
    opened = member.withColumn("_opened", _opened("_kept"))
    comma = F.when(F.btrim("_opened", F.lit(JSON_SPACES)) == "{", "").otherwise(",")
    return opened.select(
        F.lit(RAW_TOPIC).alias("topic"),
        F.coalesce(
            F.when(F.is_variant_null("_id"), "None").otherwise(_as_text("_id")), F.lit("")
        ).alias("key"),
        F.concat("_opened", comma, stamp).alias("value"),
    )
