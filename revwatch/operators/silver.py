"""Cleaned layer: parse the JSON text, derive quality features, drop replays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.functions import text
from revwatch.functions.columns import computed_once
from revwatch.schemas import EVENT, SILVER

#: Fixed value: an edit that moves more bytes than this is large.
LARGE_EDIT_BYTES = 10240

#: Where each parsed column sits in the record.
EXTRACTED = {
    "wikimedia_id": "id",
    "event_type": "type",
    "namespace": "namespace",
    "title": "title",
    "title_url": "title_url",
    "comment": "comment",
    "event_timestamp": "timestamp",
    "user_name": "user",
    "is_bot": "bot",
    "is_minor": "minor",
    "wiki": "wiki",
    "server_url": "server_url",
    "notify_url": "notify_url",
    "length_old": "length.old",
    "length_new": "length.new",
    "revision_old": "revision.old",
    "revision_new": "revision.new",
    "meta_id": "meta.id",
    "meta_dt": "meta.dt",
    "meta_domain": "meta.domain",
    "canonical_entity": "_metadata.canonical_entity",
}

# Last second that still prints as a four-digit year.
_LAST_SECOND = 253402300799


def parse_events(bronze: DataFrame) -> DataFrame:
    """Bronze rows plus the extracted fields.

    Text that is not JSON leaves every field null; a field of the wrong type
    leaves only itself null.
    """
    parsed = computed_once(bronze, {"_event": F.from_json("event_data", EVENT)})
    fields = [F.col(f"_event.{path}").alias(name) for name, path in EXTRACTED.items()]
    return parsed.select(*bronze.columns, *fields)


def shredded(bronze: DataFrame) -> DataFrame:
    """Bronze rows with ``event``, the text parsed once; null where it is not a JSON object.

    Stored as Parquet the members become columns of their own, and a reader that asks for
    some paths reads these.
    """
    # Of valid JSON the first character tells; a whole object's schema is long to write out.
    is_object = F.startswith(F.btrim("event_data", F.lit(text.JSON_SPACES)), F.lit("{"))
    return bronze.withColumn("event", F.when(is_object, F.try_parse_json("event_data")))


def _member_type(path: str) -> T.DataType:
    kind = EVENT
    for name in path.split("."):
        kind = kind[name].dataType
    return kind


def _member(path: str) -> Column:
    """The member of ``event`` at a path, null where its type is not the record's.

    As a parser with a schema has it: whole numbers alone are numbers, and a text column
    takes the JSON of whatever else is there.
    """
    kind = _member_type(path)
    value = F.try_variant_get("event", f"$.{path}", "variant")
    is_a = F.schema_of_variant(value)
    if isinstance(kind, T.StringType):
        text = F.try_variant_get("event", f"$.{path}", "string")
        return F.when(is_a == "STRING", text).when(is_a != "VOID", F.to_json(value))
    wanted = "BOOLEAN" if isinstance(kind, T.BooleanType) else "BIGINT"
    return F.when(is_a == wanted, F.try_variant_get("event", f"$.{path}", kind.simpleString()))


def parse_shredded(bronze: DataFrame) -> DataFrame:
    """As :func:`parse_events`, from the members of ``event`` instead of the text.

    Numbers in text columns come out in their canonical form (``1.5`` for ``1.50``).
    """
    fields = [_member(path).alias(name) for name, path in EXTRACTED.items()]
    return bronze.select(*(c for c in bronze.columns if c != "event"), *fields)


def _size_change() -> Column:
    """New minus old length as BIGINT, so that extreme lengths cannot overflow."""
    old, new = (
        F.coalesce(F.col(name), F.lit(0)).cast("bigint") for name in ("length_old", "length_new")
    )
    return new - old


def _bot_flag_agrees() -> Column:
    """Does the bot flag agree with the name? Unknown without a name."""
    named_bot = F.col("user_name").rlike(text.BOT_PATTERN)
    return F.when(F.col("is_bot"), named_bot).otherwise(~named_bot)


def _utc_safe_hour(epoch: Column) -> Column:
    return F.when(
        epoch.between(-_LAST_SECOND, _LAST_SECOND), F.hour(F.timestamp_seconds(epoch))
    )


def derive(parsed: DataFrame) -> DataFrame:
    """Add the derived columns the later layers aggregate."""
    change = _size_change()
    epoch = F.col("event_timestamp")
    arrival = F.col("ingestion_timestamp")
    return parsed.withColumns(
        {
            "bytes_changed": change.try_cast("int"),
            "is_revert": change < 0,
            "is_anonymous": text.is_network_address(F.col("user_name")),
            "event_hour": _utc_safe_hour(epoch),
            "processing_lag_seconds": F.try_subtract(F.unix_timestamp(arrival), epoch),
            "has_comment": F.coalesce(F.length("comment"), F.lit(0)) > 0,
            "is_large_edit": F.abs(change) > LARGE_EDIT_BYTES,
            "is_bot_consistent": _bot_flag_agrees(),
            "is_allowlisted": F.col("canonical_entity").isNotNull(),
            "event_date": F.to_date(arrival),
        }
    )


def to_silver(derived: DataFrame) -> DataFrame:
    """The Silver columns in table order; columns the frame lacks are left out."""
    present = set(derived.columns)
    return derived.select([name for name in SILVER.fieldNames() if name in present])


def _lineage_columns(df: DataFrame) -> list[str]:
    known = ("kafka_topic", "kafka_partition", "kafka_offset")
    return [name for name in known if name in df.columns]


def _origin(df: DataFrame) -> Column:
    """Where a row without ``meta_id`` came from; null for rows that have one.

    Rows without an id are not copies of each other; told apart by queue
    coordinates and text (backfilled rows share their coordinates) each of them
    reaches the quality gate.
    """
    parts = [F.col(name) for name in _lineage_columns(df)]
    if "event_data" in df.columns:
        parts.append(F.sha2("event_data", 256).alias("text"))
    return F.when(F.col("meta_id").isNull(), F.to_json(F.struct(*parts)))


def drop_replays(events: DataFrame, within: str | None = None) -> DataFrame:
    """Keep the first row of each ``meta_id``.

    On a stream the first row *seen* wins and its id is remembered until the
    watermark has moved past it (``within`` sets a watermark first); a copy that
    comes later than that is let through. On a batch frame the earliest arrival
    wins, over the whole frame: ``row_number() = 1`` plans a group limit below
    the shuffle, so each map task sends at most one row per id and a much
    repeated id does not gather in one reducer.
    """
    keyed = events.withColumn("_origin", _origin(events))
    key = ["meta_id", "_origin"]
    if events.isStreaming:
        if within is not None:
            keyed = keyed.withWatermark("ingestion_timestamp", within)
        return keyed.dropDuplicatesWithinWatermark(key).drop("_origin")
    arrival = [F.col(name) for name in ("ingestion_timestamp", *_lineage_columns(events))]
    if "event_data" in events.columns:  # backfilled rows share their coordinates
        arrival.append(F.sha2("event_data", 256))
    first = Window.partitionBy(*key).orderBy(*arrival)
    ranked = keyed.withColumn("_rank", F.row_number().over(first))
    return ranked.filter("_rank = 1").drop("_rank", "_origin")


def bronze_to_silver(bronze: DataFrame) -> DataFrame:
    """Parse, derive, drop replays and project: the whole step, batch or stream.

    Rows with an ``event`` column (:func:`shredded`) are not parsed again.
    """
    parsed = parse_shredded(bronze) if "event" in bronze.columns else parse_events(bronze)
    return to_silver(drop_replays(derive(parsed)))
