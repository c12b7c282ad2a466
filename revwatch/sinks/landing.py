"""Landing raw records as JSON lines in folders per hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.operators.ingest import CLEANED_TOPIC, DLQ_TOPIC, RAW_TOPIC
from revwatch.schemas import TOPICS_TABLE
from revwatch.sinks.warehouse import Warehouse

# Folder zone, records per file and seconds between two files.
LANDING_ZONE = "Europe/Berlin"
RECORDS_PER_FILE = 100
ROTATE_SECONDS = 60

FOLDERS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def landing_folders(moment: Column, zone: str = LANDING_ZONE) -> dict[str, Column]:
    """``year``, ``month``, ``day`` and ``hour`` of a moment in the landing zone."""
    local = F.from_utc_timestamp(moment, zone)
    return {name: F.date_format(local, form) for name, form in FOLDERS.items()}


def with_landing_folders(records: DataFrame, moment: str = "timestamp") -> DataFrame:
    return records.withColumns(landing_folders(F.col(moment)))


def land_stream(
    records: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    records_per_file: int = RECORDS_PER_FILE,
):
    """Start landing a stream of ``value`` texts; a file every minute or 100 records.

    Give more ``records_per_file`` where the stream is large.
    """
    trigger = {"availableNow": True} if once else {"processingTime": f"{ROTATE_SECONDS} seconds"}
    lines = with_landing_folders(records).select(F.col("value").cast("string").alias("value"), *FOLDERS)
    return (
        lines.writeStream.format("text")
        .partitionBy(*FOLDERS)
        .option("maxRecordsPerFile", records_per_file)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def write_topics(
    warehouse: Warehouse, messages: DataFrame, batch_id: str, now: Column | None = None
) -> None:
    """Store queue messages of all three topics in one write, made visible by one commit.

    The topic is the leading partition column, so the three outputs come from one pass
    over the batch and a reader of one does not touch the others. A write that fails
    half way shows none of them; a batch that is visible is left as it is.
    """
    clock = F.current_timestamp() if now is None else now
    known = messages.filter(F.col("topic").isin(RAW_TOPIC, CLEANED_TOPIC, DLQ_TOPIC))
    warehouse.append(known.withColumn("event_date", F.to_date(clock)), TOPICS_TABLE, batch_id, gather=False)


def read_topic(warehouse: Warehouse, topic: str) -> DataFrame:
    """The visible messages of one topic, in the columns a queue has."""
    if topic not in (RAW_TOPIC, CLEANED_TOPIC, DLQ_TOPIC):
        raise ValueError(f"unknown topic {topic!r}")
    return warehouse.read(TOPICS_TABLE).filter(F.col("topic") == topic).select("topic", "key", "value", "event_date")
