"""Historic records and samples from files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.functions.columns import computed_once

BACKFILL_TOPIC = "backfill"


def to_backfill(lines: DataFrame, now: Column | None = None) -> DataFrame:
    """Bronze rows of historic record texts (column ``value``).

    The text is kept as it is; only ``id`` and ``timestamp`` are read from it.
    The date is the record's own, from its epoch seconds.
    """
    record = F.from_json("value", "id STRING, timestamp BIGINT")
    return computed_once(lines, {"_record": record}).select(
        F.col("_record.id").alias("event_id"),
        F.col("value").alias("event_data"),
        F.lit(BACKFILL_TOPIC).alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.lit(0).cast("bigint").alias("kafka_offset"),
        (F.current_timestamp() if now is None else now).alias("ingestion_timestamp"),
        F.to_date(F.timestamp_seconds("_record.timestamp")).alias("event_date"),
    )


def read_backfill(spark: SparkSession, path: str, now: Column | None = None) -> DataFrame:
    """Bronze rows of a folder of JSON lines."""
    return to_backfill(spark.read.text(path), now)


def sample_records(spark: SparkSession, path: str, max_events: int = 10) -> DataFrame:
    """Up to ``max_events`` decodable records of a folder of JSON lines.

    A look at the data, so the limit is the feature; Spark stops reading early.
    """
    lines = spark.read.text(path)
    return lines.filter(F.try_parse_json("value").isNotNull()).limit(max_events)


def save_sample(sample: DataFrame, path: str) -> None:
    """Write a sample as JSON lines."""
    sample.coalesce(1).write.mode("overwrite").text(path)
