"""Raw layer: queue records with their full lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_bronze(records: DataFrame, now: Column | None = None) -> DataFrame:
    """Project queue records (batch or stream) onto the Bronze columns.

    ``now`` is the arrival clock. On a stream the default keeps one value per
    micro-batch, also when the batch is retried.
    """
    arrival = F.current_timestamp() if now is None else now
    return records.select(
        F.col("key").cast("string").alias("event_id"),
        F.col("value").cast("string").alias("event_data"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        arrival.alias("ingestion_timestamp"),
        F.to_date(arrival).alias("event_date"),
    )
