"""Message queue source and replay positions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Reader options of the queue connector.
READER_OPTIONS = {
    "kafka.security.protocol": "SSL",
    "failOnDataLoss": "false",
    "kafka.request.timeout.ms": "120000",
    "kafka.session.timeout.ms": "60000",
    "kafka.heartbeat.interval.ms": "10000",
    "kafka.connections.max.idle.ms": "180000",
    "kafka.metadata.max.age.ms": "180000",
    "kafka.reconnect.backoff.ms": "1000",
    "kafka.reconnect.backoff.max.ms": "10000",
    "kafka.retry.backoff.ms": "500",
}


def queue_options(servers: str, topic: str, starting_offsets: str | dict = "latest") -> dict[str, str]:
    """Options to subscribe to one topic from ``latest``, ``earliest`` or given offsets."""
    if isinstance(starting_offsets, dict):
        starting_offsets = json.dumps(starting_offsets)
    elif starting_offsets not in ("latest", "earliest"):
        json.loads(starting_offsets)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        **READER_OPTIONS,
    }


def read_queue(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str | dict = "latest"
) -> DataFrame:
    """Stream a topic. Needs Spark's Kafka connector on the class path."""
    options = queue_options(servers, topic, starting_offsets)
    return spark.readStream.format("kafka").options(**options).load()


def write_queue(messages: DataFrame, servers: str, checkpoint: str):
    """Start sending ``topic, key, value`` messages. Needs the Kafka connector."""
    return (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def from_offsets(offsets: str | dict) -> Column:
    """Condition on Bronze rows: at or behind the given ``{topic: {partition: offset}}``.

    As for a subscription, ``-2`` stands for the earliest offset; a partition
    that is not listed is read from its beginning. ``-1``, the latest offset, has no
    meaning for stored rows and is refused.
    """
    given = json.loads(offsets) if isinstance(offsets, str) else offsets
    if any(int(o) == -1 for partitions in given.values() for o in partitions.values()):
        raise ValueError("-1 (latest) selects nothing among stored rows")
    keep = F.lit(False)
    for topic, partitions in given.items():
        start = F.lit(0).cast("bigint")
        for partition, offset in partitions.items():
            here = F.col("kafka_partition") == int(partition)
            start = F.when(here, F.lit(max(int(offset), 0)).cast("bigint")).otherwise(start)
        keep = keep | ((F.col("kafka_topic") == topic) & (F.col("kafka_offset") >= start))
    return keep
