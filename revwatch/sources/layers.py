"""Streaming reads of the layer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revwatch.schemas import BRONZE, BRONZE_SHREDDED, BRONZE_TABLE, SHREDDED_TABLE, SILVER, SILVER_TABLE
from revwatch.sinks.warehouse import Warehouse

#: Batches so named put earlier rows in place again; a stream has delivered those already.
REPLAY = "replay_"

BRONZE_WATERMARK = "1 hour"
# Backfilled records share their coordinates, so the id belongs to the key.
RECORD_KEY = ["kafka_topic", "kafka_partition", "kafka_offset", "meta_id"]


def _follow(spark: SparkSession, root: str, table: str, schema, max_files: int | None) -> DataFrame:
    """Rows of appended batches, without those rolled back by the time the stream starts.

    Spark lists the static side of a join once, when the stream starts: after a rollback, streams over
    the table are started again from their checkpoints. Rows a stream has taken up before
    are not undone by that, and a batch it passed over is brought back by a replay.
    """
    reader = spark.readStream.schema(StructType([*schema.fields, StructField("batch_id", StringType())]))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The batch is a partition, so files of replays are not read.
    fresh = ~F.startswith(F.col("batch_id"), F.lit(REPLAY))
    rows = reader.parquet(f"{root}/{table}").where(fresh)
    hidden = Warehouse(spark, root).hidden_batches(table)
    if hidden is not None:
        rows = rows.join(hidden, "batch_id", "left_anti")
    return rows.select(*schema.fieldNames())


def follow_bronze(
    spark: SparkSession,
    root: str,
    watermark: str = BRONZE_WATERMARK,
    max_files: int | None = None,
    shredded: bool = False,
) -> DataFrame:
    """New Bronze rows, with the watermark the replay filter remembers ids for.

    ``shredded`` follows the table of records that are parsed already.
    """
    table, schema = (SHREDDED_TABLE, BRONZE_SHREDDED) if shredded else (BRONZE_TABLE, BRONZE)
    rows = _follow(spark, root, table, schema, max_files)
    return rows.withWatermark("ingestion_timestamp", watermark)


def follow_silver(
    spark: SparkSession,
    root: str,
    watermark: str = "10 minutes",
    max_files: int | None = None,
    once_per_record: bool = True,
) -> DataFrame:
    """New Silver rows, each queue record once.

    Appended batches are followed, replays are not. A file stream sees the files of a
    batch that was written twice as new files; within the watermark the record key drops
    the second copy.
    """
    rows = _follow(spark, root, SILVER_TABLE, SILVER, max_files)
    rows = rows.withWatermark("ingestion_timestamp", watermark)
    return rows.dropDuplicatesWithinWatermark(RECORD_KEY) if once_per_record else rows
