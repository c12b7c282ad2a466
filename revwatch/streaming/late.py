"""Late rows as an output of the query that would drop them.

A windowed aggregation drops rows whose window lies behind the watermark and says no more
than how many. Here the query's rows pass through beside its windows, in one plan over one
source, and each micro-batch compares them with the watermark that the aggregation itself
used for this batch. What came in is then either in a window (closed or still open) or late.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.operators.states import window_seconds

BEHIND, NO_TIME = "behind the watermark", "without a time"

_WINDOW, _ROW = "_window", "_row"
_MULTIPLE = "spark.sql.streaming.statefulOperator.allowMultiple"


def late_watermark(spark: SparkSession, checkpoint: str, batch: int) -> int:
    """The watermark, in milliseconds, that decides what is late in a micro-batch.

    Taken from the offset log of the query's checkpoint, so a batch that is run again
    after a failure sees the same one. Spark drops by the watermark of the batch before,
    which had closed the windows, where several stateful operators are allowed.
    """

    def logged(number: int) -> dict:
        lines = spark.read.text(f"{checkpoint}/offsets/{number}", wholetext=True).first()[0].split("\n")
        return json.loads(lines[1])

    now = logged(batch)
    if now.get("conf", {}).get(_MULTIPLE, "true") == "false":
        return now["batchWatermarkMs"]
    return logged(batch - 1)["batchWatermarkMs"] if batch else 0


def beside(windows: DataFrame, rows: DataFrame) -> DataFrame:
    """Windows and rows in one stream, each row one of the two."""

    def only(df: DataFrame, name: str, other: DataFrame, missing: str) -> DataFrame:
        none = F.lit(None).cast(other.schema).alias(missing)
        both = {name: F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name), missing: none}
        return df.select(both[_WINDOW], both[_ROW])

    return only(windows, _WINDOW, rows, _ROW).unionAll(only(rows, _ROW, windows, _WINDOW))


def split(
    batch: DataFrame, watermark: int, length: str | None, moment: str = "ingestion_timestamp"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(what is kept of the batch, its windows, its late rows with ``late_reason`` and ``late_watermark``).

    A row is late where its window of ``length`` ends at or before the watermark; without a
    length where its own time does, as an operator that drops copies has it. Windows and late
    rows read the first, which leaves out the rows that are in time, so it is small enough
    to persist.
    """
    at = F.col(f"{_ROW}.{moment}")
    mark: Column = F.timestamp_millis(F.lit(watermark))
    end = at
    if length is not None:  # windows are aligned to the epoch
        seconds = window_seconds(length)
        end = F.timestamp_seconds((F.floor(F.unix_micros(at) / (seconds * 1_000_000)) + 1) * seconds)
    reason = F.when(F.col(_ROW).isNull(), None).when(at.isNull(), NO_TIME).when(end <= mark, BEHIND)
    kept = batch.withColumn("_late", reason).where(F.col(_WINDOW).isNotNull() | F.col("_late").isNotNull())
    return (
        kept,
        kept.where(F.col(_WINDOW).isNotNull()).select(f"{_WINDOW}.*"),
        kept.where(F.col(_ROW).isNotNull()).select(
            f"{_ROW}.*", F.col("_late").alias("late_reason"), mark.alias("late_watermark")
        ),
    )
