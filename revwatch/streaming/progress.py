"""Progress of streaming queries as table rows."""

from __future__ import annotations

import json
import threading
import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from revwatch.schemas import PROGRESS


def _offsets_behind(progress) -> int | None:
    """Messages the sources have not delivered yet, where a source reports it."""
    known = [
        int(float(source.metrics["maxOffsetsBehindLatest"]))
        for source in progress.sources
        if source.metrics and "maxOffsetsBehindLatest" in source.metrics
    ]
    return max(known) if known else None


def _dropped_late(progress) -> int | None:
    """Rows that stateful operators dropped behind the watermark, where there are such operators.

    An aggregation counts them after it has grouped them within tasks.
    """
    counts = [operator.numRowsDroppedByWatermark for operator in progress.stateOperators]
    return sum(counts) if counts else None


def _observed(progress) -> str | None:
    """Observed metrics as JSON, by name."""
    found = {name: row.asDict() for name, row in (progress.observedMetrics or {}).items()}
    return json.dumps(found, default=str) if found else None


class ProgressLog(StreamingQueryListener):
    """Collects one row per micro-batch; :meth:`flush` appends them to a table.

    The callback runs on Spark's listener thread, so it only notes the figures.
    A full buffer (``every`` rows) and the end of a query write them out.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self._spark, self._path, self._every = spark, path, every
        self._rows: list[tuple] = []
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (
            p.name,
            str(p.id),
            p.batchId,
            p.timestamp,
            p.numInputRows,
            float(p.inputRowsPerSecond),
            float(p.processedRowsPerSecond),
            _offsets_behind(p),
            (p.eventTime or {}).get("watermark"),
            _dropped_late(p),
            _observed(p),
            datetime.fromisoformat(p.timestamp.replace("Z", "+00:00")).date(),
        )
        with self._lock:
            self._rows.append(row)
            full = len(self._rows) >= self._every
        if full:
            self.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        with self._lock:
            rows, self._rows = self._rows, []
        if rows:
            # A partition of its own per flush: several jobs may log to one table,
            # and plain appends to one folder would share a temporary folder.
            frame = self._spark.createDataFrame(rows, PROGRESS).coalesce(1)
            (
                frame.withColumn("flush_id", F.lit(uuid.uuid4().hex))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("event_date", "flush_id")
                .parquet(self._path)
            )
