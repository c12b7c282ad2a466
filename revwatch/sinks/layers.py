"""What a layer does with a batch: gate it, store it, record how it went."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from revwatch.operators.quality import GateResult, QualityGate, quarantine_rows
from revwatch.schemas import ALERTS, CONSTRAINT_STATES, QUALITY_METRICS
from revwatch.sinks.warehouse import Warehouse, utc_now

log = logging.getLogger(__name__)

FALLBACK = "quarantine_fallback"


def write_quarantine(warehouse: Warehouse, result: GateResult) -> int:
    """Store the failed rows of a gated batch; returns how many there are.

    If the table cannot be written, the rows go to a plain folder beside it.
    """
    count = result.metrics["failed_count"]
    if not count:
        return 0
    layer, batch_id = result.metrics["layer"], result.metrics["batch_id"]
    rows = quarantine_rows(result.failed, batch_id, result.metrics["failed_checks"])
    try:
        warehouse.append(rows, f"{layer}_quarantine", batch_id, row_count=count)
    except PySparkException as error:
        log.error("quarantine table of %s failed, using the fallback folder: %s", layer, error)
        (
            rows.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "batch_id")
            .parquet(f"{warehouse.path(FALLBACK)}/{layer}")
        )
    return count


def record_metrics(warehouse: Warehouse, result: GateResult) -> None:
    """One row in ``quality_metrics``, the counts behind it in ``constraint_states``, an alert if due."""
    m, now = result.metrics, utc_now()
    row = (
        m["batch_id"],
        m["layer"],
        m["total_count"],
        m["passed_count"],
        m["failed_count"],
        float(m["pass_rate"]),
        json.dumps(m["failed_checks"]),
        now,
        now.date(),
    )
    metrics = warehouse.spark.createDataFrame([row], QUALITY_METRICS).coalesce(1)
    warehouse.append(metrics, "quality_metrics", m["batch_id"])
    states = warehouse.spark.createDataFrame(m["states"], CONSTRAINT_STATES).coalesce(1)
    warehouse.append(states, "constraint_states", m["batch_id"])
    alert = result.alert()
    if alert is not None:
        line = (*(alert[name] for name in ALERTS.fieldNames()[:-2]), now, now.date())
        alerts = warehouse.spark.createDataFrame([line], ALERTS).coalesce(1)
        warehouse.append(alerts, "alerts", m["batch_id"])


def write_batch(
    warehouse: Warehouse,
    table: str,
    df: DataFrame,
    batch_id: str,
    gate: QualityGate | None,
    keep: bool = True,
) -> dict | None:
    """Gate one batch and store both halves; ``None`` if there was nothing to do.

    Any error is raised, so a stream fails the batch and runs it again; each
    write replaces what an earlier attempt left.
    """
    if gate is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK) if keep else df
        try:
            if not kept.isEmpty():
                warehouse.append(kept, table, batch_id)
        finally:
            kept.unpersist()
        return None
    result = gate.run(df, batch_id, keep=keep)
    try:
        if not result.metrics["total_count"]:
            return None
        if result.metrics["passed_count"]:
            warehouse.append(
                result.passed,
                table,
                batch_id,
                row_count=result.metrics["passed_count"],
            )
        write_quarantine(warehouse, result)
        record_metrics(warehouse, result)
    finally:
        result.release()
    return result.metrics


def stream_batch_id(batch: DataFrame, name: str, number: int) -> str:
    """A name for a micro-batch that no other query's batch can have.

    Batch ids carry the streaming query's whole id: a query that starts over with a new
    checkpoint counts from zero again and must not be taken for the older one.
    """
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("no streaming query id: a batch without one could hide another")
    return f"{name}_{query}_{number}"


def batch_writer(
    warehouse: Warehouse, table: str, gate: QualityGate | None, name: str
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a layer."""

    def write(batch: DataFrame, number: int) -> None:
        metrics = write_batch(warehouse, table, batch, stream_batch_id(batch, name, number), gate)
        log.info("%s batch %s: %s", name, number, metrics)

    return write
