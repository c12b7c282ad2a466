"""Staging of quarantined rows for repair: a bucketed catalog table that a repair consumes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.operators.quality import QualityGate
from revwatch.plans.recovery import reprocess_quarantine
from revwatch.schemas import QUARANTINE, SILVER, SILVER_TABLE
from revwatch.sinks.warehouse import Warehouse
from revwatch.sources.layers import RECORD_KEY

STAGING = "quarantine_staging"
BUCKETS = 64
KEY = "record_key"

_SCHEMA = T.StructType([*QUARANTINE.fields, T.StructField(KEY, T.StringType())])


def record_key() -> Column:
    """The queue record of a row as one text without nulls, to be joined by plain equality."""
    return F.to_json(F.struct(*(F.col(k).cast("string").alias(k) for k in RECORD_KEY)))


class QuarantineStaging:
    """Chosen quarantined rows between an operator's selection and their repair.

    The table is bucketed by the queue record, as the repair looks each record up in Silver:
    only Silver's keys are shuffled. It lies under the warehouse, so that whoever reads the
    catalog can look at what is about to be repaired.
    """

    def __init__(self, warehouse: Warehouse, name: str = STAGING, buckets: int = BUCKETS):
        self.warehouse, self.name, self.buckets = warehouse, name, buckets
        self._spark = warehouse.spark

    def _write(self, rows: DataFrame, mode: str) -> None:
        (
            rows.repartition(self.buckets, KEY)
            .write.mode(mode)
            .format("parquet")
            .bucketBy(self.buckets, KEY)
            .sortBy(KEY)
            .option("path", self.warehouse.path(self.name))
            .saveAsTable(self.name)
        )

    def stage(self, selection: DataFrame) -> int:
        """Add the rows of ``selection`` that are not staged yet; returns how many are staged now."""
        key = F.from_json("original_record", T.StructType([SILVER[k] for k in RECORD_KEY]))
        keyed = selection.select(*QUARANTINE.fieldNames(), key.alias("_key")).select(
            *QUARANTINE.fieldNames(), "_key.*"
        )
        rows = keyed.select(*QUARANTINE.fieldNames(), record_key().alias(KEY))
        if self._spark.catalog.tableExists(self.name):
            # Quarantined once per record and text: the same row is staged once.
            rows = rows.join(self.rows().select(KEY, "original_record"), [KEY, "original_record"], "left_anti")
            self._write(rows, "append")
        else:
            self._write(rows, "errorifexists")
        return self.rows().count()

    def rows(self) -> DataFrame:
        """What is staged."""
        if not self._spark.catalog.tableExists(self.name):
            return self._spark.createDataFrame([], _SCHEMA)
        return self._spark.table(self.name)

    def open_rows(self) -> DataFrame:
        """Staged rows whose record Silver does not hold."""
        stored = self.warehouse.read(SILVER_TABLE).select(record_key().alias(KEY))
        return self.rows().join(stored, KEY, "left_anti")

    def repair(
        self, fix: Callable[[DataFrame], DataFrame] | None = None, gate: QualityGate | None = None
    ) -> dict | None:
        """Repair what is staged and not stored, then clear the staging.

        Rows that still fail go back to quarantine. A run that stops before the staging is
        cleared is run again: the repaired rows are stored by then and are not added twice.
        """
        metrics = reprocess_quarantine(self.warehouse, self.open_rows().drop(KEY), fix, gate)
        self.clear()
        return metrics

    def clear(self) -> None:
        """Empty the staging; the table stays."""
        if self._spark.catalog.tableExists(self.name):
            self._spark.createDataFrame([], _SCHEMA).write.mode("overwrite").insertInto(self.name)
            self._spark.catalog.refreshTable(self.name)
