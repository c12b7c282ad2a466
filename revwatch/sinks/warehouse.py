"""Layer tables as partitioned Parquet folders under one root.

Every batch is written to its own ``batch_id`` partition with dynamic partition
overwrite, so a batch that is run again replaces what its first run left, and
jobs that write different batches do not get in each other's way. A row in
the table's commit log makes the batch visible to readers; the log also carries
rollbacks and replacements, which therefore move no data.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from revwatch.schemas import COMMITS, STATES_TABLE, TABLES, TOPICS_TABLE

APPEND, REPLACE, ROLLBACK = "append", "replace", "rollback"

#: Partition columns in front of ``batch_id``; all other tables have ``event_date``.
PARTITIONS = {
    "quality_metrics": ("layer", "event_date"),
    "alerts": ("layer", "event_date"),
    "constraint_states": ("layer", "event_date"),
    STATES_TABLE: ("family", "event_date"),
    TOPICS_TABLE: ("topic", "event_date"),
}
COMMIT_LOG = "commits"

#: Rows a file is meant to hold where Spark cannot cut files by size.
ROWS_PER_FILE = 1_000_000


class SchemaDrift(ValueError):
    """A stored table does not have the columns a writer would add to it."""


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _with_batch(schema: StructType) -> StructType:
    if "batch_id" in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField("batch_id", StringType())])


class Warehouse:
    """Named tables below ``root``, which every executor must be able to reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def exists(self, name: str) -> bool:
        """Is there a folder of this name? Does not list what is in it."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return path.getFileSystem(conf).exists(path)

    def create_tables(self) -> None:
        """Make the folders of all layer tables, so that streams can follow them."""
        for table, schema in TABLES.items():
            if self.exists(table):
                check_schema(table, self._stored_columns(table))
            else:
                keys = PARTITIONS.get(table, ("event_date",))
                empty = self.spark.createDataFrame([], _with_batch(schema))
                empty.write.partitionBy(*keys, "batch_id").parquet(self.path(table))

    def _stored_columns(self, table: str) -> list[str]:
        try:
            return self.spark.read.parquet(self.path(table)).columns
        except AnalysisException:  # no file yet
            return []

    # Writing.

    def append(
        self,
        df: DataFrame,
        table: str,
        batch_id: str,
        partition_by: Sequence[str] | None = None,
        row_count: int | None = None,
        gather: bool = True,
    ) -> None:
        """Store one batch and make it visible.

        A batch that is visible already is left as it is: a stream that stopped
        between our commit and its own runs the batch again, and rewritten files
        would look new to the streams that follow the table.

        Rows are gathered by partition and files cut by size, so a small batch
        makes few and a date that holds much of the data several.
        ``row_count``, where it is known, is noted in the log. Without ``gather`` each
        task writes what it has, and the write adds no shuffle.
        """
        if self.is_committed(table, batch_id):
            return
        self._store(df, table, batch_id, partition_by, gather, row_count)
        self._commit(table, batch_id, APPEND, row_count=row_count)

    def replace_from(
        self,
        df: DataFrame,
        table: str,
        batch_id: str,
        from_date: date,
        partition_by: Sequence[str] | None = None,
    ) -> None:
        """Put ``df`` in the place of all rows from ``from_date`` on.

        The old rows stay visible until the new ones are completely written.
        """
        kept = df.filter(F.col("event_date") >= F.lit(from_date))
        self._store(kept, table, batch_id, partition_by)
        self._commit(table, batch_id, REPLACE, from_date=from_date)

    def rollback(self, table: str, to: datetime) -> None:
        """Make the table read as it did at ``to``."""
        stamp = f"rollback-{utc_now():%Y%m%dT%H%M%S%f}"
        self._commit(table, stamp, ROLLBACK, restored_to=to)

    def _store(self, df, table, batch_id, partition_by=None, gather=True, row_count=None) -> None:
        schema = TABLES.get(table)
        partition_by = partition_by or PARTITIONS.get(table, ("event_date",))
        if schema is not None:
            missing = [name for name in schema.fieldNames() if name not in df.columns]
            if missing:
                raise SchemaDrift(f"{table} needs the columns {missing}")
            df = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))
        if gather and df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            df = df.hint("rebalance", *partition_by)
        elif gather and row_count is not None:
            # Spark turns adaptive execution off for stateful micro-batches, and the hint with it.
            df = df.repartition(-(-row_count // ROWS_PER_FILE) or 1)
        (
            df.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by, "batch_id")
            .parquet(self.path(table))
        )

    def _commit(self, table, batch_id, action, from_date=None, restored_to=None, row_count=None):
        row = (table, batch_id, action, from_date, restored_to, row_count, utc_now())
        (
            self.spark.createDataFrame([row], COMMITS)
            .coalesce(1)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(self.path(f"{COMMIT_LOG}/{table}"))
        )

    def is_committed(self, table: str, batch_id: str) -> bool:
        """Can readers see this batch? Reads the log only for a batch that is in it."""
        if not self.exists(f"{COMMIT_LOG}/{table}/batch_id={batch_id}"):
            return False
        mine = F.col("batch_id") == batch_id
        return not self.visible_batches(table).filter(mine).isEmpty()

    # Reading.

    def commits(self, table: str) -> DataFrame:
        """The commit log of a table."""
        name = f"{COMMIT_LOG}/{table}"
        if not self.exists(name):
            return self.spark.createDataFrame([], COMMITS)
        return self.spark.read.schema(COMMITS).parquet(self.path(name))

    def visible_batches(self, table: str, as_of: datetime | None = None) -> DataFrame:
        """``(batch_id, before_date)`` of the batches a reader may see.

        A replacement hides the rows from its date on of all earlier batches;
        ``before_date`` is null where nothing is hidden. One row per batch, so
        this is small beside the data.
        """
        log = self.commits(table)
        if as_of is not None:
            log = log.filter(F.col("committed_at") <= F.lit(as_of))
        for after, until in self._undone(log):
            undone = (F.col("committed_at") > F.lit(after)) & (F.col("committed_at") <= F.lit(until))
            log = log.filter(~undone)
        later = (
            Window.partitionBy("table_name")
            .orderBy(F.desc("committed_at"))
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        replaced = F.when(F.col("action") == REPLACE, F.col("from_date"))
        return (
            log.filter(F.col("action") != ROLLBACK)
            .withColumn("before_date", F.min(replaced).over(later))
            .select("batch_id", "before_date")
        )

    def hidden_batches(self, table: str) -> DataFrame | None:
        """``batch_id`` of the batches that rollbacks have undone, ``None`` where there were no rollbacks.

        A batch that was written again since is visible and not among them.
        """
        log = self.commits(table).filter(F.col("action") != ROLLBACK)
        spans = self._undone(self.commits(table))
        if not spans:
            return None
        at = F.col("committed_at")
        undone = reduce(or_, ((at > F.lit(after)) & (at <= F.lit(until)) for after, until in spans))
        return log.filter(undone).select("batch_id")

    @staticmethod
    def _undone(log: DataFrame) -> list[tuple[datetime, datetime]]:
        """The spans of time that rollbacks undo.

        Read from the end, since a rollback also undoes the rollbacks in its
        span. Rollbacks are made by hand, so there are few of them.
        """
        rollbacks = log.filter(F.col("action") == ROLLBACK).select("restored_to", "committed_at")
        spans: list[tuple[datetime, datetime]] = []
        for restored_to, made in sorted(rollbacks.collect(), key=lambda row: row[1], reverse=True):
            if not spans or made <= spans[-1][0]:
                spans.append((restored_to, made))
        return spans

    def read(
        self,
        table: str,
        schema: StructType | None = None,
        as_of: datetime | None = None,
        committed: bool = True,
    ) -> DataFrame:
        """The visible rows of a table, now or as of an earlier moment.

        ``batch_id`` is a partition column, so batches that are not visible are
        not read. A table nobody has written yet reads as empty.
        """
        schema = schema or TABLES.get(table)
        if not self.exists(table):
            if schema is None:
                raise ValueError(f"unknown table {table}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(_with_batch(schema))
        rows = reader.parquet(self.path(table))
        if committed:
            shown = self.visible_batches(table, as_of)
            rows = rows.join(shown, "batch_id").filter(
                F.col("before_date").isNull() | (F.col("event_date") < F.col("before_date"))
            )
        if schema is not None:
            return rows.select(*schema.fieldNames())
        return rows.drop("batch_id", "before_date")

    def register(self, table: str, database: str | None = None) -> None:
        """Add a catalog entry for a table, or the partitions made since.

        The entry is the folder: it also shows batches that were replaced or rolled
        back. Use :meth:`create_views` for what readers should see.
        """
        name = f"{database}.{table}" if database else table
        if self.spark.catalog.tableExists(name):
            self.spark.catalog.recoverPartitions(name)
            return
        schema = _with_batch(TABLES[table])
        partitions = ", ".join([*PARTITIONS.get(table, ("event_date",)), "batch_id"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({partitions})"
            f" LOCATION '{self.path(table)}'"
        )
        self.spark.catalog.recoverPartitions(name)

    def create_views(self) -> None:
        """Temporary views of all tables under their own names, visible rows only."""
        for table in TABLES:
            self.read(table).createOrReplaceTempView(table)


def check_schema(table: str, stored: Sequence[str]) -> None:
    """Refuse a stored table that lacks columns, for instance of an older format.

    Nothing is dropped: old rows, above all quarantined ones, are evidence.
    """
    missing = [name for name in TABLES[table].fieldNames() if name not in stored]
    if stored and missing:
        raise SchemaDrift(f"stored table {table} lacks the columns {missing}; move it aside first")
