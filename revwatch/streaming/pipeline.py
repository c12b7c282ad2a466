"""The streaming jobs: ingest, Bronze, Silver and the three Gold families, alone or in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from revwatch.operators import states
from revwatch.operators.bronze import to_bronze
from revwatch.operators.gold import entity_metrics, global_metrics, user_metrics
from revwatch.operators.ingest import observed_routes, queue_records, route_counters, route_events
from revwatch.operators.quality import QualityGate, bronze_gate, gold_gate, silver_gate
from revwatch.operators.silver import bronze_to_silver, shredded
from revwatch.schemas import (
    BRONZE_TABLE,
    GOLD_ENTITY_TABLE,
    GOLD_GLOBAL_TABLE,
    GOLD_USER_TABLE,
    INGEST_COUNTERS,
    LATE_TABLE,
    SHREDDED_TABLE,
    SILVER_TABLE,
    STATES_TABLE,
    TOPICS_TABLE,
)
from revwatch.sinks.landing import write_topics
from revwatch.sinks.layers import batch_writer, stream_batch_id, write_batch
from revwatch.sinks.warehouse import Warehouse, utc_now
from revwatch.sources.allowlist import Needle
from revwatch.sources.layers import follow_bronze, follow_silver
from revwatch.streaming import late

#: Files a job takes up in one trigger, so that a first start does not read all history at once.
FILES_PER_TRIGGER = 1_000

# Trigger intervals.
BRONZE_TRIGGER, SILVER_TRIGGER, GOLD_TRIGGER = "2 minutes", "10 minutes", "10 minutes"

#: The Gold families: name, table, builder.
GOLD_FAMILIES = (
    ("entity", GOLD_ENTITY_TABLE, entity_metrics),
    ("user", GOLD_USER_TABLE, user_metrics),
    ("global", GOLD_GLOBAL_TABLE, global_metrics),
)


def start(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str,
    name: str,
    once: bool = False,
) -> StreamingQuery:
    """Start a query that hands its micro-batches to ``write``.

    ``once`` drains what is there now and stops, for catch-up runs and tests. No
    output mode is set: append, so a window is emitted once, when it is complete.
    ``write`` deals with empty batches itself: asking first would read the source,
    and run the stateful operators, one more time.
    """
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        df.writeStream.foreachBatch(write)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def store_ingest(
    warehouse: Warehouse,
    records: DataFrame,
    allowlist: Sequence[Needle],
    batch_id: str,
    match_strategy: str = "broadcast",
    now: Column | None = None,
) -> dict[str, int]:
    """Route a batch, store its messages and its counters; the counters come with the write.

    The broadcast strategy plans no shuffle, so the routes are observed in the tasks that
    write. The other one has shuffles, but in front of the routes.
    """
    routed = route_events(records, allowlist, now=now, match_strategy=match_strategy)
    if warehouse.is_committed(TOPICS_TABLE, batch_id):  # nothing will be written, so nothing observed
        counters = route_counters(routed).first().asDict()
    else:
        seen = Observation(f"ingest {batch_id}")
        write_topics(warehouse, queue_records(observed_routes(routed, seen), now=now), batch_id, now)
        counters = seen.get
    row = (*(counters[name] for name in INGEST_COUNTERS.fieldNames()[:-1]), utc_now().date())
    warehouse.append(warehouse.spark.createDataFrame([row], INGEST_COUNTERS).coalesce(1), "ingest_counters", batch_id)
    return counters


def start_ingest(
    records: DataFrame,
    allowlist: Sequence[Needle],
    warehouse: Warehouse,
    checkpoint: str,
    interval: str = BRONZE_TRIGGER,
    once: bool = False,
    match_strategy: str = "broadcast",
) -> StreamingQuery:
    """Route raw records and store the messages of all three topics.

    Matching happens in the micro-batch, where either strategy works; a list too long
    for ``broadcast`` asks for ``match_strategy="grams"``.
    """

    def write(batch: DataFrame, number: int) -> None:
        store_ingest(warehouse, batch, allowlist, stream_batch_id(batch, "ingest", number), match_strategy)

    return start(records, write, checkpoint, interval, "ingest", once)


def start_bronze(
    records: DataFrame,
    warehouse: Warehouse,
    checkpoint: str,
    gate: QualityGate | None = bronze_gate(),
    interval: str = BRONZE_TRIGGER,
    once: bool = False,
    now: Column | None = None,
    shred: bool = False,
) -> StreamingQuery:
    """Queue records to the raw table.

    With ``shred`` they are parsed here, once for all layers, and stored with their members
    as columns beside the text.
    """
    rows = to_bronze(records, now)
    table = SHREDDED_TABLE if shred else BRONZE_TABLE
    write = batch_writer(warehouse, table, gate, "bronze")
    return start(shredded(rows) if shred else rows, write, checkpoint, interval, "bronze", once)


def start_silver(
    warehouse: Warehouse,
    checkpoint: str,
    gate: QualityGate | None = silver_gate(),
    interval: str = SILVER_TRIGGER,
    once: bool = False,
    max_files: int | None = FILES_PER_TRIGGER,
    from_shredded: bool = False,
) -> StreamingQuery:
    """The raw table to the cleaned table; from the shredded one no text is parsed."""
    bronze = follow_bronze(warehouse.spark, warehouse.root, max_files=max_files, shredded=from_shredded)
    write = batch_writer(warehouse, SILVER_TABLE, gate, "silver")
    return start(bronze_to_silver(bronze), write, checkpoint, interval, "silver", once)


def start_gold(
    warehouse: Warehouse,
    checkpoint: str,
    gate: QualityGate | None = gold_gate(),
    interval: str = GOLD_TRIGGER,
    once: bool = False,
    max_files: int | None = FILES_PER_TRIGGER,
    families: Sequence[str] = ("entity", "user", "global"),
) -> list[StreamingQuery]:
    """The cleaned table to the metric tables: one query per family."""
    queries = []
    for name, table, build in GOLD_FAMILIES:
        if name not in families:
            continue
        silver = follow_silver(warehouse.spark, warehouse.root, max_files=max_files)
        write = batch_writer(warehouse, table, gate, f"gold_{name}")
        metrics = build(silver, watermark=None)
        queries.append(start(metrics, write, f"{checkpoint}/gold_{name}", interval, f"gold_{name}", once))
    return queries


#: The families of one pass: table, builder from states.
STATE_FAMILIES = (
    (GOLD_ENTITY_TABLE, states.page_metrics),
    (GOLD_USER_TABLE, states.user_metrics),
    (GOLD_GLOBAL_TABLE, states.site_metrics),
)


def start_metrics(
    warehouse: Warehouse,
    checkpoint: str,
    gate: QualityGate | None = gold_gate(),
    interval: str = GOLD_TRIGGER,
    once: bool = False,
    max_files: int | None = FILES_PER_TRIGGER,
    keep_late: bool = True,
) -> StreamingQuery:
    """The cleaned table to the states table and all three metric tables, in one query.

    The cleaned table is read, and its rows are shuffled, once instead of three times. A
    batch of closed windows is stored as states, which longer windows are built from, and
    as the tables of :func:`start_gold`. With ``keep_late`` the rows that come too late for
    their window are stored in ``silver_late``, from which they can be repaired or replayed.
    """
    place = f"{checkpoint}/metrics"

    def write(batch: DataFrame, number: int) -> None:
        batch_id = stream_batch_id(batch, "metrics", number)
        if keep_late:
            mark = late.late_watermark(batch.sparkSession, place, number)
            kept, closed, too_late = late.split(batch, mark, None)
        else:
            kept = closed = batch
            too_late = None
        kept.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if too_late is not None and not too_late.isEmpty():
                warehouse.append(too_late, LATE_TABLE, batch_id)
            if not closed.isEmpty():
                warehouse.append(closed, STATES_TABLE, batch_id)
                for table, build in STATE_FAMILIES:
                    write_batch(warehouse, table, build(closed), batch_id, gate)
        finally:
            kept.unpersist()

    silver = follow_silver(warehouse.spark, warehouse.root, max_files=max_files)
    stream = states.metric_states(silver, watermark=None)
    if keep_late:
        # Rows as they are stored: the filter for copies, too, drops what is late.
        every = follow_silver(warehouse.spark, warehouse.root, max_files=max_files, once_per_record=False)
        stream = late.beside(stream, every)
    return start(stream, write, place, interval, "metrics", once)


def await_all(spark: SparkSession, queries: Sequence[StreamingQuery], once: bool = False) -> None:
    """Wait for the queries and raise the error of one that failed.

    Long-running queries are watched together: the first to end ends the wait.
    """
    if once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    for query in queries:
        error = query.exception()
        if error is not None:
            raise error
