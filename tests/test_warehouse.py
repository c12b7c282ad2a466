import datetime as dt
import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from test_quality import NOW, silver_rows

from revwatch.operators.quality import gold_gate, silver_gate
from revwatch.plans import recovery, serving
from revwatch.schemas import GOLD_ENTITY_TABLE, SILVER, SILVER_TABLE, TABLES
from revwatch.sinks import layers
from revwatch.sinks.layers import write_batch
from revwatch.sinks.warehouse import SchemaDrift, Warehouse, utc_now
from revwatch.sources.queue import from_offsets, queue_options

DAY = NOW.date()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "lake"))


def ids(frame):
    return sorted(r.meta_id for r in frame.select("meta_id").collect())


def some(spark, *names, **fixed):
    return silver_rows(spark, *({"meta_id": n, **fixed} for n in names))


def test_missing_table_reads_as_empty(warehouse):
    assert warehouse.read(SILVER_TABLE).schema == SILVER
    assert warehouse.read(SILVER_TABLE).count() == 0
    with pytest.raises(ValueError):
        warehouse.read("nothing")


def test_retried_batch_leaves_one_copy(spark, warehouse):
    warehouse.append(some(spark, "a", "b"), SILVER_TABLE, "q_0")
    warehouse.append(some(spark, "a", "b"), SILVER_TABLE, "q_0")
    warehouse.append(some(spark, "c"), SILVER_TABLE, "q_1")
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "b", "c"]
    assert warehouse.is_committed(SILVER_TABLE, "q_1") and not warehouse.is_committed(SILVER_TABLE, "q_2")


def test_visible_batch_is_not_written_again(spark, warehouse):
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    files = spark.read.parquet(warehouse.path(SILVER_TABLE)).inputFiles()
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    assert spark.read.parquet(warehouse.path(SILVER_TABLE)).inputFiles() == files
    warehouse.rollback(SILVER_TABLE, utc_now() - dt.timedelta(days=1))
    assert ids(warehouse.read(SILVER_TABLE)) == []
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]


def test_small_batches_make_few_files(spark, warehouse):
    rows = some(spark, *"abcdefgh").repartition(8)
    warehouse.append(rows, SILVER_TABLE, "q_0", row_count=8)
    assert len(spark.read.parquet(warehouse.path(SILVER_TABLE)).inputFiles()) == 1


def test_uncommitted_batch_is_invisible(spark, warehouse):
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    warehouse._store(some(spark, "b"), SILVER_TABLE, "q_1")
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]
    assert ids(warehouse.read(SILVER_TABLE, committed=False)) == ["a", "b"]


def test_as_of_and_nested_rollbacks(spark, warehouse):
    moments = [utc_now()]
    for name in ("a", "b", "c"):
        warehouse.append(some(spark, name), SILVER_TABLE, f"q_{name}")
        moments.append(utc_now())
    for i, moment in enumerate(moments):
        assert ids(warehouse.read(SILVER_TABLE, as_of=moment)) == ["a", "b", "c"][:i]
    warehouse.rollback(SILVER_TABLE, moments[1])
    rolled = utc_now()
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]
    warehouse.append(some(spark, "d"), SILVER_TABLE, "q_d")
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "d"]
    # The past stays readable, and a rollback can itself be rolled back.
    assert ids(warehouse.read(SILVER_TABLE, as_of=moments[3])) == ["a", "b", "c"]
    warehouse.rollback(SILVER_TABLE, moments[2])
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "b"]
    warehouse.rollback(SILVER_TABLE, rolled)
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]


def test_replacement_hides_only_later_dates(spark, warehouse):
    early, late = DAY - dt.timedelta(days=1), DAY
    both = some(spark, "a", event_date=early).unionByName(some(spark, "b", event_date=late))
    warehouse.append(both, SILVER_TABLE, "q_0")
    before = utc_now()
    warehouse.replace_from(some(spark, "x", event_date=early).unionByName(some(spark, "y", event_date=late)),
                           SILVER_TABLE, "r_0", late)
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "y"]
    warehouse.append(some(spark, "z", event_date=late), SILVER_TABLE, "q_1")
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "y", "z"]
    assert ids(warehouse.read(SILVER_TABLE, as_of=before)) == ["a", "b"]
    warehouse.rollback(SILVER_TABLE, before)
    assert ids(warehouse.read(SILVER_TABLE)) == ["a", "b"]


def test_schema_drift_is_refused(spark, warehouse):
    with pytest.raises(SchemaDrift):
        warehouse.append(some(spark, "a").drop("wiki"), SILVER_TABLE, "q_0")
    old = spark.createDataFrame([("r", DAY, "b")], "quarantine_reason string, event_date date, batch_id string")
    old.write.partitionBy("event_date", "batch_id").parquet(warehouse.path("silver_quarantine"))
    with pytest.raises(SchemaDrift):
        warehouse.create_tables()
    assert spark.read.parquet(warehouse.path("silver_quarantine")).count() == 1


def test_tables_views_and_catalog(spark, warehouse):
    warehouse.create_tables()
    warehouse.create_tables()
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    warehouse.create_views()
    try:
        assert spark.sql(f"SELECT meta_id FROM {SILVER_TABLE} WHERE event_date = DATE '{DAY}'").count() == 1
        assert spark.sql("SELECT * FROM silver_quarantine").count() == 0
    finally:
        for table in TABLES:
            spark.catalog.dropTempView(table)
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_test")
    try:
        for _ in range(2):
            warehouse.register(SILVER_TABLE, "lake_test")
        assert spark.table(f"lake_test.{SILVER_TABLE}").count() == 1
    finally:
        spark.sql("DROP DATABASE lake_test CASCADE")


def test_write_batch_splits_records_and_alerts(spark, warehouse):
    rows = some(spark, *"abcdefghi").unionByName(some(spark, "bad", title=None))
    metrics = write_batch(warehouse, SILVER_TABLE, rows, "silver_0", silver_gate())
    assert (metrics["passed_count"], metrics["failed_count"]) == (9, 1)
    write_batch(warehouse, SILVER_TABLE, rows, "silver_0", silver_gate())
    assert warehouse.read(SILVER_TABLE).count() == 9
    quarantined = warehouse.read("silver_quarantine")
    assert quarantined.count() == 1 and quarantined.first().quarantine_batch_id == "silver_0"
    recorded = warehouse.read("quality_metrics").collect()
    assert [(r.layer, r.total_count, r.pass_rate) for r in recorded] == [("silver", 10, 0.9)]
    assert json.loads(recorded[0].failed_checks) == metrics["failed_checks"]
    assert [(r.severity, r.channels) for r in warehouse.read("alerts").collect()] == [("CRITICAL", ["sns", "slack"])]


def test_all_good_all_bad_and_empty(spark, warehouse):
    write_batch(warehouse, SILVER_TABLE, some(spark, "a"), "s_0", silver_gate())
    write_batch(warehouse, SILVER_TABLE, some(spark, "b", title=None), "s_1", silver_gate())
    assert write_batch(warehouse, SILVER_TABLE, some(spark), "s_2", silver_gate()) is None
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]
    assert warehouse.read("silver_quarantine").count() == 1
    assert warehouse.read("quality_metrics").count() == 2
    assert warehouse.read("alerts").count() == 1


def test_no_gate_writes_everything(spark, warehouse):
    assert write_batch(warehouse, SILVER_TABLE, some(spark, "a", title=None), "s_0", None) is None
    assert ids(warehouse.read(SILVER_TABLE)) == ["a"]


def test_quarantine_fallback(spark, warehouse, monkeypatch):
    append = Warehouse.append

    def broken(self, df, table, *args, **kwargs):
        if table.endswith("_quarantine"):
            raise AnalysisException("no such table")
        return append(self, df, table, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "append", broken)
    write_batch(warehouse, SILVER_TABLE, some(spark, "a", title=None), "s_0", silver_gate())
    kept = spark.read.parquet(f"{warehouse.path(layers.FALLBACK)}/silver")
    assert kept.count() == 1 and kept.first().quarantine_reason == "missing:title"


def test_a_failed_write_fails_the_batch(spark, warehouse, monkeypatch):
    monkeypatch.setattr(Warehouse, "_store", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        write_batch(warehouse, SILVER_TABLE, some(spark, "a"), "s_0", silver_gate())


def test_gold_quarantine_is_stored(spark, warehouse):
    from revwatch.operators.gold import entity_metrics

    rows = some(spark, "a", title=None).withColumn("canonical_entity", F.lit(None).cast("string"))
    metrics = write_batch(warehouse, GOLD_ENTITY_TABLE, entity_metrics(rows), "gold_entity_0", gold_gate())
    assert metrics["failed_count"] == 1
    assert warehouse.read("gold_quarantine").first().quarantine_reason == "missing:entity"


def test_replay_silver_and_gold(spark, warehouse):
    from test_silver import bronze, record

    from revwatch.operators.gold import entity_metrics

    texts = [record(meta={"id": f"m{i}"}, title=f"T{i % 2}", length={"new": 5}) for i in range(6)] + ["broken"]
    warehouse.append(bronze(spark, *texts), "bronze_events", "b_0")
    warehouse.append(some(spark, "stale"), SILVER_TABLE, "old_0")
    metrics = recovery.replay_silver(warehouse, DAY)
    assert (metrics["passed_count"], metrics["failed_count"]) == (6, 1)
    assert ids(warehouse.read(SILVER_TABLE)) == [f"m{i}" for i in range(6)]
    recovery.replay_gold(warehouse, DAY)
    got = warehouse.read(GOLD_ENTITY_TABLE).drop("aggregation_timestamp")
    want = entity_metrics(warehouse.read(SILVER_TABLE)).drop("aggregation_timestamp")
    assert sorted(got.collect()) == sorted(want.collect())
    for table in ("gold_user_metrics_10min", "gold_global_metrics_10min"):
        assert warehouse.read(table).count() == 1
    recovery.replay_gold(warehouse, DAY)
    assert warehouse.read(GOLD_ENTITY_TABLE).count() == want.count()
    # From a queue position: Silver holds the later rows already, all but the broken one.
    more = recovery.replay_silver(warehouse, DAY, offsets={"edits": {"0": 4}})
    assert (more["total_count"], more["passed_count"]) == (1, 0)
    assert ids(warehouse.read(SILVER_TABLE)) == [f"m{i}" for i in range(6)]


def test_bulk_runs_leave_no_copies(spark, warehouse):
    from pathlib import Path

    from test_silver import bronze, record

    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "revwatch"
    before = set(folder.glob("*")) if folder.exists() else set()
    recovery.backfill_bronze(warehouse, bronze(spark, record(meta={"id": "m"}, title="T", length={"new": 5})))
    recovery.replay_silver(warehouse, DAY)
    recovery.reprocess_quarantine(warehouse, warehouse.read("silver_quarantine"))
    assert warehouse.read("bronze_events").count() == 1
    assert set(folder.glob("*")) == before


def test_replay_by_offsets_adds_what_is_missing(spark, warehouse):
    from test_silver import bronze, record

    texts = [record(meta={"id": f"m{i}"}, title="T", length={"new": 5}) for i in range(6)]
    warehouse.append(bronze(spark, *texts), "bronze_events", "b_0")
    recovery.replay_silver(warehouse, DAY)
    lost = warehouse.read(SILVER_TABLE).filter("meta_id <> 'm5'").cache()
    warehouse.replace_from(lost, SILVER_TABLE, "replay_lost", DAY)
    for _ in range(2):
        recovery.replay_silver(warehouse, DAY, offsets={"edits": {"0": 0}})
        assert ids(warehouse.read(SILVER_TABLE)) == [f"m{i}" for i in range(6)]


def test_replay_from_a_date_knows_ids_of_the_hour_before(spark, warehouse):
    from test_silver import bronze, record

    late = dt.datetime.combine(DAY, dt.time(0, 1))
    early = late - dt.timedelta(minutes=2)
    text = record(meta={"id": "twice"}, title="T", length={"new": 5})

    def at(moment, batch, *texts):
        rows = bronze(spark, *texts).withColumn("ingestion_timestamp", F.lit(moment))
        warehouse.append(rows.withColumn("event_date", F.lit(moment.date())), "bronze_events", batch)

    at(early, "b_0", text)
    at(late, "b_1", text, record(meta={"id": "once"}, title="T", length={"new": 5}))
    recovery.replay_silver(warehouse, DAY)
    assert "twice" not in ids(warehouse.read(SILVER_TABLE))


def test_replay_gold_leaves_open_windows_to_the_stream(spark, warehouse):
    from revwatch.operators.gold import entity_metrics

    rows = some(spark, "a", ingestion_timestamp=NOW).unionByName(
        some(spark, "b", ingestion_timestamp=NOW + dt.timedelta(minutes=10))
    )
    warehouse.append(rows, SILVER_TABLE, "s_0")
    closed = entity_metrics(warehouse.read(SILVER_TABLE)).orderBy("window_end").limit(1)
    warehouse.append(closed, GOLD_ENTITY_TABLE, "g_0")
    last = closed.first().window_end
    recovery.replay_gold(warehouse, DAY, families=("entity",))
    assert [r.window_end for r in warehouse.read(GOLD_ENTITY_TABLE).collect()] == [last]
    with pytest.raises(ValueError):
        recovery.replay_gold(warehouse, DAY, families=("entity",), window="7 hours")


def test_streams_skip_replays(spark, warehouse, tmp_path):
    from revwatch.sources.layers import follow_silver

    warehouse.append(some(spark, "a", kafka_offset=1), SILVER_TABLE, "silver_q_0")
    warehouse.append(some(spark, "again", kafka_offset=2), SILVER_TABLE, "replay_1")
    warehouse.append(some(spark, "repaired", kafka_offset=3), SILVER_TABLE, "reprocess_1")
    seen = []
    query = follow_silver(spark, warehouse.root).writeStream.foreachBatch(
        lambda batch, _: seen.extend(r.meta_id for r in batch.collect())
    )
    query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == ["a", "repaired"]


def test_a_broken_table_is_not_empty(spark, warehouse, tmp_path):
    folder = tmp_path / "lake" / SILVER_TABLE / "event_date=2026-01-27" / "batch_id=x"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        warehouse.read(SILVER_TABLE, committed=False).collect()


def test_catalog_entry_follows_new_batches(spark, warehouse):
    warehouse.append(some(spark, "a"), SILVER_TABLE, "q_0")
    spark.sql("CREATE DATABASE IF NOT EXISTS lake_more")
    try:
        warehouse.register(SILVER_TABLE, "lake_more")
        warehouse.append(some(spark, "b"), SILVER_TABLE, "q_1")
        warehouse.register(SILVER_TABLE, "lake_more")
        assert spark.table(f"lake_more.{SILVER_TABLE}").count() == 2
    finally:
        spark.sql("DROP DATABASE lake_more CASCADE")


def test_reprocess_quarantine(spark, warehouse):
    late = some(spark, "late", processing_lag_seconds=3700,
                event_timestamp=int(NOW.replace(tzinfo=dt.timezone.utc).timestamp()) - 3700)
    write_batch(warehouse, SILVER_TABLE, late.unionByName(some(spark, "bad", title=None)), "s_0", silver_gate())
    chosen = serving.quarantine_selection(warehouse.read("silver_quarantine"), F.lit(DAY), "%freshness%")
    metrics = recovery.reprocess_quarantine(warehouse, chosen, gate=silver_gate(max_lag_seconds=7200))
    assert (metrics["passed_count"], metrics["failed_count"]) == (1, 0)
    assert ids(warehouse.read(SILVER_TABLE)) == ["late"]
    # The same selection again, and a wider one that holds it, add nothing.
    recovery.reprocess_quarantine(warehouse, chosen, gate=silver_gate(max_lag_seconds=7200))
    every = warehouse.read("silver_quarantine")
    recovery.reprocess_quarantine(warehouse, every, gate=silver_gate(max_lag_seconds=7200))
    assert ids(warehouse.read(SILVER_TABLE)) == ["late"]


def test_offsets(spark):
    rows = spark.createDataFrame([("t", 0, 9), ("t", 0, 10), ("t", 1, 0), ("u", 0, 50)],
                                 "kafka_topic string, kafka_partition int, kafka_offset bigint")
    assert rows.filter(from_offsets({"t": {"0": 10}})).count() == 2
    assert rows.filter(from_offsets('{"t": {"0": -2}, "u": {}}')).count() == 4
    with pytest.raises(ValueError):
        from_offsets({"t": {"0": -1}})


def test_queue_options():
    options = queue_options("h:9094", "cleaned_events", {"cleaned_events": {"0": 1000}})
    assert options["subscribe"] == "cleaned_events" and options["failOnDataLoss"] == "false"
    assert json.loads(options["startingOffsets"]) == {"cleaned_events": {"0": 1000}}
    assert queue_options("h", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        queue_options("h", "t", "yesterday")
