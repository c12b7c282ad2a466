import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_silver import record

from revwatch.catalogue import records
from revwatch.operators.gold import entity_metrics, global_metrics, user_metrics
from revwatch.operators.quality import bronze_gate, silver_gate
from revwatch.operators.silver import bronze_to_silver, drop_replays
from revwatch.schemas import (
    BRONZE_TABLE,
    GOLD_ENTITY_TABLE,
    GOLD_GLOBAL_TABLE,
    GOLD_USER_TABLE,
    KAFKA,
    PROGRESS,
    SILVER_TABLE,
)
from revwatch.sinks.landing import land_stream
from revwatch.sinks.warehouse import Warehouse, utc_now
from revwatch.sources.allowlist import default_allowlist
from revwatch.sources.layers import follow_bronze, follow_silver
from revwatch.streaming.pipeline import (
    await_all,
    start,
    start_bronze,
    start_gold,
    start_ingest,
    start_silver,
)
from revwatch.streaming.progress import ProgressLog

START = dt.datetime(2026, 1, 27, 14, 0)


def epoch(moment):
    return int(moment.replace(tzinfo=dt.timezone.utc).timestamp())


def message(offset, minute, **changes):
    moment = START + dt.timedelta(minutes=minute)
    changes.setdefault("meta", {"id": f"m{offset}"})
    text = record(timestamp=epoch(moment) - 5, **changes)
    return (bytearray(b"enwiki:A"), bytearray(text.encode()), "edits", 0, offset, moment, 0)


def put(spark, folder, rows):
    """One more file of queue records for a file stream."""
    spark.createDataFrame(rows, KAFKA).coalesce(1).write.mode("append").parquet(folder)


def queue(spark, folder):
    return spark.readStream.schema(KAFKA).option("maxFilesPerTrigger", 1).parquet(folder)


@pytest.fixture
def lake(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    warehouse.create_tables()
    return warehouse


def bronze_run(spark, lake, folder, tmp_path, name="bronze"):
    query = start_bronze(queue(spark, folder), lake, f"{tmp_path}/cp/{name}", once=True, now=F.col("timestamp"))
    query.awaitTermination()


def silver_run(lake, tmp_path):
    start_silver(lake, f"{tmp_path}/cp/silver", once=True, max_files=1).awaitTermination()


def test_stream_equals_batch_through_all_layers(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    # Arrival times grow from file to file; the last record closes all windows.
    put(spark, folder, [message(i, i, title=f"T{i % 3}", length={"new": 900 * i}) for i in range(12)])
    put(spark, folder, [message(i, i, user=f"10.0.0.{i % 2}", title="T1") for i in range(12, 24)])
    bad = (bytearray(b"k"), bytearray(b"{broken"), "edits", 0, 900, START + dt.timedelta(minutes=25), 0)
    replayed = message(901, 26, meta={"id": "m23"})
    keyless = (None, bytearray(record().encode()), "edits", 0, 902, START + dt.timedelta(minutes=27), 0)
    put(spark, folder, [message(24, 25), bad, replayed, keyless])
    put(spark, folder, [message(25, 600, title="closing")])

    bronze_run(spark, lake, folder, tmp_path)
    bronze = lake.read(BRONZE_TABLE)
    assert (bronze.count(), lake.read("bronze_quarantine").count()) == (28, 1)
    silver_run(lake, tmp_path)
    silver = lake.read(SILVER_TABLE)
    columns = [c for c in silver.columns if c != "event_data"]
    want = silver_gate().run(bronze_to_silver(bronze), "b", keep=False).passed
    assert sorted(silver.select(columns).collect(), key=repr) == sorted(want.select(columns).collect(), key=repr)
    # In = passed + quarantined + replays.
    assert silver.count() == 26
    failed = lake.read("silver_quarantine").collect()
    assert len(failed) == 1 and "unparseable" in failed[0].quarantine_reason

    queries = start_gold(lake, f"{tmp_path}/cp", once=True, max_files=1)
    await_all(spark, queries, once=True)
    closed = F.col("window_end") <= F.lit(START + dt.timedelta(minutes=590))
    for table, build in (
        (GOLD_ENTITY_TABLE, entity_metrics),
        (GOLD_USER_TABLE, user_metrics),
        (GOLD_GLOBAL_TABLE, global_metrics),
    ):
        got = lake.read(table).drop("aggregation_timestamp")
        batch = build(silver).filter(closed).drop("aggregation_timestamp")
        assert got.count() > 0
        assert sorted(got.collect(), key=repr) == sorted(batch.collect(), key=repr), table
    assert {r.layer for r in lake.read("quality_metrics").collect()} == {"bronze", "silver", "gold"}


def test_restart_continues_and_new_checkpoint_does_not_overwrite(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(1, 0)])
    bronze_run(spark, lake, folder, tmp_path)
    put(spark, folder, [message(2, 1)])
    bronze_run(spark, lake, folder, tmp_path)
    assert lake.read(BRONZE_TABLE).count() == 2
    bronze_run(spark, lake, folder, tmp_path, name="other")
    assert lake.read(BRONZE_TABLE).count() == 4


def test_failed_batch_is_run_again_without_copies(spark, lake, tmp_path, monkeypatch):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(i, i) for i in range(5)])
    commit = Warehouse._commit
    calls = []

    def fails_once(self, *args, **kwargs):
        calls.append(args)
        if len(calls) == 1:
            raise RuntimeError("driver lost before the commit")
        return commit(self, *args, **kwargs)

    monkeypatch.setattr(Warehouse, "_commit", fails_once)
    with pytest.raises(Exception, match="driver lost"):
        bronze_run(spark, lake, folder, tmp_path)
    assert lake.read(BRONZE_TABLE).count() == 0
    bronze_run(spark, lake, folder, tmp_path)
    assert lake.read(BRONZE_TABLE).count() == 5
    assert lake.read(BRONZE_TABLE, committed=False).count() == 5


def test_gold_counts_a_rewritten_batch_once(spark, lake, tmp_path):
    from test_quality import silver_rows

    rows = silver_rows(spark, *({"meta_id": f"m{i}", "kafka_offset": i, "ingestion_timestamp": START} for i in range(4)))
    lake.append(rows, SILVER_TABLE, "silver_0")
    checkpoint = f"{tmp_path}/cp"
    await_all(spark, start_gold(lake, checkpoint, once=True, families=["global"]), once=True)
    # The files of a batch written once more are new to the stream.
    lake._store(rows, SILVER_TABLE, "silver_0")
    closing = silver_rows(spark, {"meta_id": "end", "kafka_offset": 99, "ingestion_timestamp": START + dt.timedelta(hours=5)})
    lake.append(closing, SILVER_TABLE, "silver_1")
    await_all(spark, start_gold(lake, checkpoint, once=True, families=["global"]), once=True)
    assert [r.total_events for r in lake.read(GOLD_GLOBAL_TABLE).collect()] == [4]


def _silver_files(spark, folder, *batches):
    from test_quality import silver_rows

    for batch in batches:
        rows = silver_rows(spark, *({"meta_id": m, "kafka_offset": i, "ingestion_timestamp": START + dt.timedelta(minutes=minute)} for i, (m, minute) in enumerate(batch)))
        rows.coalesce(1).write.mode("append").parquet(folder)
    schema = rows.schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def _collected(stream, checkpoint):
    seen = []

    def write(batch, number):
        seen.extend(batch.collect())

    start(stream, write, checkpoint, "0 seconds", "collected", once=True).awaitTermination()
    return seen


def test_replay_inside_and_outside_the_window(spark, tmp_path):
    stream = _silver_files(
        spark, f"{tmp_path}/in", [("a", 0)], [("a", 30), ("b", 30)], [("c", 200)], [("d", 201)], [("a", 210)]
    )
    kept = [r.meta_id for r in _collected(drop_replays(stream, within="1 hour"), f"{tmp_path}/cp")]
    # The copy after 30 minutes is dropped; after 210 minutes the id is forgotten.
    assert sorted(kept) == ["a", "a", "b", "c", "d"]


def test_late_row_is_dropped(spark, tmp_path):
    stream = _silver_files(spark, f"{tmp_path}/in", [("a", 0)], [("b", 60)], [("c", 61)], [("late", 5)], [("end", 300)])
    got = _collected(global_metrics(stream), f"{tmp_path}/cp")
    assert {r.window_start.minute + 60 * (r.window_start.hour - 14): r.total_events for r in got} == {0: 1, 60: 2}


def test_ingest_stream_writes_three_topics(spark, lake, tmp_path):
    folder = f"{tmp_path}/texts"
    texts = ["{\"title\": \"India\", \"wiki\": \"enwiki\"}", "{}", "{\"title\": \"zz\", \"wiki\": \"enwiki\"}", "broken"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(folder)
    records = spark.readStream.text(folder)
    start_ingest(records, default_allowlist(), lake, f"{tmp_path}/cp", once=True).awaitTermination()
    topics = spark.read.parquet(lake.path("topics"))
    counts = {r.topic: r["count"] for r in topics.groupBy("topic").count().collect()}
    assert counts == {"raw_events": 1, "cleaned_events": 1, "dlq_events": 1}
    cleaned = json.loads(topics.filter("topic = 'cleaned_events'").first().value)
    assert cleaned["_metadata"]["canonical_entity"] == "enwiki:India"


def test_landing(spark, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(i, 0) for i in range(250)] + [message(250, 9 * 60 + 30)])
    land_stream(queue(spark, folder), f"{tmp_path}/landed", f"{tmp_path}/cp", once=True).awaitTermination()
    landed = spark.read.option("basePath", f"{tmp_path}/landed").text(f"{tmp_path}/landed/year=*/month=*/day=*/hour=*")
    hours = {(r.year, r.month, r.day, r.hour): r["count"] for r in landed.groupBy("year", "month", "day", "hour").count().collect()}
    # 14:00 and 23:30 UTC in January are 15:00 and 00:30 of the next day in Berlin.
    assert hours == {(2026, 1, 27, 15): 250, (2026, 1, 28, 0): 1}
    files = list((tmp_path / "landed" / "year=2026" / "month=01" / "day=27" / "hour=15").glob("*.txt"))
    assert len(files) == 3
    assert json.loads(landed.first().value)["title"] == "A page"


def test_progress_log(spark, lake, tmp_path):
    log = ProgressLog(spark, lake.path("progress"))
    spark.streams.addListener(log)
    try:
        folder = f"{tmp_path}/queue"
        put(spark, folder, [message(i, i) for i in range(3)])
        bronze_run(spark, lake, folder, tmp_path)
        deadline = dt.datetime.now() + dt.timedelta(seconds=30)
        rows = []
        while not rows and dt.datetime.now() < deadline:
            log.flush()
            if lake.exists("progress"):
                rows = spark.read.schema(PROGRESS).parquet(lake.path("progress")).filter("query_name = 'bronze'").collect()
    finally:
        spark.streams.removeListener(log)
    assert sum(r.num_input_rows for r in rows) == 3


def test_query_errors_surface(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(1, 0)])

    def broken(batch, number):
        raise ValueError("cannot write")

    query = start(queue(spark, folder), broken, f"{tmp_path}/cp", "0 seconds", "broken", once=True)
    with pytest.raises(Exception, match="cannot write"):
        await_all(spark, [query], once=True)


def test_follow_silver_without_record_filter(spark, lake):
    assert follow_silver(spark, lake.root, once_per_record=False).isStreaming


def test_no_gate_and_custom_gate(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [(None, bytearray(b"{}"), "edits", 0, 1, START, 0)])
    start_bronze(queue(spark, folder), lake, f"{tmp_path}/a", gate=None, once=True, now=F.col("timestamp")).awaitTermination()
    start_bronze(queue(spark, folder), lake, f"{tmp_path}/b", gate=bronze_gate(suite=False), once=True, now=F.col("timestamp")).awaitTermination()
    assert (lake.read(BRONZE_TABLE).count(), lake.read("bronze_quarantine").count()) == (1, 1)


def test_streams_pass_over_batches_that_were_rolled_back(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(1, 0)])
    bronze_run(spark, lake, folder, tmp_path)
    assert lake.hidden_batches(BRONZE_TABLE) is None
    moment = utc_now()
    put(spark, folder, [message(2, 1), message(3, 2)])
    bronze_run(spark, lake, folder, tmp_path)
    lake.rollback(BRONZE_TABLE, moment)
    put(spark, folder, [message(4, 3)])
    bronze_run(spark, lake, folder, tmp_path)
    assert lake.hidden_batches(BRONZE_TABLE).count() == 1
    silver_run(lake, tmp_path)
    assert {row.meta_id for row in lake.read(SILVER_TABLE).collect()} == {"m1", "m4"}

    # A later rollback hides what came after its own moment, whatever was hidden before.
    lake.rollback(BRONZE_TABLE, utc_now() - dt.timedelta(days=1))
    assert lake.hidden_batches(BRONZE_TABLE).count() == 3
    lake.rollback(BRONZE_TABLE, moment + dt.timedelta(microseconds=1))
    assert lake.hidden_batches(BRONZE_TABLE).count() == 2
    rows = follow_bronze(spark, lake.root)
    seen = []
    start(rows, lambda batch, _: seen.extend(r.kafka_offset for r in batch.collect()), f"{tmp_path}/cp/again", "0 seconds", "again", once=True).awaitTermination()
    assert seen == [1]


def test_a_small_stateful_batch_is_one_file(spark, lake, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(i, i) for i in range(40)])
    put(spark, folder, [message(i, i) for i in range(40, 80)])
    bronze_run(spark, lake, folder, tmp_path)
    silver_run(lake, tmp_path)
    # Files that streams take up one by one must not be parts of a batch: their rows would come too late.
    stored = spark.read.parquet(lake.path(SILVER_TABLE)).select("batch_id", "_metadata.file_path")
    stored = stored.groupBy("batch_id").agg(F.count("*").alias("rows"), F.countDistinct("file_path").alias("files"))
    assert [(row.rows, row.files) for row in stored.collect()] == [(40, 1), (40, 1)]


@pytest.mark.parametrize("rows_per_file, few", [(20, False), (1, True)])
def test_followed_events_come_share_by_share(spark, tmp_path, monkeypatch, rows_per_file, few):
    """Whatever the number of files, a trigger takes one share of time, and all of it."""
    monkeypatch.setattr(records, "ROWS_PER_FILE", rows_per_file)
    first = dt.datetime(2024, 1, 1)
    rows = [(i, first + dt.timedelta(minutes=0 if few and i < 8 else 10 * i), i % 5, "view", 1.0, "{}") for i in range(9 if few else 600)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    batches = []
    taken = records.edit_records(records.follow_events(spark, str(tmp_path))).select("rid", F.unix_timestamp("ingestion_timestamp").alias("at"))
    start(taken, lambda batch, number: batches.append(batch.collect()), f"{tmp_path}/cp", "0 seconds", "shares", once=True).awaitTermination()
    assert len(batches) == 4
    assert sorted(r.rid for b in batches[:3] for r in b) == list(range(len(rows)))
    assert sorted(batches[3]) == sorted(batches[0])
    for earlier, later in zip(batches[:3], batches[1:3]):
        assert not earlier or not later or max(r.at for r in earlier) < min(r.at for r in later)
