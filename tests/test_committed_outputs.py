"""Three topics under one commit, counters observed by the write, combined constraint states."""

import json
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_quality import silver_rows

from revwatch.operators import quality
from revwatch.operators.ingest import CLEANED_TOPIC, DLQ_TOPIC, RAW_TOPIC, observed_routes, route_counters, route_events
from revwatch.schemas import SILVER_TABLE, TOPICS_TABLE
from revwatch.sinks.landing import read_topic
from revwatch.sinks.layers import write_batch
from revwatch.sinks.warehouse import Warehouse
from revwatch.sources.allowlist import default_allowlist
from revwatch.streaming.pipeline import store_ingest
from revwatch.streaming.progress import ProgressLog

TOPICS = (RAW_TOPIC, CLEANED_TOPIC, DLQ_TOPIC)
TEXTS = [
    '{"title": "India", "wiki": "enwiki"}',
    '{"title": "India", "wiki": "enwiki", "id": 2}',
    "{}",
    '{"title": "zz", "wiki": "enwiki"}',
    "broken",
    "",
    "[1]",
]


@pytest.fixture
def lake(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    warehouse.create_tables()
    return warehouse


@pytest.fixture
def texts(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "value string").repartition(3)


def counts(lake):
    return {topic: read_topic(lake, topic).count() for topic in TOPICS}


def test_failed_commit_shows_no_topic_and_a_second_attempt_all(lake, texts, monkeypatch):
    commit = Warehouse._commit

    def fails(self, table, *args, **kwargs):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(Warehouse, "_commit", fails)
    with pytest.raises(RuntimeError, match="lost"):
        store_ingest(lake, texts, default_allowlist(), "b_0")
    assert counts(lake) == dict.fromkeys(TOPICS, 0)
    monkeypatch.setattr(Warehouse, "_commit", commit)
    first = store_ingest(lake, texts, default_allowlist(), "b_0")
    again = store_ingest(lake, texts, default_allowlist(), "b_0")  # changes nothing
    assert first == again
    assert counts(lake) == {RAW_TOPIC: 2, CLEANED_TOPIC: 2, DLQ_TOPIC: 2}
    assert lake.commits(TOPICS_TABLE).count() == 1 and lake.read("ingest_counters").count() == 1
    with pytest.raises(ValueError, match="unknown topic"):
        read_topic(lake, "other")


def test_a_topic_is_read_alone(lake, texts):
    store_ingest(lake, texts, default_allowlist(), "b_0")
    scan = read_topic(lake, DLQ_TOPIC)._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in scan.split("PartitionFilters: ")[1:]]
    assert any(DLQ_TOPIC in part and "topic" in part for part in filters)


def test_counters_come_with_the_write(spark, lake, texts):
    """The same figures as the aggregation, in no job of their own."""
    routed = route_events(texts, default_allowlist())
    expected = route_counters(routed).first().asDict()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plain", "")
    observed_free = routed.select("route")
    observed_free.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobGroup("observed", "")
    seen = Observation()
    observed_routes(routed, seen).select("route").write.format("noop").mode("overwrite").save()
    assert seen.get == expected
    jobs = {group: len(tracker.getJobIdsForGroup(group)) for group in ("plain", "observed")}
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs["plain"] == jobs["observed"]
    assert store_ingest(lake, texts, default_allowlist(), "b_1") == expected


def test_streams_report_observed_counters(spark, tmp_path, texts):
    log = ProgressLog(spark, f"{tmp_path}/progress")
    spark.streams.addListener(log)
    try:
        texts.write.text(f"{tmp_path}/in")
        routed = observed_routes(route_events(spark.readStream.text(f"{tmp_path}/in"), default_allowlist()), "ingest")
        query = (
            routed.select("route")
            .writeStream.format("parquet")
            .queryName("watched")
            .option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/cp")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        rows, deadline = [], time.time() + 30
        while not rows and time.time() < deadline:
            log.flush()
            time.sleep(0.5)
            try:
                rows = spark.read.parquet(f"{tmp_path}/progress").where("observed IS NOT NULL").collect()
            except Exception:  # nothing flushed yet
                rows = []
    finally:
        spark.streams.removeListener(log)
    expected = route_counters(route_events(texts, default_allowlist())).first().asDict()
    figures = [json.loads(r.observed)["ingest"] for r in rows]
    assert any(f == expected for f in figures)


# Constraint states. ---------------------------------------------------------------------


def batches(spark):
    rows = [
        {"meta_id": f"m{i}", "kafka_offset": i, "title": None if i == 5 else f"T{i}", "event_type": "odd" if i % 4 == 0 else "edit"}
        for i in range(12)
    ]
    whole = silver_rows(spark, *rows)
    return whole, [whole.where(F.col("kafka_offset") % 3 == k) for k in range(3)]


def verdicts(df):
    return {r.constraint: (r.constraint_status, r.rows, r.rows_passing) for r in df.collect()}


def test_combined_verdict_equals_the_suite_over_all_rows(spark):
    whole, parts = batches(spark)
    constraints = quality.silver_constraints()
    states = parts[0].sparkSession.createDataFrame([], quality.constraint_states(whole, constraints).schema)
    for part in parts:
        states = states.unionAll(quality.constraint_states(part, constraints))
    assert verdicts(quality.combined_verdict(states, constraints)) == verdicts(quality.run_suite(whole, constraints))
    # A batch that is sound does not make up for one that is not.
    statuses = {v[0] for v in verdicts(quality.combined_verdict(states, constraints)).values()}
    assert statuses == {quality.SUCCESS, quality.FAILURE}
    assert quality.combined_verdict(states.limit(0), constraints).count() == 0


def test_gate_stores_states_that_give_its_own_verdict(spark, lake):
    whole, parts = batches(spark)
    gate = quality.silver_gate()
    for at, part in enumerate(parts):
        write_batch(lake, SILVER_TABLE, part, f"s_{at}", gate)
    states = lake.read("constraint_states").where("layer = 'silver'")
    one = quality.combined_quality(states, quality.silver_constraints()).first()
    result = gate.run(whole, "all")
    metrics = result.metrics
    assert (one.total_count, one.passed_count, one.pass_rate) == (12, metrics["passed_count"], metrics["pass_rate"])
    assert one.failed_checks == sorted(metrics["failed_checks"]) and one.severity == result.severity
    result.release()
    # Counting a batch once more changes nothing: its states are one more time the same batch.
    write_batch(lake, SILVER_TABLE, parts[0], "s_0", gate)
    assert quality.combined_quality(lake.read("constraint_states"), quality.silver_constraints()).first().total_count == 12
