"""Serving queries, files, profiles, and the shape of physical plans."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_quality import NOW, silver_rows

import __spark_entry__ as entry
from revwatch.__main__ import main
from revwatch.operators import gold, profile
from revwatch.operators.matching import match_entity
from revwatch.plans import serving
from revwatch.schemas import BRONZE, GOLD_GLOBAL_TABLE, SILVER_TABLE
from revwatch.sinks.warehouse import Warehouse
from revwatch.sources.allowlist import default_allowlist
from revwatch.sources.files import read_backfill, sample_records, save_sample

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lake(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "lake"))


def test_metrics_do_not_read_the_event_text(spark, lake):
    lake.append(silver_rows(spark, {}), SILVER_TABLE, "s_0")
    for build in (gold.entity_metrics, gold.user_metrics, gold.global_metrics):
        text = plan(build(lake.read(SILVER_TABLE)))
        scans = [line for line in text.splitlines() if "ReadSchema" in line and "user_name" in line]
        assert scans and all("event_data" not in line for line in scans)


def test_metrics_use_one_shuffle_with_partial_aggregation(spark):
    # Keys that hold a third of all rows cross the shuffle once per map task.
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    from revwatch.catalogue.records import edit_records
    from revwatch.operators.silver import derive

    text = plan(gold.entity_metrics(derive(edit_records(rows))))
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_match_is_a_broadcast_join_without_shuffle(spark):
    frame = spark.range(10).select(F.format_string("w%d", "id").alias("wiki"), F.format_string("T%d", "id").alias("title"))
    text = plan(match_entity(frame, default_allowlist()))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_long_list_plan_has_no_cross_join(spark):
    frame = spark.range(10).select(F.format_string("w%d", "id").alias("wiki"), F.format_string("T%d", "id").alias("title"))
    text = plan(match_entity(frame, default_allowlist(), strategy="grams"))
    assert "Cartesian" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.LLM_QUERIES)))
def test_no_query_plans_a_cross_join(spark, name):
    if name.startswith("stream_") or name in ("as_of_read", "replay_from_date"):
        pytest.skip("runs when built; covered by the oracle test")
    text = plan(entry.queries()[name](spark, SF_DIR))
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_dashboards_prune_partitions_and_use_top_k(spark, lake):
    old = NOW - dt.timedelta(days=9)
    rows = silver_rows(spark, {}, {"meta_id": "m2", "ingestion_timestamp": old, "event_date": old.date()})
    lake.append(gold.entity_metrics(rows), "gold_entity_metrics_10min", "g_0")
    stored = lake.read("gold_entity_metrics_10min", committed=False)
    top = serving.entity_risk_summary(stored, as_of=F.lit(NOW.date()))
    text = plan(top)
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "TakeOrderedAndProject" in text or "Sort" in text
    assert top.count() == 0
    lake.append(gold.global_metrics(rows), GOLD_GLOBAL_TABLE, "g_0")
    assert serving.global_trend(lake.read(GOLD_GLOBAL_TABLE), as_of=F.lit(NOW.date())).count() == 1


def test_only_visible_batches_are_read(spark, lake):
    lake.append(silver_rows(spark, {}), SILVER_TABLE, "s_0")
    assert "dynamicpruning" in plan(lake.read(SILVER_TABLE))


def test_watches(spark):
    metrics = spark.createDataFrame([("silver", "a", 0.95), ("silver", "b", 0.94), ("silver", "c", 0.79), ("silver", "d", 0.8)],
                                    "layer string, batch_id string, pass_rate double")
    levels = [r.level for r in serving.pass_rate_watch(metrics).collect()]
    assert levels == ["OK", "WARNING", "CRITICAL", "WARNING"]
    for minutes, level in ((5, "OK"), (6, "WARNING"), (15, "WARNING"), (16, "CRITICAL")):
        bronze = spark.createDataFrame([(NOW - dt.timedelta(minutes=minutes),)], "ingestion_timestamp timestamp")
        assert serving.lag_watch(bronze, F.lit(NOW)).first().level == level
    progress = spark.createDataFrame([("q", "1", 5), ("q", "2", 10001), ("r", "1", 100001), ("s", "1", None)],
                                     "query_name string, progress_time string, offsets_behind bigint")
    got = {r.query_name: r.level for r in serving.backlog_watch(progress).collect()}
    assert got == {"q": "WARNING", "r": "CRITICAL", "s": "OK"}


def test_quarantine_counts(spark):
    rows = spark.createDataFrame([("a", "x", NOW.date()), ("a", "y", NOW.date()), ("b", "x", dt.date(2020, 1, 1))],
                                 "quarantine_reason string, failed_checks string, event_date date")
    assert {(r.quarantine_reason, r.rows) for r in serving.quarantine_counts(rows).collect()} == {("a", 2), ("b", 1)}
    today = serving.quarantine_counts(rows, F.lit(NOW.date()), with_checks=True)
    assert {(r.failed_checks, r.rows) for r in today.collect()} == {("x", 1), ("y", 1)}


def test_backfill_and_sample(spark, tmp_path):
    lines = [json.dumps({"id": 5, "timestamp": 1769523539, "title": "é"}), "broken", "{\"id\": \"x\"}"]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    rows = read_backfill(spark, str(tmp_path / "in"), F.lit(NOW))
    assert rows.columns == BRONZE.fieldNames()
    first = rows.filter("event_id = '5'").first()
    assert (first.kafka_topic, first.kafka_partition, first.kafka_offset) == ("backfill", 0, 0)
    assert first.event_date == dt.date(2026, 1, 27) and json.loads(first.event_data)["title"] == "é"
    assert rows.count() == 3
    sample = sample_records(spark, str(tmp_path / "in"), 5)
    assert sorted(r.value for r in sample.collect()) == sorted([lines[0], lines[2]])
    assert sample_records(spark, str(tmp_path / "in"), 1).count() == 1
    save_sample(sample, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_profile(spark):
    rows = spark.range(1, 10001).select(
        F.col("id"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("v"), F.col("id") % 3)).alias("s")
    )
    got = {r.column_name: r for r in profile.column_profile(rows).collect()}
    assert (got["id"].rows, got["id"].missing, got["id"].min_value, got["id"].max_value) == (10000, 0, "1", "10000")
    assert got["id"].mean == 5000.5 and got["id"].stddev == pytest.approx(2886.9, abs=0.1)
    assert got["id"].distinct_values == pytest.approx(10000, rel=0.15)
    for share, value in zip(profile.QUANTILES, got["id"].quantiles):
        assert value == pytest.approx(share * 10000, abs=20)
    assert (got["s"].missing, got["s"].distinct_values, got["s"].mean) == (2500, 3, None)
    exact = {r.column_name: r.distinct_values for r in profile.column_profile(rows, exact_distinct=True).collect()}
    assert exact == {"id": 10000, "s": 3}
    top = profile.top_values(rows, ["s"], k=2).orderBy("rank").collect()
    assert [(r.value, r.n) for r in top] == [("v0", 2500), ("v1", 2500)]


def test_top_values_are_limited_before_the_shuffle(spark):
    assert plan(profile.top_values(spark.range(10))).count("WindowGroupLimit") == 2


def test_jobs_from_the_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        "\n".join(json.dumps({"id": i, "timestamp": 1769523539, "meta": {"id": f"m{i}"}, "title": "T", "wiki": "w",
                              "type": "edit", "user": "U", "namespace": 0}) for i in range(1, 4))
    )
    root = str(tmp_path / "lake")
    main(["backfill", root, str(tmp_path / "in")])
    main(["silver", root, "--once"])
    main(["replay", root, "2020-01-01", "--layer", "silver"])
    main(["replay", root, "2020-01-01", "--layer", "gold"])
    main(["reprocess", root, "2026-01-27", "--reason", "%freshness%"])
    for view in ("risk", "users", "trend", "freshness"):
        main(["dashboard", root, view])
    main(["sample", str(tmp_path / "in"), str(tmp_path / "sample"), "--max-events", "2"])
    main(["profile", f"{SF_DIR}/nation.parquet"])
    assert spark.read.text(str(tmp_path / "sample")).count() == 2
    assert Warehouse(spark, root).read("bronze_events").count() == 3
    assert "n_name" in capsys.readouterr().out
