"""Mergeable metric states: one pass, roll-ups, and their plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import plan
from test_quality import silver_rows
from test_streaming import START

from revwatch.operators import gold, states
from revwatch.schemas import (
    GOLD_ENTITY_TABLE,
    GOLD_GLOBAL_TABLE,
    GOLD_USER_TABLE,
    LATE_TABLE,
    METRIC_STATES,
    SILVER_TABLE,
    STATES_TABLE,
)
from revwatch.sinks.warehouse import Warehouse
from revwatch.streaming import late
from revwatch.streaming.pipeline import await_all, start, start_metrics

FAMILIES = (
    (states.page_metrics, gold.entity_metrics),
    (states.user_metrics, gold.user_metrics),
    (states.site_metrics, gold.global_metrics),
)


def edits(spark, n=400):
    """Edits over nine hours: pages, users and wikis repeat; names and figures may be null."""
    return silver_rows(
        spark,
        *(
            {
                "meta_id": f"m{i}",
                "kafka_offset": i,
                "ingestion_timestamp": START + dt.timedelta(minutes=(i * 7) % 540),
                "title": None if i % 61 == 0 else f"Page {i % 9}",
                "canonical_entity": f"enwiki:Topic {i % 3}" if i % 4 == 0 else None,
                "wiki": f"wiki{i % 5}",
                "user_name": None if i % 37 == 0 else f"user{i % 23}",
                "is_anonymous": None if i % 41 == 0 else i % 6 == 0,
                "is_bot": None if i % 43 == 0 else i % 7 == 0,
                "is_revert": i % 5 == 0,
                "bytes_changed": None if i % 29 == 0 else (i * 131) % 9000 - 3000,
                "processing_lag_seconds": None if i % 31 == 0 else i % 50,
                "event_type": ("edit", "new", "log", "categorize")[i % 4],
            }
            for i in range(n)
        ),
    )


def rows(df):
    return sorted((tuple(r) for r in df.drop("aggregation_timestamp").collect()), key=repr)


@pytest.fixture
def lake(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    warehouse.create_tables()
    return warehouse


def test_one_pass_equals_the_three_queries(spark):
    silver = edits(spark)
    found = states.metric_states(silver)
    assert found.schema.names == METRIC_STATES.names
    for build, direct in FAMILIES:
        assert rows(build(found)) == rows(direct(silver, exact_distinct=True))


def test_one_scan_and_one_shuffle(spark, lake):
    lake.append(edits(spark), SILVER_TABLE, "s_0")
    text = plan(states.metric_states(spark.read.parquet(lake.path(SILVER_TABLE))))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1 and "partial_count" in text
    assert "event_data" not in text


@pytest.mark.parametrize("window", ["1 hour", "3 hours", "1 day"])
def test_rollups_equal_direct_windows(spark, lake, window):
    silver = edits(spark)
    half = F.col("kafka_offset") < 200  # batches whose windows overlap merge too
    for name, part in (("a", silver.where(half)), ("b", silver.where(~half))):
        lake.append(states.metric_states(part), STATES_TABLE, name)
    merged = states.roll_up(lake.read(STATES_TABLE), window)
    read = merged.inputFiles()
    assert any(f"/{STATES_TABLE}/" in path for path in read) and not any(f"/{SILVER_TABLE}/" in path for path in read)
    for build, direct in FAMILIES:
        assert rows(build(merged)) == rows(direct(silver, window, exact_distinct=True))


def test_rollup_of_a_rollup_and_windows_that_do_not_fit(spark):
    found = states.metric_states(edits(spark))
    hours = states.roll_up(found, "1 hour")
    for build, _ in FAMILIES:
        assert rows(build(states.roll_up(hours, "1 day", base="1 hour"))) == rows(build(states.roll_up(found, "1 day")))
    with pytest.raises(ValueError, match="cannot be built"):
        states.roll_up(found, "25 minutes")
    assert states.roll_up(found.limit(0), "1 hour").count() == 0


def test_sketches_of_many_values_stay_within_bounds(spark):
    many = spark.range(60_000).select(
        F.lit(START).alias("ingestion_timestamp"),
        F.concat(F.lit("u"), F.col("id") % 30_000).alias("user_name"),
        F.concat(F.lit("p"), F.col("id") % 700).alias("title"),
        F.lit("w").alias("wiki"),
        F.lit("edit").alias("event_type"),
        F.lit(None).cast("string").alias("canonical_entity"),
        *(F.lit(False).alias(c) for c in ("is_revert", "is_anonymous", "is_bot", "is_large_edit", "has_comment")),
        F.lit(1).alias("bytes_changed"),
        *(F.lit(1).cast("bigint").alias(c) for c in ("processing_lag_seconds", "event_timestamp")),
    )
    parts = [states.metric_states(many.where(F.col("bytes_changed") + F.crc32("user_name") % 3 == k)) for k in (1, 2, 3)]
    merged = states.roll_up(parts[0].unionAll(parts[1]).unionAll(parts[2]), "1 hour")
    site = states.site_metrics(merged).first()
    assert site.total_events == 60_000 and site.unique_wikis == 1
    assert abs(site.unique_users - 30_000) < 30_000 * 0.064 and abs(site.unique_entities - 700) < 45


def test_one_streaming_query_fills_all_tables(spark, lake, tmp_path):
    silver = edits(spark)
    closing = silver_rows(spark, {"meta_id": "end", "kafka_offset": 999, "ingestion_timestamp": START + dt.timedelta(hours=12)})
    for at, low in enumerate((0, 180, 360)):  # files in order of arrival
        minute = (F.unix_timestamp("ingestion_timestamp") - F.unix_timestamp(F.lit(START))) / 60
        lake.append(silver.where((minute >= low) & (minute < low + 180)), SILVER_TABLE, f"silver_{at}")
    lake.append(closing, SILVER_TABLE, "silver_9")
    await_all(spark, [start_metrics(lake, f"{tmp_path}/cp", once=True, max_files=1)], once=True)
    tables = (GOLD_ENTITY_TABLE, GOLD_USER_TABLE, GOLD_GLOBAL_TABLE)
    for table, (_, direct) in zip(tables, FAMILIES):
        passed = rows(lake.read(table))
        assert passed and set(passed) <= set(rows(direct(silver, exact_distinct=True)))
    hours = states.roll_up(lake.read(STATES_TABLE).where(F.col("window_end") <= F.lit(START + dt.timedelta(hours=9))), "9 hours")
    assert states.site_metrics(hours).agg(F.sum("total_events")).first()[0] == 400
    assert lake.read("quality_metrics").where("layer = 'gold'").count() > 0


def test_what_comes_in_is_in_a_window_or_late(spark, lake, tmp_path):
    """Per batch: rows in time and late rows add up; windows hold exactly the rows in time."""
    minutes = [[0, 5], [60, 61, 12], [130, 2], [131, 3, 59, 125], [400], [401]]
    at = 0
    for number, batch in enumerate(minutes):
        changes = []
        for minute in batch:
            changes.append({"meta_id": f"m{at}", "kafka_offset": at, "ingestion_timestamp": START + dt.timedelta(minutes=minute)})
            at += 1
        lake.append(silver_rows(spark, *changes).coalesce(1), SILVER_TABLE, f"silver_{number}")
    query = start_metrics(lake, f"{tmp_path}/cp", once=True, max_files=1)
    await_all(spark, [query], once=True)
    late_rows = lake.read(LATE_TABLE).orderBy("kafka_offset").collect()
    windowed = states.roll_up(lake.read(STATES_TABLE).where("family = 'site'"), "1 day").first().total_events
    still_open = 2  # those at 400 and 401 minutes
    assert windowed + len(late_rows) + still_open == sum(map(len, minutes))
    assert {r.late_reason for r in late_rows} == {late.BEHIND}
    assert all(r.ingestion_timestamp <= r.late_watermark for r in late_rows)
    # A second start over nothing new adds nothing.
    await_all(spark, [start_metrics(lake, f"{tmp_path}/cp", once=True, max_files=1)], once=True)
    assert lake.read(LATE_TABLE).count() == len(late_rows)


def test_late_rows_are_those_the_aggregation_drops(spark, tmp_path):
    """Row by row, against a query without the side output."""
    offsets = [[0], [50], [100, 1, 41, 95], [101, 40, 49, 12, 29], [300, 99, 55], [301]]
    folder = f"{tmp_path}/in"
    schema = "ingestion_timestamp timestamp, n int"
    for batch in offsets:
        rows = [(START + dt.timedelta(minutes=m), m) for m in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    marked = source.withWatermark("ingestion_timestamp", "10 minutes")
    windows = marked.groupBy(F.window("ingestion_timestamp", "10 minutes")).agg(F.collect_list("n").alias("members"))
    seen, held = [], []

    def write(batch, number):
        mark = late.late_watermark(batch.sparkSession, f"{tmp_path}/cp", number)
        _, closed, too_late = late.split(batch, mark, "10 minutes")
        held.extend(n for r in closed.collect() for n in r.members)
        seen.extend(r.n for r in too_late.collect())

    start(late.beside(windows, marked), write, f"{tmp_path}/cp", "0 seconds", "late", once=True).awaitTermination()
    arrived = [m for batch in offsets for m in batch]
    assert sorted(held + seen) == sorted(m for m in arrived if m < 290)
    assert seen and not set(seen) & set(held)
