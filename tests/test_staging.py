"""Quarantine staging: stage, repair, clear."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from test_plans import plan
from test_quality import NOW, silver_rows

from revwatch.operators.quality import silver_gate
from revwatch.plans import recovery, serving
from revwatch.plans.staging import KEY, QuarantineStaging
from revwatch.schemas import SILVER_TABLE
from revwatch.sinks.layers import write_batch
from revwatch.sinks.warehouse import Warehouse

WIDER = silver_gate(max_lag_seconds=7200)


@pytest.fixture
def lake(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS staged_here")
    warehouse = Warehouse(spark, str(tmp_path / "lake"))
    warehouse.create_tables()
    late = {"processing_lag_seconds": 3700, "event_timestamp": int(NOW.replace(tzinfo=dt.timezone.utc).timestamp()) - 3700}
    rows = [{"meta_id": f"late{i}", "kafka_offset": i, **late} for i in range(6)]
    rows += [{"meta_id": f"bad{i}", "kafka_offset": 100 + i, "title": None, **late} for i in range(2)]
    rows += [{"meta_id": "fine", "kafka_offset": 900}]
    write_batch(warehouse, SILVER_TABLE, silver_rows(spark, *rows), "s_0", silver_gate())
    yield warehouse
    spark.sql("DROP TABLE IF EXISTS staged_here")


def ids(df):
    return sorted(r.meta_id for r in df.select("meta_id").collect())


def chosen(lake):
    return serving.quarantine_selection(lake.read("silver_quarantine"), None, "%freshness%")


def test_stage_repair_clear_and_nothing_the_second_time(spark, lake):
    staging = QuarantineStaging(lake, "staged_here", buckets=4)
    assert staging.rows().count() == 0 and staging.repair(gate=WIDER) is None
    assert staging.stage(chosen(lake)) == 8
    assert staging.stage(chosen(lake)) == 8  # staged once
    metrics = staging.repair(gate=WIDER)
    assert (metrics["passed_count"], metrics["failed_count"]) == (6, 2)
    after = ids(lake.read(SILVER_TABLE))
    assert after == sorted(["fine", *(f"late{i}" for i in range(6))])
    assert staging.rows().count() == 0 and spark.catalog.tableExists("staged_here")
    assert staging.repair(gate=WIDER) is None
    assert ids(lake.read(SILVER_TABLE)) == after
    # Staged once more, the stored records are left alone and the bad ones fail again.
    staging.stage(chosen(lake))
    assert staging.open_rows().count() >= 2
    staging.repair(gate=WIDER)
    assert ids(lake.read(SILVER_TABLE)) == after


def test_a_run_lost_before_clearing_adds_nothing_again(lake, monkeypatch):
    staging = QuarantineStaging(lake, "staged_here", buckets=4)
    staging.stage(chosen(lake))
    monkeypatch.setattr(QuarantineStaging, "clear", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        staging.repair(gate=WIDER)
    monkeypatch.undo()
    assert staging.rows().count() == 8
    staging.repair(gate=WIDER)
    assert len(ids(lake.read(SILVER_TABLE))) == 7 and staging.rows().count() == 0


def test_lookup_shuffles_only_the_keys_of_silver(spark, lake):
    staging = QuarantineStaging(lake, "staged_here", buckets=4)
    staging.stage(chosen(lake))
    assert staging.rows().groupBy(KEY).count().where("count > 1").count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(staging.open_rows())
        stored = plan(lake.read(SILVER_TABLE))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning(record_key") == 1
    assert text.count("Exchange") == stored.count("Exchange") + 1
    assert "Bucketed: true" in text


def test_fix_applies_to_staged_rows(lake):
    staging = QuarantineStaging(lake, "staged_here", buckets=4)
    staging.stage(chosen(lake))
    staging.repair(lambda rows: rows.withColumn("title", F.coalesce("title", F.lit("Found again"))), WIDER)
    assert lake.read(SILVER_TABLE).where("title = 'Found again'").count() == 2
    assert recovery.decode_quarantine(lake.read("silver_quarantine")).count() >= 2
