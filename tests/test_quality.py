import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revwatch.operators import quality
from revwatch.operators.quality import (
    Constraint,
    bronze_gate,
    gold_gate,
    has_size,
    is_complete,
    is_contained_in,
    is_non_negative,
    is_positive,
    run_suite,
    satisfies,
    severity,
    severity_column,
    silver_gate,
)
from revwatch.schemas import BRONZE, QUARANTINE, SILVER

NOW = dt.datetime(2026, 1, 27, 14, 20)

GOOD = {
    "event_id": "enwiki:A",
    "event_data": "{}",
    "wikimedia_id": 1,
    "meta_id": "m1",
    "event_type": "edit",
    "namespace": 0,
    "title": "A",
    "user_name": "Ann",
    "wiki": "enwiki",
    "event_timestamp": 1769523539,
    "kafka_topic": "edits",
    "kafka_partition": 0,
    "kafka_offset": 1,
    "ingestion_timestamp": NOW,
    "processing_lag_seconds": 61,
    "event_date": NOW.date(),
}


def silver_rows(spark, *changes):
    rows = [{**GOOD, **change} for change in changes]
    return spark.createDataFrame([tuple(r.get(n) for n in SILVER.fieldNames()) for r in rows], SILVER)


def reason(spark, **change):
    flagged = silver_gate().flag(silver_rows(spark, change)).first()
    assert flagged.is_quality_passed is (flagged._failed_rules == [])
    return flagged._failed_rules


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"event_id": None}, ["missing:event_id"]),
        ({"meta_id": None}, ["missing:meta_id"]),
        ({"wikimedia_id": None}, ["missing:wikimedia_id", "range:wikimedia_id"]),
        ({"wikimedia_id": 0}, ["range:wikimedia_id"]),
        ({"event_type": None}, ["valid_type:event_type"]),
        ({"event_type": "external"}, ["valid_type:event_type"]),
        ({"title": None}, ["missing:title"]),
        ({"user_name": None}, ["missing:user_name"]),
        ({"wiki": None}, ["missing:wiki"]),
        ({"namespace": None}, ["range:namespace"]),
        ({"namespace": -1}, ["range:namespace"]),
        ({"processing_lag_seconds": None}, ["freshness:processing_lag_seconds"]),
        ({"processing_lag_seconds": -1}, ["freshness:processing_lag_seconds"]),
        ({"processing_lag_seconds": 0}, []),
        ({"processing_lag_seconds": 3600}, []),
        ({"processing_lag_seconds": 3601}, ["freshness:processing_lag_seconds"]),
        ({"event_timestamp": None}, ["temporal:event_timestamp"]),
        ({"event_timestamp": 1640995200}, ["temporal:event_timestamp"]),
        ({"event_timestamp": 1640995201}, []),
    ],
)
def test_silver_rules(spark, change, reasons):
    assert reason(spark, **change) == reasons


def test_filter_form_agrees_with_the_flag(spark):
    rows = silver_rows(spark, {}, {"title": None}, {"namespace": None}, {"event_type": None}, {"namespace": -1})
    rules = quality.silver_rules(rows.columns)
    assert rows.filter(quality.passes(rules)).count() == 1
    assert quality.flag_rows(rows, rules).filter(quality.PASS_FLAG).count() == 1


@pytest.mark.parametrize("ahead, valid", [(599, True), (600, False), (601, False)])
def test_future_rows_are_flagged_not_rejected(spark, ahead, valid):
    second = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp())
    rows = quality.silver_helper_flags(silver_rows(spark, {"event_timestamp": second + ahead}), F.lit(NOW))
    assert rows.first().is_temporal_valid is valid
    assert silver_gate().flag(rows).first().is_quality_passed


def test_helper_flags(spark):
    rows = quality.silver_helper_flags(
        silver_rows(spark, {}, {"title": None, "event_type": None, "processing_lag_seconds": None, "event_timestamp": None}),
        F.lit(NOW),
    ).collect()
    names = ("has_schema_violations", "is_valid_type", "is_fresh", "is_temporal_valid")
    assert [[r[n] for n in names] for r in rows] == [[False, True, True, True], [True, False, False, False]]


@pytest.mark.parametrize(
    "column, passes",
    [("event_id", False), ("event_data", False), ("kafka_topic", False), ("kafka_offset", False),
     ("ingestion_timestamp", False), ("kafka_partition", True), ("event_date", True)],
)
def test_bronze_rules(spark, column, passes):
    row = {n: GOOD.get(n) for n in BRONZE.fieldNames()} | {column: None}
    frame = spark.createDataFrame([tuple(row.values())], BRONZE)
    assert bronze_gate().flag(frame).first().is_quality_passed is passes


def test_gold_rules_follow_the_columns(spark):
    entity = spark.createDataFrame([(1, "A", "w"), (1, None, "w"), (1, "A", None), (-1, "A", "w"), (None, "A", "w")],
                                   "total_events bigint, entity string, wiki string")
    flags = [r.is_quality_passed for r in gold_gate().flag(entity).collect()]
    assert flags == [True, False, False, False, False]
    users = spark.createDataFrame([(1, "U"), (1, None)], "total_events bigint, user_name string")
    assert [r.is_quality_passed for r in gold_gate().flag(users).collect()] == [True, False]
    assert gold_gate().flag(users.select("total_events")).filter("is_quality_passed").count() == 2


def test_constraints(spark):
    rows = spark.createDataFrame([(1, "a"), (0, "b"), (None, None)], "n int, s string")
    suite = [
        has_size(1), has_size(4), is_complete("n"), is_non_negative("n"), is_positive("n"),
        is_contained_in("s", ["a", "b"]), is_contained_in("s", ["a"]), satisfies("n >= 0", "known and not negative"),
    ]
    got = {r.constraint: r.constraint_status for r in run_suite(rows, suite).collect()}
    assert got == {
        "SizeConstraint(rows >= 1)": "Success",
        "SizeConstraint(rows >= 4)": "Failure",
        "CompletenessConstraint(n)": "Failure",
        "ComplianceConstraint(n is non-negative)": "Success",
        "ComplianceConstraint(n is positive)": "Failure",
        "ComplianceConstraint(s contained in a,b)": "Success",
        "ComplianceConstraint(s contained in a)": "Failure",
        "ComplianceConstraint(known and not negative)": "Failure",
    }


def test_empty_batch(spark):
    result = silver_gate().run(silver_rows(spark), "b")
    assert result.metrics["pass_rate"] == 1.0 and result.metrics["total_count"] == 0
    assert set(result.metrics["checks"].values()) == {"Failure"}
    result.release()


RATES = [0.0, 0.79999, 0.8, 0.94999, 0.95, 1.0]
CHECKS = [[], ["ComplianceConstraint(x)"], ["CompletenessConstraint(x)"], ["SizeConstraint(rows >= 1)", "y"]]


def test_severity_table():
    plain = [severity(rate, CHECKS[1]) for rate in RATES]
    assert plain == ["CRITICAL", "CRITICAL", "WARNING", "WARNING", "SUCCESS", "SUCCESS"]
    critical = [severity(rate, CHECKS[2]) for rate in RATES]
    assert critical == ["CRITICAL", "CRITICAL", "CRITICAL", "CRITICAL", "WARNING", "WARNING"]


def test_severity_column_equals_function(spark):
    cases = [(rate, checks) for rate in RATES for checks in CHECKS]
    frame = spark.createDataFrame(cases, "rate double, checks array<string>")
    got = frame.select("rate", "checks", severity_column(F.col("rate"), F.col("checks")).alias("s")).collect()
    assert [r.s for r in got] == [severity(r.rate, r.checks) for r in got]


def test_gate_conserves_rows_and_reports(spark):
    rows = silver_rows(spark, *([{}] * 9), {"title": None})
    result = silver_gate().run(rows, "silver_0")
    m = result.metrics
    assert (m["total_count"], m["passed_count"], m["failed_count"], m["pass_rate"]) == (10, 9, 1, 0.9)
    assert m["failed_checks"] == ["CompletenessConstraint(title)"]
    assert result.passed.count() + result.failed.count() == 10
    assert result.passed.columns == SILVER.fieldNames()
    assert result.severity == "CRITICAL"
    assert result.alert()["channels"] == ["sns", "slack"]
    assert "*Pass Rate:* 90.0%" in result.alert()["message"]
    result.release()


def test_gate_needs_one_job(spark):
    tracker = spark.sparkContext.statusTracker()
    rows = silver_rows(spark, {}, {"title": None})
    spark.sparkContext.setJobGroup("gate", "gate")
    try:
        result = silver_gate().run(rows, "b", keep=False)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # AQE runs the map side of the one aggregation as a job of its own.
    assert len(tracker.getJobIdsForGroup("gate")) <= 2
    result.release()


def test_default_batch_id(spark):
    result = gold_gate().run(spark.createDataFrame([(1,)], "total_events bigint"))
    assert result.metrics["batch_id"].startswith("gold_2") and result.metrics["checks"] == {}
    assert result.alert() is None
    result.release()


def test_quarantine_format(spark):
    result = silver_gate().run(silver_rows(spark, {"title": None, "namespace": -1}), "silver_3")
    rows = quality.quarantine_rows(result.failed, "silver_3", result.metrics["failed_checks"], F.lit(NOW))
    assert rows.columns == QUARANTINE.fieldNames()
    row = rows.first()
    assert row.quarantine_reason == "missing:title, range:namespace"
    assert "CompletenessConstraint(title)" in json.loads(row.failed_checks)
    original = json.loads(row.original_record)
    assert original["meta_id"] == "m1" and "title" not in original
    assert not [k for k in original if k.startswith("is_quality") or k in quality.HELPER_FLAGS or k.startswith("_")]
    result.release()


def test_gold_quarantine_uses_event_date(spark):
    frame = spark.createDataFrame([(1, None, NOW.date())], "total_events bigint, user_name string, event_date date")
    result = gold_gate().run(frame, "gold_0")
    assert quality.quarantine_rows(result.failed, "gold_0").first().event_date == NOW.date()
    result.release()


def test_bronze_row_without_arrival_is_still_quarantined(spark):
    row = {n: GOOD.get(n) for n in BRONZE.fieldNames()} | {"ingestion_timestamp": None}
    result = bronze_gate().run(spark.createDataFrame([tuple(row.values())], BRONZE), "b")
    assert quality.quarantine_rows(result.failed, "b", now=F.lit(NOW)).first().event_date == NOW.date()
    result.release()


def test_suite_per_group(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "g string, n int")
    got = {(r.g, r.constraint_status) for r in run_suite(rows, [Constraint("n", F.col("n").isNotNull())], ["g"]).collect()}
    assert got == {("a", "Failure"), ("b", "Success")}
