import datetime as dt

import pytest
from pyspark.sql import functions as F

from revwatch.functions.scoring import points, risk_grade
from revwatch.operators import gold
from revwatch.schemas import GOLD_ENTITY, GOLD_GLOBAL, GOLD_USER

START = dt.datetime(2026, 1, 27, 14, 0)

ROW = (
    "canonical_entity string, title string, wiki string, event_type string, is_revert boolean,"
    " is_anonymous boolean, is_bot boolean, bytes_changed int, is_large_edit boolean,"
    " user_name string, processing_lag_seconds bigint, has_comment boolean,"
    " event_timestamp bigint, ingestion_timestamp timestamp"
)


def edits(spark, count, reverts=0, anonymous=0, **fixed):
    """``count`` edits of one page, the first of them reverts or anonymous."""
    base = {
        "canonical_entity": None,
        "title": "P",
        "wiki": "enwiki",
        "event_type": "edit",
        "is_bot": False,
        "bytes_changed": 0,
        "is_large_edit": False,
        "processing_lag_seconds": 5,
        "has_comment": True,
        "event_timestamp": 1769523539,
        "ingestion_timestamp": START,
        **fixed,
    }
    rows = [
        {**base, "is_revert": i < reverts, "is_anonymous": i < anonymous, "user_name": f"u{i}"}
        | {k: v(i) for k, v in fixed.items() if callable(v)}
        for i in range(count)
    ]
    return spark.createDataFrame(rows, ROW)


def entity(spark, *args, **kwargs):
    return gold.entity_metrics(edits(spark, *args, **kwargs), exact_distinct=True).first()


@pytest.mark.parametrize(
    "count, zscore, burst, score",
    [(5, 0.0, False, 0), (8, 1.0, False, 0), (9, 4 / 3, False, 5), (11, 2.0, False, 5),
     (12, 7 / 3, True, 15), (14, 3.0, True, 15), (15, 10 / 3, True, 25)],
)
def test_volume(spark, count, zscore, burst, score):
    row = entity(spark, count)
    assert row.events_zscore == pytest.approx(zscore)
    assert (row.is_burst_activity, row.risk_score) == (burst, score)


@pytest.mark.parametrize(
    "count, reverts, high, score",
    [(5, 1, False, 0), (4, 1, False, 10), (10, 3, False, 10), (3, 1, True, 20), (4, 2, True, 20), (5, 3, True, 30)],
)
def test_reverts(spark, count, reverts, high, score):
    row = entity(spark, count, reverts=reverts)
    expected = score + (5 if count == 10 else 0)
    assert (row.is_high_revert_rate, row.risk_score) == (high, expected)


@pytest.mark.parametrize(
    "count, anonymous, surge, score",
    [(4, 1, False, 0), (5, 2, False, 5), (4, 2, False, 5), (5, 3, True, 15), (5, 4, True, 25)],
)
def test_anonymous(spark, count, anonymous, surge, score):
    row = entity(spark, count, anonymous=anonymous)
    assert (row.is_anonymous_surge, row.risk_score) == (surge, score)


def test_anonymous_points_bound_is_exclusive(spark):
    row = entity(spark, 10, anonymous=7)
    assert row.anonymous_ratio == 0.7 and row.risk_score == 5 + 15


@pytest.mark.parametrize("size, large", [(51200, False), (51201, True), (-51200, False), (-51201, True)])
def test_large_change(spark, size, large):
    row = entity(spark, 1, bytes_changed=size)
    assert (row.is_large_content_change, row.risk_score) == (large, 15 if large else 0)


def test_no_edits_gives_zero_ratio(spark):
    row = entity(spark, 2, reverts=2, event_type="log")
    assert (row.edit_count, row.revert_count, row.revert_ratio) == (0, 2, 0.0)
    assert row.quality_ratio == 1.0


def test_ratio_may_exceed_one(spark):
    rows = edits(spark, 3, reverts=3, event_type=lambda i: "edit" if i == 0 else "new")
    assert gold.entity_metrics(rows).first().revert_ratio == 3.0


def test_everything_at_once(spark):
    row = entity(spark, 16, reverts=16, anonymous=16, bytes_changed=-5000)
    assert row.anomaly_types == "BURST, HIGH_REVERT, ANON_SURGE, LARGE_CHANGE"
    assert (row.risk_score, row.severity) == (95, "CRITICAL")
    assert row.anomaly_explanation == (
        "Events: 16 (3.7σ above normal) | Revert rate: 100.0% (baseline: 12.0%)"
        " | Anonymous: 100.0% (baseline: 25.0%) | Content change: 78.1KB"
    )


def test_quiet_page(spark):
    row = entity(spark, 1)
    assert (row.anomaly_types, row.is_anomaly, row.severity) == ("", False, "NORMAL")
    assert row.anomaly_explanation == "Normal activity"


def test_unknown_flags_do_not_count(spark):
    row = entity(spark, 2, is_bot=None, is_large_edit=None, bytes_changed=None)
    assert (row.bot_edit_count, row.large_edit_count, row.total_bytes_changed) == (0, 0, 0)
    assert row.min_bytes_changed is None and row.avg_bytes_changed == 0.0


def test_grouping_and_windows(spark):
    rows = edits(
        spark,
        4,
        canonical_entity=lambda i: "enwiki:X" if i < 2 else None,
        ingestion_timestamp=lambda i: START + dt.timedelta(minutes=[0, 9, 10, 20][i]),
    )
    found = {(r.entity, r.window_start): r for r in gold.entity_metrics(rows).collect()}
    assert set(found) == {
        ("enwiki:X", START),
        ("P", START + dt.timedelta(minutes=10)),
        ("P", START + dt.timedelta(minutes=20)),
    }
    assert found["enwiki:X", START].total_events == 2
    assert found["enwiki:X", START].window_end == START + dt.timedelta(minutes=10)
    assert found["enwiki:X", START].event_date == START.date()


@pytest.mark.parametrize("score, grade", [(0, "NORMAL"), (1, "LOW"), (14, "LOW"), (15, "MEDIUM"),
                                          (29, "MEDIUM"), (30, "HIGH"), (49, "HIGH"), (50, "CRITICAL")])
def test_grades(spark, score, grade):
    assert spark.range(1).select(F.lit(score).alias("s")).select(risk_grade("s")).first()[0] == grade


def test_points_bounds_are_exclusive(spark):
    values = spark.createDataFrame([(0.5,), (0.500001,), (0.3,), (0.2,), (None,)], "v double")
    got = [r[0] for r in values.select(points(F.col("v"), gold.ENTITY_REVERT_POINTS)).collect()]
    assert got == [20, 30, 10, 0, 0]


def user(spark, count, **kwargs):
    rows = edits(spark, count, **{"user_name": lambda i: "U", "is_anonymous": lambda i: False, **kwargs})
    return gold.user_metrics(rows, exact_distinct=True).first()


@pytest.mark.parametrize(
    "count, entities, blitz, score",
    [(5, 5, False, 0), (6, 3, False, 10), (6, 4, True, 25), (8, 4, True, 25), (9, 1, False, 35), (9, 4, True, 35)],
)
def test_user_blitz(spark, count, entities, blitz, score):
    row = user(spark, count, title=lambda i: f"P{i % entities}")
    assert (row.is_new_user_blitz, row.user_risk_score) == (blitz, score)


@pytest.mark.parametrize("reverts, mass, score", [(3, False, 0), (4, True, 20), (5, True, 20), (6, True, 30)])
def test_mass_reverts(spark, reverts, mass, score):
    # All of them log entries but one, so that neither ratio nor volume plays a part.
    rows = dict(event_type="log", is_revert=lambda i: i < reverts)
    row = user(spark, 8, **rows)
    assert (row.is_mass_reverter, row.user_risk_score) == (mass, score)


@pytest.mark.parametrize("wikis, active, score", [(2, False, 0), (3, True, 10), (4, True, 15)])
def test_cross_wiki(spark, wikis, active, score):
    row = user(spark, 4, wiki=lambda i: f"w{i % wikis}")
    assert (row.is_cross_wiki_active, row.user_risk_score) == (active, score)


def test_high_revert_user_is_above_three_baselines_in_doubles(spark):
    kind = lambda i: "edit" if i < 10 else "log"
    at = user(spark, 10, event_type=kind, is_revert=lambda i: i < 3)
    assert at.revert_ratio == 0.3 and at.is_high_revert_user is False
    above = user(spark, 3, is_revert=lambda i: i < 1)
    assert above.is_high_revert_user is True and above.user_risk_score == 10


def test_user_groups_types_and_text(spark):
    rows = edits(spark, 3, user_name=lambda i: "U", is_anonymous=lambda i: i == 1, is_bot=lambda i: [None, None, True][i])
    found = {(r.is_bot, r.is_anonymous): r.user_type for r in gold.user_metrics(rows).collect()}
    assert found == {(None, False): "Registered", (None, True): "Anonymous", (True, False): "Bot"}
    row = user(spark, 6, title=lambda i: f"P{i}", wiki=lambda i: f"w{i % 3}", is_revert=lambda i: i < 4)
    assert row.anomaly_explanation == (
        "Edits: 6 across 6 entities (2.7σ) | Reverts: 4 in 10min | Cross-wiki: 3 wikis | Revert ratio: 66.7%"
    )
    assert row.anomaly_types == "BLITZ, MASS_REVERT, CROSS_WIKI, HIGH_REVERT"


def site(spark, count, **kwargs):
    return gold.global_metrics(edits(spark, count, **kwargs), exact_distinct=True).first()


@pytest.mark.parametrize(
    "count, health, score",
    [(150, "HEALTHY", 100), (200, "HEALTHY", 100), (201, "ELEVATED", 95), (251, "WARNING", 85),
     (301, "CRITICAL", 75), (99, "HEALTHY", 95), (49, "HEALTHY", 85)],
)
def test_health_by_volume(spark, count, health, score):
    row = site(spark, count)
    assert (row.platform_health, row.health_score) == (health, score)


@pytest.mark.parametrize(
    "reverts, health, score",
    [(18, "HEALTHY", 100), (19, "HEALTHY", 90), (23, "ELEVATED", 90), (27, "ELEVATED", 90), (28, "WARNING", 80), (38, "CRITICAL", 70)],
)
def test_health_by_reverts(spark, reverts, health, score):
    row = site(spark, 150, reverts=reverts)
    assert (row.platform_health, row.health_score) == (health, score)


@pytest.mark.parametrize("lag, score", [(120, 100), (121, 95), (300, 95), (301, 85)])
def test_health_by_lag(spark, lag, score):
    assert site(spark, 150, processing_lag_seconds=lag).health_score == score


def test_health_floor_and_text(spark):
    row = site(spark, 400, reverts=400, anonymous=400, processing_lag_seconds=400)
    assert row.health_score == 10
    assert row.health_explanation == (
        "Revert ratio: 100.0% (baseline: 12%) | Volume: 5.0σ from normal | Anonymous: 100.0%"
    )
    # Low volume is abnormal for the score but not for the status.
    quiet = site(spark, 10)
    assert quiet.health_explanation == "All metrics within normal range"
    assert (quiet.events_per_user, quiet.events_per_entity) == (1.0, 10.0)


def test_schemas(spark):
    rows = edits(spark, 2)
    for build, schema in (
        (gold.entity_metrics, GOLD_ENTITY),
        (gold.user_metrics, GOLD_USER),
        (gold.global_metrics, GOLD_GLOBAL),
    ):
        found = build(rows).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schema]


def test_sketches_are_within_three_deviations(spark):
    rows = spark.range(30000).select(
        F.lit(None).cast("string").alias("canonical_entity"),
        F.concat(F.lit("P"), F.col("id") % 7000).alias("title"),
        F.lit("w").alias("wiki"),
        F.lit("edit").alias("event_type"),
        F.lit(False).alias("is_revert"),
        (F.col("id") % 2 == 0).alias("is_anonymous"),
        F.lit(False).alias("is_bot"),
        F.lit(1).alias("bytes_changed"),
        F.lit(False).alias("is_large_edit"),
        F.concat(F.lit("u"), F.col("id") % 9000).alias("user_name"),
        F.lit(1).cast("bigint").alias("processing_lag_seconds"),
        F.lit(True).alias("has_comment"),
        F.lit(1769523539).cast("bigint").alias("event_timestamp"),
        F.lit(START).alias("ingestion_timestamp"),
    )
    exact = gold.global_metrics(rows, exact_distinct=True).first()
    sketch = gold.global_metrics(rows).first()
    assert (exact.unique_users, exact.unique_entities) == (9000, 7000)
    for name in ("unique_users", "unique_entities", "unique_wikis"):
        assert sketch[name] == pytest.approx(exact[name], rel=3 * 0.05)
