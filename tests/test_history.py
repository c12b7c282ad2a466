"""Baselines from history and the as-of join."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F
from test_plans import SF_DIR, plan

from revwatch.catalogue.queries import registered
from revwatch.functions.asof import asof_last
from revwatch.operators import gold, history

DAY0 = dt.datetime(2026, 1, 1)
KIND = "window_start timestamp, window_end timestamp, entity string, wiki string, total_events bigint, edit_count bigint, revert_count bigint, anonymous_edit_count bigint"


def windows(spark, days=14, seed=1):
    """Three pages, one without a name, with windows at random hours."""
    r = random.Random(seed)
    rows = []
    for page in ("A", "B", None):
        for day in range(days):
            if page == "B" and 4 <= day < 12:  # a page that falls silent
                continue
            for hour in r.sample(range(24), 6):
                at = DAY0 + dt.timedelta(days=day, hours=hour)
                edits = r.randrange(0, 9)
                rows.append((at, at + dt.timedelta(hours=1), page, "w", edits + r.randrange(1, 4), edits, r.randrange(0, edits + 1), 1))
    return rows, spark.createDataFrame(rows, KIND)


def expected(rows, at, page, span=7):
    """The baseline of the last day with windows before ``at``, over the days up to it."""
    days = [x[0].date() for x in rows if x[2] == page and x[0].date() < at.date()]
    if not days:
        return None
    last = max(days)
    own = [x for x in rows if x[2] == page and last - dt.timedelta(days=span) < x[0].date() <= last]
    if len(own) < history.LEAST_WINDOWS:
        return None
    events = [x[4] for x in own]
    edits = sum(x[5] for x in own)
    return (
        statistics.mean(events),
        max(statistics.stdev(events), history.LEAST_DEVIATION),
        sum(x[6] for x in own) / edits if edits else 0.0,
        sum(x[7] for x in own) / sum(events),
    )


def near(a, b):
    return all(abs(x - y) < 1e-9 for x, y in zip(a, b))


def test_baselines_equal_plain_trailing_figures(spark):
    rows, metrics = windows(spark)
    known = history.baselines(metrics, history.PAGES)
    found = history.with_baselines(metrics, known, history.PAGES).collect()
    assert len(found) == len(rows)
    fixed, seen = gold.EntityBaseline(), 0
    for r in found:
        ours = tuple(r[f"baseline_{c}"] for c in ("events_avg", "events_stddev", "revert_ratio", "anonymous_ratio"))
        wanted = expected(rows, r.window_start, r.entity)
        seen += wanted is not None
        if wanted is None:
            wanted = (fixed.events_avg, fixed.events_stddev, fixed.revert_ratio, fixed.anonymous_ratio)
        assert near(ours, wanted), r
    assert seen > len(rows) / 2


def test_no_window_sees_its_own_day_or_later(spark):
    rows, metrics = windows(spark)
    cut = DAY0 + dt.timedelta(days=9)
    changed = metrics.withColumn("total_events", F.when(F.col("window_start") >= F.lit(cut), 1000).otherwise(F.col("total_events")))

    def judged(history_rows):
        known = history.baselines(history_rows, history.PAGES)
        found = history.with_baselines(metrics, known, history.PAGES)
        return {(r.window_start, r.entity): r.baseline_events_avg for r in found.where(F.col("window_start") < F.lit(cut + dt.timedelta(days=1))).collect()}

    assert judged(metrics) == judged(changed)


def test_asof_join_takes_the_last_fact_and_keeps_every_row(spark):
    t = lambda n: DAY0 + dt.timedelta(minutes=n)
    rows = spark.createDataFrame(
        [("a", t(5), 1), ("a", t(10), 2), ("a", t(10), 2), ("a", t(0), 3), (None, t(9), 4), ("b", t(9), 5), ("a", None, 6)],
        "k string, at timestamp, n int",
    )
    facts = spark.createDataFrame(
        [("a", t(5), 50), ("a", t(7), 70), ("a", t(11), 110), (None, t(1), 10), ("c", t(0), 0), ("a", None, -1)],
        "k string, since timestamp, v int",
    )
    found = sorted((r.n, r.v) for r in asof_last(rows, facts, ["k"], "at", "since", ["v"]).fillna(-9, ["v"]).collect())
    assert found == [(1, 50), (2, 70), (2, 70), (3, -9), (4, 10), (5, -9), (6, -9)]
    whole = asof_last(rows.drop("k"), facts.drop("k"), [], "at", "since", ["v"])
    assert whole.count() == 7
    text = plan(asof_last(rows, facts, ["k"], "at", "since", ["v"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_history_raises_and_lowers_flags(spark):
    """A busy page is normal by its own measure, a quiet one is not when it bursts."""
    rows = []
    for day in range(10):
        for hour in range(0, 24, 4):
            at = DAY0 + dt.timedelta(days=day, hours=hour)
            for page, events in (("busy", 100 + hour), ("quiet", 30 if day == 9 and hour == 8 else 1)):
                rows.append((at, at + dt.timedelta(hours=1), page, "w", events, events, 0, 0))
    metrics = spark.createDataFrame(rows, KIND)
    full = metrics.withColumns(
        {
            **{c: F.lit(0).cast("bigint") for c in (
                "new_page_count", "categorize_count", "bot_edit_count", "total_bytes_changed", "large_edit_count", "quality_failed_count",
                "unique_editors", "unique_anonymous_editors", "max_processing_lag_seconds", "edits_with_comment",
                "first_event_timestamp", "last_event_timestamp")},
            **{c: F.lit(0.0) for c in ("avg_bytes_changed", "avg_processing_lag_seconds")},
            **{c: F.lit(0) for c in ("min_bytes_changed", "max_bytes_changed")},
            "quality_passed_count": F.col("total_events"),
        }
    )
    last = F.col("window_start") >= F.lit(DAY0 + dt.timedelta(days=9))
    found = history.entity_metrics(full, full).where(last).collect()
    burst = {(r.entity, r.window_start.hour) for r in found if r.is_burst_activity}
    assert burst == {("quiet", 8)}
    fixed = {r.entity for r in gold.judge_entities(full).where(last).collect() if r.is_burst_activity}
    assert fixed == {"busy", "quiet"}


def test_plan_has_no_join_and_reads_history_by_day(spark):
    text = plan(registered()["entity_history"](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoop" not in text and "SortMergeJoin" not in text
