"""Dashboard and operations queries over the layer tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.scoring import first_match

#: Fixed value: rows of the two top lists.
TOP = 100

# Fixed values: (warning above, critical above) of lags and backlogs, and (warning
# below, critical below) of the pass rate.
BRONZE_LAG_SECONDS = (5 * 60, 15 * 60)
QUEUE_BACKLOG = (10_000, 100_000)
PASS_RATE = (0.95, 0.80)


def _last_day(df: DataFrame, as_of: Column | None) -> DataFrame:
    """Rows of the last day, by the partition column so that older files are not read."""
    today = F.current_date() if as_of is None else as_of
    return df.filter(F.col("event_date") >= F.date_sub(today, 1))


def entity_risk_summary(gold: DataFrame, as_of: Column | None = None, top: int = TOP) -> DataFrame:
    """The pages with the highest risk of the last day."""
    risky = _last_day(gold, as_of).filter("risk_score > 0")
    return (
        risky.select(
            "entity",
            "wiki",
            "window_start",
            "total_events",
            "edit_count",
            "revert_count",
            "anonymous_edit_count",
            "risk_score",
            "revert_ratio",
            "anonymous_ratio",
        )
        # The keys after the two measures only make ties come out the same each time.
        .orderBy(F.desc("risk_score"), F.desc("total_events"), "window_start", "entity", "wiki")
        .limit(top)
    )


def user_anomalies(gold: DataFrame, as_of: Column | None = None, top: int = TOP) -> DataFrame:
    """The users with the highest risk of the last day."""
    risky = _last_day(gold, as_of).filter("user_risk_score > 0")
    ties = ("window_start", "user_name", "is_bot", "is_anonymous")
    shown = (
        "user_name",
        "window_start",
        "total_events",
        "edit_count",
        "revert_count",
        "entities_edited",
        "wikis_touched",
        "user_risk_score",
        "is_new_user_blitz",
        "is_mass_reverter",
        "is_cross_wiki_active",
    )
    return risky.orderBy(F.desc("user_risk_score"), *ties).limit(top).select(*shown)


def global_trend(gold: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Site activity of the last day, newest window first."""
    return (
        _last_day(gold, as_of)
        .select(
            "window_start",
            "total_events",
            "total_edits",
            "total_reverts",
            "total_anonymous",
            "unique_users",
            "unique_entities",
            "revert_ratio",
            "anonymous_ratio",
            "avg_processing_lag",
        )
        .orderBy(F.desc("window_start"))
    )


def latest_arrival(layer: DataFrame) -> DataFrame:
    return layer.agg(F.max("ingestion_timestamp").alias("latest"))


def freshness(layers: Mapping[str, DataFrame], now: Column | None = None) -> DataFrame:
    """Newest arrival per layer and how long ago it was."""
    clock = F.current_timestamp() if now is None else now
    parts = [latest_arrival(df).select(F.lit(name).alias("layer"), "latest") for name, df in layers.items()]
    newest = reduce(DataFrame.unionByName, parts)
    behind = F.unix_timestamp(clock) - F.unix_timestamp("latest")
    return newest.withColumns({"lag": clock - F.col("latest"), "lag_seconds": behind})


def quarantine_counts(quarantine: DataFrame, on: Column | None = None, with_checks: bool = False) -> DataFrame:
    """Quarantined rows per reason (and per failed batch checks), optionally of one date."""
    rows = quarantine if on is None else quarantine.filter(F.col("event_date") == on)
    keys = ["quarantine_reason", "failed_checks"] if with_checks else ["quarantine_reason"]
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"))


def quarantine_selection(quarantine: DataFrame, on: Column | None, reason_like: str = "%") -> DataFrame:
    """The quarantined rows of a date whose reason matches a pattern."""
    rows = quarantine if on is None else quarantine.filter(F.col("event_date") == on)
    return rows.filter(F.col("quarantine_reason").like(reason_like))


def _level(value: Column, bounds: tuple[float, float], falling: bool = False) -> Column:
    warning, critical = bounds
    if falling:
        cases = [(value < critical, "CRITICAL"), (value < warning, "WARNING")]
    else:
        cases = [(value > critical, "CRITICAL"), (value > warning, "WARNING")]
    return first_match(cases, "OK")


def pass_rate_watch(metrics: DataFrame) -> DataFrame:
    """Alarm level of every recorded pass rate."""
    return metrics.select(
        "layer", "batch_id", "pass_rate", _level(F.col("pass_rate"), PASS_RATE, falling=True).alias("level")
    )


def lag_watch(bronze: DataFrame, now: Column | None = None) -> DataFrame:
    """Alarm level of the raw layer's lag."""
    seen = freshness({"bronze": bronze}, now)
    return seen.select(
        "layer", "lag_seconds", _level(F.col("lag_seconds"), BRONZE_LAG_SECONDS).alias("level")
    )


def backlog_watch(progress: DataFrame) -> DataFrame:
    """Alarm level of the messages each query had not read at its newest progress."""
    newest = progress.groupBy("query_name").agg(F.max_by("offsets_behind", "progress_time").alias("offsets_behind"))
    return newest.withColumn("level", _level(F.col("offsets_behind"), QUEUE_BACKLOG))
