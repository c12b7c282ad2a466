"""Windowed metrics per page, per user and for the whole site.

Each builder is one ``groupBy(window, keys).agg(...)`` followed by projections:
one shuffle, with partial aggregation in front of it, so a page that receives a
third of all edits sends one row per map task and window. The same function
serves a stream (append mode, a window is emitted once the watermark has passed
its end) and a batch frame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.scoring import (
    Flag,
    count_where,
    first_match,
    flag_columns,
    flag_explanation,
    flag_summary,
    one_decimal,
    percent,
    points,
    ratio,
    risk_grade,
    total,
    zscore,
)
from revwatch.schemas import GOLD_ENTITY, GOLD_GLOBAL, GOLD_USER

WINDOW = "10 minutes"
WATERMARK = "10 minutes"

# Normal traffic per 10-minute window. ----------------------------------


@dataclass(frozen=True)
class EntityBaseline:
    events_avg: float = 5.0
    events_stddev: float = 3.0
    revert_ratio: float = 0.12
    anonymous_ratio: float = 0.25


@dataclass(frozen=True)
class UserBaseline:
    edits_avg: float = 2.0
    edits_stddev: float = 1.5
    entities_avg: float = 1.5
    entities_stddev: float = 1.0
    revert_ratio: float = 0.10


@dataclass(frozen=True)
class GlobalBaseline:
    events_avg: float = 150.0
    events_stddev: float = 50.0
    revert_ratio: float = 0.12
    anonymous_ratio: float = 0.25


# Fixed values: (exclusive lower bound, points), highest bound first. -----------------

ENTITY_VOLUME_POINTS = ((3, 25), (2, 15), (1, 5))
ENTITY_REVERT_POINTS = ((0.5, 30), (0.3, 20), (0.2, 10))
ENTITY_ANONYMOUS_POINTS = ((0.7, 25), (0.5, 15), (0.35, 5))
LARGE_CHANGE_POINTS = 15
LOW_QUALITY_BELOW, LOW_QUALITY_POINTS = 0.9, 5

BURST_ABOVE = 2.0
HIGH_REVERT_TIMES = 2.5
ANONYMOUS_SURGE_TIMES = 2.0
LARGE_CHANGE_BYTES = 51200

BLITZ_ABOVE, BLITZ_ENTITIES = 2.0, 3
MASS_REVERTS = 3
MANY_WIKIS = 2
HIGH_REVERT_USER_TIMES = 3
USER_RATIO_POINTS = ((0.5, 20), (0.3, 10))

GLOBAL_REVERT_POINTS = ((0.25, 30), (0.18, 20), (0.12, 10))
GLOBAL_VOLUME_POINTS = ((3, 25), (2, 15), (1, 5))
GLOBAL_ANONYMOUS_POINTS = ((0.5, 20), (0.35, 10))
GLOBAL_LAG_POINTS = ((300, 15), (120, 5))

#: Health levels: (level, revert ratio above, volume z-score above), worst first.
HEALTH_LEVELS = (("CRITICAL", 0.25, 3), ("WARNING", 0.18, 2), ("ELEVATED", 0.15, 1))

# Shared measures. --------------------------------------------------------------------


def _entity() -> Column:
    return F.coalesce(F.col("canonical_entity"), F.col("title"))


def _bytes() -> Column:
    return F.coalesce(F.col("bytes_changed"), F.lit(0))


def _of_type(event_type: str) -> Column:
    return count_where(F.col("event_type") == event_type)


def _distinct(exact: bool):
    """Sketch-based distinct count (one shuffle, fixed state) or the exact one.

    The exact form is for batch frames only; Spark spreads it over the distinct
    values before it gathers the groups, so a hot group still does not meet in
    one task.
    """
    return F.count_distinct if exact else F.approx_count_distinct


def _windowed(silver: DataFrame, length: str, watermark: str | None, keys: list[Column]):
    """``watermark`` is for a stream that has none yet; ``None`` keeps the one it has."""
    source = silver
    if silver.isStreaming and watermark is not None:
        source = silver.withWatermark("ingestion_timestamp", watermark)
    return source.groupBy(F.window("ingestion_timestamp", length), *keys)


def _aggregated(grouped, measures: dict[str, Column]) -> DataFrame:
    result = grouped.agg(*(measure.alias(name) for name, measure in measures.items()))
    return result.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def _finished(df: DataFrame, schema, now: Column | None) -> DataFrame:
    stamped = df.withColumns(
        {
            "aggregation_timestamp": F.current_timestamp() if now is None else now,
            "event_date": F.to_date("window_start"),
        }
    )
    return stamped.select(*schema.fieldNames())


def _text(value: str) -> Column:
    return F.col(value).cast("string")


# Per page. ---------------------------------------------------------------------------


def _entity_flags() -> list[Flag]:
    def against_baseline(label: str, value: str, baseline: str) -> Column:
        return F.concat(
            F.lit(f"{label}: "),
            percent(F.col(value)),
            F.lit(" (baseline: "),
            percent(F.col(baseline)),
            F.lit(")"),
        )

    volume = F.concat(
        F.lit("Events: "),
        _text("total_events"),
        F.lit(" ("),
        one_decimal(F.col("events_zscore")),
        F.lit("σ above normal)"),
    )
    kilobytes = one_decimal(F.abs(F.col("total_bytes_changed")) / 1024)
    return [
        Flag("is_burst_activity", "BURST", F.col("events_zscore") > BURST_ABOVE, volume),
        Flag(
            "is_high_revert_rate",
            "HIGH_REVERT",
            F.col("revert_ratio") > F.col("baseline_revert_ratio") * HIGH_REVERT_TIMES,
            against_baseline("Revert rate", "revert_ratio", "baseline_revert_ratio"),
        ),
        Flag(
            "is_anonymous_surge",
            "ANON_SURGE",
            F.col("anonymous_ratio") > F.col("baseline_anonymous_ratio") * ANONYMOUS_SURGE_TIMES,
            against_baseline("Anonymous", "anonymous_ratio", "baseline_anonymous_ratio"),
        ),
        Flag(
            "is_large_content_change",
            "LARGE_CHANGE",
            F.abs(F.col("total_bytes_changed")) > LARGE_CHANGE_BYTES,
            F.concat(F.lit("Content change: "), kilobytes, F.lit("KB")),
        ),
    ]


def entity_metrics(
    silver: DataFrame,
    window: str = WINDOW,
    watermark: str | None = WATERMARK,
    exact_distinct: bool = False,
    baseline: EntityBaseline = EntityBaseline(),
    now: Column | None = None,
) -> DataFrame:
    """Metrics, anomaly flags and risk per (window, entity, wiki)."""
    distinct = _distinct(exact_distinct)
    keys = [_entity().alias("entity"), F.col("wiki")]
    measured = _aggregated(
        _windowed(silver, window, watermark, keys),
        {
            "total_events": F.count("*"),
            "edit_count": _of_type("edit"),
            "new_page_count": _of_type("new"),
            "categorize_count": _of_type("categorize"),
            "revert_count": count_where(F.col("is_revert")),
            "anonymous_edit_count": count_where(F.col("is_anonymous")),
            "bot_edit_count": count_where(F.col("is_bot")),
            "total_bytes_changed": F.sum(_bytes()),
            "avg_bytes_changed": F.avg(_bytes()),
            "min_bytes_changed": F.min("bytes_changed"),
            "max_bytes_changed": F.max("bytes_changed"),
            "large_edit_count": count_where(F.col("is_large_edit")),
            # Only rows that passed the gate are stored, so all of them count.
            "quality_passed_count": F.count("*"),
            "quality_failed_count": F.lit(0),
            "unique_editors": distinct("user_name"),
            "unique_anonymous_editors": distinct(F.when(F.col("is_anonymous"), F.col("user_name"))),
            "avg_processing_lag_seconds": F.avg("processing_lag_seconds"),
            "max_processing_lag_seconds": F.max("processing_lag_seconds").cast("bigint"),
            "edits_with_comment": count_where(F.col("has_comment")),
            "first_event_timestamp": F.min("event_timestamp").cast("bigint"),
            "last_event_timestamp": F.max("event_timestamp").cast("bigint"),
        },
    )
    return judge_entities(measured, baseline, now)


def _baseline(baseline, *names: str) -> dict[str, Column]:
    """The baseline columns as literals; none where the measures bring their own."""
    return {} if baseline is None else {f"baseline_{n}": F.lit(getattr(baseline, n)) for n in names}


def judge_entities(
    measured: DataFrame, baseline: EntityBaseline | None = EntityBaseline(), now: Column | None = None
) -> DataFrame:
    """Ratios, flags and risk of page measures, however these were aggregated.

    Without a ``baseline`` the measures have the baseline columns already.
    """
    compared = measured.withColumns(
        {
            "revert_ratio": ratio("revert_count", "edit_count"),
            "anonymous_ratio": ratio("anonymous_edit_count", "total_events"),
            "bot_ratio": ratio("bot_edit_count", "total_events"),
            "quality_ratio": ratio("quality_passed_count", "total_events", empty=1.0),
            **_baseline(baseline, "events_avg", "events_stddev", "revert_ratio", "anonymous_ratio"),
        }
    ).withColumns(
        {
            "events_zscore": zscore("total_events", "baseline_events_avg", "baseline_events_stddev"),
            "revert_deviation": F.col("revert_ratio") - F.col("baseline_revert_ratio"),
            "anonymous_deviation": F.col("anonymous_ratio") - F.col("baseline_anonymous_ratio"),
        }
    )
    flags = _entity_flags()
    score = total(
        [
            points(F.col("events_zscore"), ENTITY_VOLUME_POINTS),
            points(F.col("revert_ratio"), ENTITY_REVERT_POINTS),
            points(F.col("anonymous_ratio"), ENTITY_ANONYMOUS_POINTS),
            first_match([(F.col("is_large_content_change"), LARGE_CHANGE_POINTS)], 0),
            first_match([(F.col("quality_ratio") < LOW_QUALITY_BELOW, LOW_QUALITY_POINTS)], 0),
        ]
    )
    judged = (
        compared.withColumns(flag_columns(flags))
        .withColumns({**flag_summary(flags), "risk_score": score})
        .withColumns(
            {"severity": risk_grade("risk_score"), "anomaly_explanation": flag_explanation(flags)}
        )
    )
    return _finished(judged, GOLD_ENTITY, now)


# Per user. ---------------------------------------------------------------------------


def _user_flags() -> list[Flag]:
    edits = F.concat(
        F.lit("Edits: "),
        _text("edit_count"),
        F.lit(" across "),
        _text("entities_edited"),
        F.lit(" entities ("),
        one_decimal(F.col("edits_zscore")),
        F.lit("σ)"),
    )
    return [
        Flag(
            "is_new_user_blitz",
            "BLITZ",
            (F.col("edits_zscore") > BLITZ_ABOVE) & (F.col("entities_edited") > BLITZ_ENTITIES),
            edits,
        ),
        Flag(
            "is_mass_reverter",
            "MASS_REVERT",
            F.col("revert_count") > MASS_REVERTS,
            F.concat(F.lit("Reverts: "), _text("revert_count"), F.lit(" in 10min")),
        ),
        Flag(
            "is_cross_wiki_active",
            "CROSS_WIKI",
            F.col("wikis_touched") > MANY_WIKIS,
            F.concat(F.lit("Cross-wiki: "), _text("wikis_touched"), F.lit(" wikis")),
        ),
        Flag(
            "is_high_revert_user",
            "HIGH_REVERT",
            F.col("revert_ratio") > F.col("baseline_revert_ratio") * HIGH_REVERT_USER_TIMES,
            F.concat(F.lit("Revert ratio: "), percent(F.col("revert_ratio"))),
        ),
    ]


def user_metrics(
    silver: DataFrame,
    window: str = WINDOW,
    watermark: str | None = WATERMARK,
    exact_distinct: bool = False,
    baseline: UserBaseline = UserBaseline(),
    now: Column | None = None,
) -> DataFrame:
    """Behaviour, anomaly flags and risk per (window, user, bot flag, anonymous flag)."""
    distinct = _distinct(exact_distinct)
    keys = [F.col("user_name"), F.col("is_bot"), F.col("is_anonymous")]
    measured = _aggregated(
        _windowed(silver, window, watermark, keys),
        {
            "total_events": F.count("*"),
            "edit_count": _of_type("edit"),
            "new_page_count": _of_type("new"),
            "revert_count": count_where(F.col("is_revert")),
            "total_bytes_changed": F.sum(_bytes()),
            "avg_bytes_changed": F.avg(_bytes()),
            "large_edit_count": count_where(F.col("is_large_edit")),
            "entities_edited": distinct(_entity()),
            "wikis_touched": distinct("wiki"),
            "quality_failed_count": F.lit(0),
            "edits_with_comment": count_where(F.col("has_comment")),
        },
    )
    return judge_users(measured, baseline, now)


def judge_users(
    measured: DataFrame, baseline: UserBaseline | None = UserBaseline(), now: Column | None = None
) -> DataFrame:
    """Ratios, flags and risk of user measures."""
    compared = measured.withColumns(
        {
            "revert_ratio": ratio("revert_count", "edit_count"),
            **_baseline(
                baseline, "edits_avg", "edits_stddev", "entities_avg", "entities_stddev", "revert_ratio"
            ),
        }
    ).withColumns(
        {
            "edits_zscore": zscore("edit_count", "baseline_edits_avg", "baseline_edits_stddev"),
            "entities_zscore": zscore("entities_edited", "baseline_entities_avg", "baseline_entities_stddev"),
        }
    )
    flags = _user_flags()
    blitz, mass, cross_wiki = (
        F.col(name) for name in ("is_new_user_blitz", "is_mass_reverter", "is_cross_wiki_active")
    )
    score = total(
        [
            first_match(
                [(F.col("edits_zscore") > 4, 35), (blitz, 25), (F.col("edits_zscore") > 2, 10)], 0
            ),
            first_match([(F.col("revert_count") > 5, 30), (mass, 20)], 0),
            first_match([(F.col("wikis_touched") > 3, 15), (cross_wiki, 10)], 0),
            points(F.col("revert_ratio"), USER_RATIO_POINTS),
        ]
    )
    kind = first_match(
        [(F.col("is_bot"), "Bot"), (F.col("is_anonymous"), "Anonymous")], "Registered"
    )
    judged = (
        compared.withColumns(flag_columns(flags))
        .withColumns({**flag_summary(flags), "user_risk_score": score, "user_type": kind})
        .withColumns(
            {
                "severity": risk_grade("user_risk_score"),
                "anomaly_explanation": flag_explanation(flags),
            }
        )
    )
    return _finished(judged, GOLD_USER, now)


# Whole site. -------------------------------------------------------------------------


def _health_explanation() -> Column:
    reverts, volume, anonymous = (
        F.col(name) for name in ("revert_ratio", "events_zscore", "anonymous_ratio")
    )
    parts = [
        (reverts > 0.15, [F.lit("Revert ratio: "), percent(reverts), F.lit(" (baseline: 12%)")]),
        (F.abs(volume) > 1, [F.lit("Volume: "), one_decimal(volume), F.lit("σ from normal")]),
        (anonymous > 0.35, [F.lit("Anonymous: "), percent(anonymous)]),
    ]
    spoken = F.concat_ws(" | ", *(F.when(test, F.concat(*words)) for test, words in parts))
    healthy = F.col("platform_health") == "HEALTHY"
    return F.when(healthy, F.lit("All metrics within normal range")).otherwise(spoken)


def global_metrics(
    silver: DataFrame,
    window: str = WINDOW,
    watermark: str | None = WATERMARK,
    exact_distinct: bool = False,
    baseline: GlobalBaseline = GlobalBaseline(),
    now: Column | None = None,
) -> DataFrame:
    """Site-wide activity and health per window."""
    distinct = _distinct(exact_distinct)
    measured = _aggregated(
        _windowed(silver, window, watermark, []),
        {
            "total_events": F.count("*"),
            "total_edits": _of_type("edit"),
            "total_new_pages": _of_type("new"),
            "total_categorize": _of_type("categorize"),
            "total_log": _of_type("log"),
            "total_reverts": count_where(F.col("is_revert")),
            "total_anonymous": count_where(F.col("is_anonymous")),
            "total_bot": count_where(F.col("is_bot")),
            "total_large_edits": count_where(F.col("is_large_edit")),
            "total_bytes_changed": F.sum(_bytes()),
            "avg_bytes_changed": F.avg(_bytes()),
            "total_quality_failed": F.lit(0),
            "unique_users": distinct("user_name"),
            "unique_entities": distinct(_entity()),
            "unique_wikis": distinct("wiki"),
            "avg_processing_lag": F.avg("processing_lag_seconds"),
            "max_processing_lag": F.max("processing_lag_seconds"),
        },
    )
    return judge_site(measured, baseline, now)


def judge_site(
    measured: DataFrame, baseline: GlobalBaseline | None = GlobalBaseline(), now: Column | None = None
) -> DataFrame:
    """Ratios and health of site-wide measures."""
    compared = measured.withColumns(
        {
            "revert_ratio": ratio("total_reverts", "total_edits"),
            "anonymous_ratio": ratio("total_anonymous", "total_events"),
            "bot_ratio": ratio("total_bot", "total_events"),
            **_baseline(baseline, "events_avg", "events_stddev", "revert_ratio", "anonymous_ratio"),
            "events_per_user": ratio("total_events", "unique_users"),
            "events_per_entity": ratio("total_events", "unique_entities"),
        }
    ).withColumns(
        {
            "events_zscore": zscore("total_events", "baseline_events_avg", "baseline_events_stddev"),
            "revert_deviation": F.col("revert_ratio") - F.col("baseline_revert_ratio"),
            "anonymous_deviation": F.col("anonymous_ratio") - F.col("baseline_anonymous_ratio"),
        }
    )
    health = first_match(
        [
            ((F.col("revert_ratio") > reverts) | (F.col("events_zscore") > volume), level)
            for level, reverts, volume in HEALTH_LEVELS
        ],
        "HEALTHY",
    )
    deductions = total(
        [
            points(F.col("revert_ratio"), GLOBAL_REVERT_POINTS),
            points(F.abs(F.col("events_zscore")), GLOBAL_VOLUME_POINTS),
            points(F.col("anonymous_ratio"), GLOBAL_ANONYMOUS_POINTS),
            points(F.col("avg_processing_lag"), GLOBAL_LAG_POINTS),
        ]
    )
    judged = compared.withColumns(
        {"platform_health": health, "health_score": F.lit(100) - deductions}
    ).withColumn("health_explanation", _health_explanation())
    return _finished(judged, GOLD_GLOBAL, now)
