"""Mergeable metric states: the three families in one pass, rolled up to longer windows.

A row of the cleaned layer counts for its page, its user and the whole site. It is expanded
to one row per family before a single shuffle, so the layer is read and shuffled once for
all three. What comes out are states, not figures: sums, extremes and HyperLogLog sketches,
which can be merged. Hours and days are built from stored ten-minute states; the cleaned
layer is not read again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.scoring import count_where
from revwatch.operators import gold
from revwatch.schemas import METRIC_STATES

PAGE, USER, SITE = FAMILIES = ("page", "user", "site")
KEYS = ("entity", "wiki", "user_name", "is_bot", "is_anonymous")
_FAMILY_KEYS = {PAGE: ("entity", "wiki"), USER: ("user_name", "is_bot", "is_anonymous"), SITE: ()}

#: Sketches and the families that have them.
SKETCHES = {"users": (PAGE, SITE), "anonymous_users": (PAGE,), "entities": (USER, SITE), "wikis": (USER, SITE)}
#: Registers of a sketch as a power of two: a standard error of 1.6 %.
LOG_REGISTERS = 12

_SUMS = (
    "total_events", "edit_count", "new_count", "categorize_count", "log_count", "revert_count", "anonymous_count",
    "bot_count", "large_count", "comment_count", "bytes_sum", "lag_sum", "lag_count",
)
_LEAST, _MOST = ("bytes_min", "first_event"), ("bytes_max", "lag_max", "last_event")


def _expanded(silver: DataFrame) -> DataFrame:
    """A row per family: its keys, the others null, and the measured columns."""
    entity = F.coalesce("canonical_entity", "title")
    own = {"entity": entity, **{k: F.col(k) for k in KEYS[1:]}}
    kinds = {k: METRIC_STATES[k].dataType for k in KEYS}
    rows = F.array(
        *(
            F.struct(
                F.lit(family).alias("family"),
                *((own[k] if k in keys else F.lit(None).cast(kinds[k])).alias(k) for k in KEYS),
            )
            for family, keys in _FAMILY_KEYS.items()
        )
    )
    is_type = {name: F.col("event_type") == name for name in ("edit", "new", "categorize", "log")}
    flags = {"revert": "is_revert", "anonymous": "is_anonymous", "bot": "is_bot", "large": "is_large_edit", "comment": "has_comment"}
    return silver.select(
        "ingestion_timestamp",
        *(is_type[name].alias(f"_{name}") for name in is_type),
        *(F.col(column).alias(f"_{name}") for name, column in flags.items()),
        F.col("bytes_changed").alias("_bytes"),
        F.col("processing_lag_seconds").alias("_lag"),
        F.col("event_timestamp").alias("_time"),
        F.col("user_name").alias("_users"),
        F.when(F.col("is_anonymous"), F.col("user_name")).alias("_anonymous_users"),
        entity.alias("_entities"),
        F.col("wiki").alias("_wikis"),
        F.inline(rows),
    )


def _dated(df: DataFrame) -> DataFrame:
    spans = {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    return df.withColumns(spans).withColumn("event_date", F.to_date("window_start")).select(*METRIC_STATES.fieldNames())


def _sketched(name: str, sketch: Column) -> Column:
    """The sketch where the family has one."""
    return F.when(F.col("family").isin(*SKETCHES[name]), sketch).alias(name)


def metric_states(silver: DataFrame, window: str = gold.WINDOW, watermark: str | None = gold.WATERMARK) -> DataFrame:
    """States of all families per window and key, from one scan and one shuffle.

    On a stream without a watermark ``watermark`` sets one; a window comes out once it is closed.
    """
    rows = _expanded(silver)
    if silver.isStreaming and watermark is not None:
        rows = rows.withWatermark("ingestion_timestamp", watermark)
    counts = ("edit", "new", "categorize", "log", "revert", "anonymous", "bot", "large", "comment")
    measured = rows.groupBy("family", F.window("ingestion_timestamp", window), *KEYS).agg(
        F.count("*").alias("total_events"),
        *(count_where(F.col(f"_{name}")).alias(f"{name}_count") for name in counts),
        F.sum(F.coalesce("_bytes", F.lit(0))).alias("bytes_sum"),
        F.min("_bytes").alias("bytes_min"),
        F.max("_bytes").alias("bytes_max"),
        F.coalesce(F.sum("_lag"), F.lit(0)).alias("lag_sum"),
        F.count("_lag").alias("lag_count"),
        F.max("_lag").alias("lag_max"),
        F.min("_time").alias("first_event"),
        F.max("_time").alias("last_event"),
        *(
            F.hll_sketch_agg(F.when(F.col("family").isin(*own), F.col(f"_{name}")), LOG_REGISTERS).alias(f"_{name}_sketch")
            for name, own in SKETCHES.items()
        ),
    )
    return _dated(measured.withColumns({n: _sketched(n, F.col(f"_{n}_sketch")) for n in SKETCHES}))


def window_seconds(window: str) -> int:
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", window)
    if not found:
        raise ValueError(f"not a window length: {window!r}")
    return int(found[1]) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[found[2]]


def roll_up(states: DataFrame, window: str, base: str = gold.WINDOW) -> DataFrame:
    """States of longer windows from those of ``base`` windows, which must divide them."""
    if window_seconds(window) % window_seconds(base):
        raise ValueError(f"windows of {window!r} cannot be built from windows of {base!r}")
    merged = states.groupBy("family", F.window("window_start", window), *KEYS).agg(
        *(F.sum(name).alias(name) for name in _SUMS),
        *(F.min(name).alias(name) for name in _LEAST),
        *(F.max(name).alias(name) for name in _MOST),
        *(F.hll_union_agg(name).alias(f"_{name}_sketch") for name in SKETCHES),
    )
    return _dated(merged.withColumns({n: _sketched(n, F.col(f"_{n}_sketch")) for n in SKETCHES}))


def _of(states: DataFrame, family: str, columns: dict[str, str | Column]) -> DataFrame:
    """The rows of a family under the names its judge knows."""
    named = [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    return states.where(F.col("family") == family).select("window_start", "window_end", *_FAMILY_KEYS[family], *named)


def _mean(total: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def _distinct(sketch: str) -> Column:
    return F.hll_sketch_estimate(sketch)


def page_metrics(states: DataFrame, baseline: gold.EntityBaseline = gold.EntityBaseline(), now: Column | None = None) -> DataFrame:
    """The page table of these states."""
    measured = _of(
        states,
        PAGE,
        {
            "total_events": "total_events",
            "edit_count": "edit_count",
            "new_page_count": "new_count",
            "categorize_count": "categorize_count",
            "revert_count": "revert_count",
            "anonymous_edit_count": "anonymous_count",
            "bot_edit_count": "bot_count",
            "total_bytes_changed": "bytes_sum",
            "avg_bytes_changed": _mean("bytes_sum", "total_events"),
            "min_bytes_changed": "bytes_min",
            "max_bytes_changed": "bytes_max",
            "large_edit_count": "large_count",
            "quality_passed_count": "total_events",
            "quality_failed_count": F.lit(0),
            "unique_editors": _distinct("users"),
            "unique_anonymous_editors": _distinct("anonymous_users"),
            "avg_processing_lag_seconds": _mean("lag_sum", "lag_count"),
            "max_processing_lag_seconds": "lag_max",
            "edits_with_comment": "comment_count",
            "first_event_timestamp": "first_event",
            "last_event_timestamp": "last_event",
        },
    )
    return gold.judge_entities(measured, baseline, now)


def user_metrics(states: DataFrame, baseline: gold.UserBaseline = gold.UserBaseline(), now: Column | None = None) -> DataFrame:
    """The user table of these states."""
    measured = _of(
        states,
        USER,
        {
            "total_events": "total_events",
            "edit_count": "edit_count",
            "new_page_count": "new_count",
            "revert_count": "revert_count",
            "total_bytes_changed": "bytes_sum",
            "avg_bytes_changed": _mean("bytes_sum", "total_events"),
            "large_edit_count": "large_count",
            "entities_edited": _distinct("entities"),
            "wikis_touched": _distinct("wikis"),
            "quality_failed_count": F.lit(0),
            "edits_with_comment": "comment_count",
        },
    )
    return gold.judge_users(measured, baseline, now)


def site_metrics(states: DataFrame, baseline: gold.GlobalBaseline = gold.GlobalBaseline(), now: Column | None = None) -> DataFrame:
    """The site-wide table of these states."""
    measured = _of(
        states,
        SITE,
        {
            "total_events": "total_events",
            "total_edits": "edit_count",
            "total_new_pages": "new_count",
            "total_categorize": "categorize_count",
            "total_log": "log_count",
            "total_reverts": "revert_count",
            "total_anonymous": "anonymous_count",
            "total_bot": "bot_count",
            "total_large_edits": "large_count",
            "total_bytes_changed": "bytes_sum",
            "avg_bytes_changed": _mean("bytes_sum", "total_events"),
            "total_quality_failed": F.lit(0),
            "unique_users": _distinct("users"),
            "unique_entities": _distinct("entities"),
            "unique_wikis": _distinct("wikis"),
            "avg_processing_lag": _mean("lag_sum", "lag_count"),
            "max_processing_lag": "lag_max",
        },
    )
    return gold.judge_site(measured, baseline, now)
