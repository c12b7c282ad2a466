"""Baselines from history: what is normal for a page, a user or the site, as of a moment.

Stored windows are reduced to sums per key and day; a trailing range frame over days gives
mean, deviation and ratios, valid from the next midnight on. A window is judged by the last
baseline that was valid when it began, so none sees its own day or what came after it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revwatch.functions.asof import asof_last
from revwatch.operators import gold

#: Days a baseline looks back, windows it must rest on, and the least deviation it may have.
SPAN_DAYS, LEAST_WINDOWS, LEAST_DEVIATION = 7, 12, 0.5


@dataclass(frozen=True)
class Family:
    """What is normal in a family: means of measures, ratios of sums.

    ``means`` and ``ratios`` map the name of a baseline column's middle part to measures.
    ``defaults`` hold where there is too little history.
    """

    keys: Sequence[str]
    means: Mapping[str, str]
    ratios: Mapping[str, tuple[str, str]]
    defaults: object

    def columns(self) -> list[str]:
        means = [f"baseline_{name}_{what}" for name in self.means for what in ("avg", "stddev")]
        return [*means, *(f"baseline_{name}_ratio" for name in self.ratios)]

    def default(self, column: str) -> float:
        return getattr(self.defaults, column.removeprefix("baseline_"))


PAGES = Family(
    ("entity", "wiki"),
    {"events": "total_events"},
    {"revert": ("revert_count", "edit_count"), "anonymous": ("anonymous_edit_count", "total_events")},
    gold.EntityBaseline(),
)
USERS = Family(
    ("user_name", "is_bot", "is_anonymous"),
    {"edits": "edit_count", "entities": "entities_edited"},
    {"revert": ("revert_count", "edit_count")},
    gold.UserBaseline(),
)
SITE = Family(
    (),
    {"events": "total_events"},
    {"revert": ("total_reverts", "total_edits"), "anonymous": ("total_anonymous", "total_events")},
    gold.GlobalBaseline(),
)


def baselines(metrics: DataFrame, family: Family, span_days: int = SPAN_DAYS) -> DataFrame:
    """A row per key and day with windows: its baseline, ``valid_from`` the next midnight on.

    One shuffle by key and day with partial sums, one by key over a row per day. Windows
    without events leave no row and do not count. ``windows`` says how many there were.
    """
    exact = "decimal(38,0)"
    sums = [F.count("*").alias("windows")]
    for name, measure in family.means.items():
        value = F.col(measure).cast("decimal(18,0)")
        sums += [F.sum(value).cast(exact).alias(f"s_{name}"), F.sum(value * value).cast(exact).alias(f"q_{name}")]
    for name, (part, whole) in family.ratios.items():
        sums += [F.sum(part).alias(f"p_{name}"), F.sum(whole).alias(f"w_{name}")]
    daily = metrics.groupBy(*family.keys, F.to_date("window_start").alias("day")).agg(*sums)
    trailing = (
        Window.partitionBy(*(family.keys or [F.lit(0)]))
        .orderBy(F.unix_date("day"))
        .rangeBetween(1 - span_days, 0)
    )
    over = {c: F.sum(c).over(trailing) for c in daily.columns if c not in (*family.keys, "day")}
    n = F.col("windows").cast("double")
    figures: list[Column] = []
    for name in family.means:
        s, q = F.col(f"s_{name}"), F.col(f"q_{name}")
        # Whole numbers up to here, so that equal values deviate by nothing.
        spread = (F.col("windows") * q - s * s).cast("double")
        figures += [
            (s.cast("double") / n).alias(f"baseline_{name}_avg"),
            F.when(F.col("windows") > 1, F.sqrt(spread / (n * (n - 1)))).alias(f"baseline_{name}_stddev"),
        ]
    for name in family.ratios:
        figures.append(F.coalesce(F.try_divide(f"p_{name}", f"w_{name}"), F.lit(0.0)).alias(f"baseline_{name}_ratio"))
    return daily.withColumns(over).select(
        *family.keys, F.date_add("day", 1).cast("timestamp").alias("valid_from"), "windows", *figures
    )


def with_baselines(
    metrics: DataFrame,
    known: DataFrame,
    family: Family,
    least_windows: int = LEAST_WINDOWS,
    least_deviation: float = LEAST_DEVIATION,
) -> DataFrame:
    """``metrics`` with the baseline columns as of each window's start.

    Where fewer than ``least_windows`` stand behind it, or none is known, the family's fixed
    values hold.
    """
    columns = family.columns()
    own = [c for c in metrics.columns if c not in columns]
    joined = asof_last(metrics.select(*own), known, list(family.keys), "window_start", "valid_from", ["windows", *columns])
    rests = F.coalesce(F.col("windows") >= least_windows, F.lit(False))
    chosen = {}
    for column in columns:
        value = F.greatest(F.col(column), F.lit(least_deviation)) if column.endswith("_stddev") else F.col(column)
        chosen[column] = F.when(rests, value).otherwise(F.lit(family.default(column)))
    return joined.withColumns(chosen).drop("windows")


def entity_metrics(metrics: DataFrame, history: DataFrame, now: Column | None = None, **options) -> DataFrame:
    """Page metrics judged anew by the baselines of ``history``, stored page metrics."""
    return gold.judge_entities(with_baselines(metrics, baselines(history, PAGES), PAGES, **options), None, now)


def user_metrics(metrics: DataFrame, history: DataFrame, now: Column | None = None, **options) -> DataFrame:
    """User metrics judged anew by the baselines of ``history``, stored user metrics."""
    return gold.judge_users(with_baselines(metrics, baselines(history, USERS), USERS, **options), None, now)


def global_metrics(metrics: DataFrame, history: DataFrame, now: Column | None = None, **options) -> DataFrame:
    """Site-wide metrics judged anew by the baselines of ``history``, stored site metrics."""
    return gold.judge_site(with_baselines(metrics, baselines(history, SITE), SITE, **options), None, now)
