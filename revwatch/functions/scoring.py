"""Small expression builders shared by all metric families.

Scores, ladders and flags are written as data (threshold tables, flag lists)
and turned into plain ``CASE WHEN`` / ``concat_ws`` expressions, so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Grades of a 0-100 risk score, best first. Lower bounds are
#: inclusive; any other positive score is LOW and zero is NORMAL.
RISK_GRADES = ((50, "CRITICAL"), (30, "HIGH"), (15, "MEDIUM"))


def count_where(condition: Column) -> Column:
    """Rows for which ``condition`` is true; an unknown condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0))


def ratio(part: str, whole: str, empty: float = 0.0) -> Column:
    """``part / whole``, or ``empty`` when there is nothing to divide by."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(empty))


def zscore(value: str, mean: str, spread: str) -> Column:
    return (F.col(value) - F.col(mean)) / F.col(spread)


def first_match(cases: Sequence[tuple[Column, object]], default: object) -> Column:
    """The value of the first true case (``CASE WHEN ... ELSE default``)."""
    (condition, value), *rest = cases
    chain = F.when(condition, F.lit(value))
    for condition, value in rest:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def points(value: Column, table: Sequence[tuple[float, int]]) -> Column:
    """Points of the highest bound that ``value`` exceeds (bounds are exclusive)."""
    return first_match([(value > bound, score) for bound, score in table], 0)


def total(parts: Sequence[Column]) -> Column:
    result = parts[0]
    for part in parts[1:]:
        result = result + part
    return result


def risk_grade(score: str) -> Column:
    cases = [(F.col(score) >= bound, name) for bound, name in RISK_GRADES]
    return first_match([*cases, (F.col(score) > 0, "LOW")], "NORMAL")


def one_decimal(value: Column) -> Column:
    return F.round(value, 1)


def percent(value: Column) -> Column:
    return F.concat(one_decimal(value * 100), F.lit("%"))


@dataclass(frozen=True)
class Flag:
    """An anomaly flag: its column, its short tag, when it is raised and what it says."""

    column: str
    tag: str
    raised: Column
    says: Column


def flag_columns(flags: Sequence[Flag]) -> dict[str, Column]:
    return {flag.column: flag.raised for flag in flags}


def flag_summary(flags: Sequence[Flag]) -> dict[str, Column]:
    """``anomaly_types`` (empty text when none is raised) and ``is_anomaly``."""
    raised = [F.col(flag.column) for flag in flags]
    either = raised[0]
    for other in raised[1:]:
        either = either | other
    return {
        "anomaly_types": F.concat_ws(", ", *(F.when(F.col(f.column), F.lit(f.tag)) for f in flags)),
        "is_anomaly": either,
    }


def flag_explanation(flags: Sequence[Flag]) -> Column:
    spoken = F.concat_ws(" | ", *(F.when(F.col(flag.column), flag.says) for flag in flags))
    return F.when(~F.col("is_anomaly"), F.lit("Normal activity")).otherwise(spoken)
