"""As-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_last(
    rows: DataFrame,
    facts: DataFrame,
    keys: Sequence[str],
    moment: str,
    valid_from: str,
    columns: Sequence[str],
) -> DataFrame:
    """``rows`` with ``columns`` of the last of ``facts`` that was valid at ``moment``.

    Facts are joined by equal ``keys`` (nulls are equal) and count from ``valid_from`` on,
    that moment included; columns are null where there is none. Both sides meet in one
    shuffle by key and are merged in order of time: no row is paired with all earlier facts.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in rows.columns))
    fact = F.struct(*columns)
    left = rows.select(*keys, F.col(moment).alias("_at"), F.lit(1).alias("_kind"), row.alias("_row"))
    right = facts.where(F.col(valid_from).isNotNull()).select(
        *keys, F.col(valid_from).cast(rows.schema[moment].dataType).alias("_at"), F.lit(0).alias("_kind"), fact.alias("_fact")
    )
    both = left.unionByName(right, allowMissingColumns=True)
    so_far = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    known = F.when(F.col("_at").isNotNull(), F.last("_fact", ignorenulls=True).over(so_far))
    return both.withColumn("_known", known).where("_kind = 1").select("_row.*", *(F.col(f"_known.{c}") for c in columns))
