"""Column profile of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)


def _numeric(field) -> bool:
    return isinstance(field.dataType, NumericType)


def _plain(field) -> bool:
    return field.dataType.typeName() not in ("struct", "array", "map", "variant")


def column_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    exact_distinct: bool = False,
    quantiles: Sequence[float] = QUANTILES,
    accuracy: int = 1_000,
) -> DataFrame:
    """One row per column: type, counts, distinct values, range, moments, quantiles.

    A nested column (struct, array, map, variant) has its type and counts alone.

    All columns are measured in one aggregation whose single result row is then
    unpivoted. With the approximate distinct count the state is of fixed size;
    the exact one goes through the value counts, which shuffle.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    measures = [F.count("*").alias("rows")]
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        measures.append(F.count(column).alias(f"n_{i}"))
        if not _plain(field):
            continue
        measures += [F.min(column).alias(f"lo_{i}"), F.max(column).alias(f"hi_{i}")]
        if not exact_distinct:
            measures.append(F.approx_count_distinct(column).alias(f"d_{i}"))
        if _numeric(field):
            measures += [F.avg(column).alias(f"mean_{i}"), F.stddev(column).alias(f"std_{i}")]
            if quantiles:
                measures.append(
                    F.percentile_approx(column.cast("double"), list(quantiles), accuracy).alias(f"q_{i}")
                )
    nothing = F.lit(None).cast("double")
    lines = []
    for i, field in enumerate(fields):
        number = _numeric(field)
        count, plain = F.col(f"n_{i}"), _plain(field)
        no_count, no_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")
        lines.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column_name"),
                F.lit(field.dataType.simpleString()).alias("data_type"),
                F.col("rows"),
                count.alias("present"),
                (F.col("rows") - count).alias("missing"),
                (F.col(f"d_{i}") if plain and not exact_distinct else no_count).alias("distinct_values"),
                (F.col(f"lo_{i}").cast("string") if plain else no_text).alias("min_value"),
                (F.col(f"hi_{i}").cast("string") if plain else no_text).alias("max_value"),
                (F.col(f"mean_{i}").cast("double") if number else nothing).alias("mean"),
                (F.col(f"std_{i}").cast("double") if number else nothing).alias("stddev"),
                (F.col(f"q_{i}") if number and quantiles else F.lit(None).cast("array<double>")).alias("quantiles"),
            )
        )
    profile = df.agg(*measures).select(F.inline(F.array(*lines)))
    if not exact_distinct:
        return profile
    counted = value_counts(df, [f.name for f in fields]).filter("value IS NOT NULL")
    distinct = counted.groupBy("column_name").agg(F.count("*").alias("_d"))
    return (
        profile.join(distinct, "column_name", "left")
        .withColumn(
            "distinct_values",
            F.when(F.col("column_name").isin([f.name for f in fields if _plain(f)]), F.coalesce("_d", F.lit(0).cast("bigint"))),
        )
        .select(*profile.columns)
    )


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value, n)`` for every value of every plain column.

    The table is unpivoted and counted with partial aggregation, so a value that
    fills a third of a column crosses the shuffle once per map task.
    """
    names = [f.name for f in df.schema.fields if (columns is None or f.name in columns) and _plain(f)]
    pairs = F.array(
        *(
            F.struct(F.lit(n).alias("column_name"), F.col(f"`{n}`").cast("string").alias("value"))
            for n in names
        )
    )
    return df.select(F.inline(pairs)).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column (ties in text order).

    The rank filter plans a group limit below the shuffle: each task sends at most
    ``k`` values of a column on.
    """
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), F.asc("value"))
    counted = value_counts(df, columns).filter("value IS NOT NULL")
    return counted.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
