"""Column profiles that can be merged: a row of states per batch, file or date.

A state holds counts, extremes, moments and three sketches per column: HyperLogLog for
distinct values, KLL for quantiles and a frequent-items sketch for the commonest values.
Each is of bounded size and merges with others of its kind, so a table that grows is
profiled by its new part alone; the whole is never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.operators.profile import QUANTILES, _numeric, _plain

#: Accuracy of the sketches: registers as a power of two (1.6 % standard error), the size
#: of a quantile sketch (ranks within 0.3 %), and values tracked (counts are exact for columns
#: of fewer distinct values, else short by at most 0.1 % of the rows).
LOG_REGISTERS, QUANTILE_SIZE, TRACKED = 12, 1_600, 4_096
RANK_ERROR, COUNT_ERROR, DISTINCT_ERROR = 0.003, 0.001, 0.016
#: A longer text is tracked under its digest.
LONGEST_VALUE = 200

_PREFIX = "s_"
_DIRECT = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def _value(column: Column) -> Column:
    text = column.cast("string")
    return F.when(F.length(text) <= LONGEST_VALUE, text).otherwise(F.concat(F.lit("md5:"), F.md5(text.cast("binary"))))


def _state(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    parts = [F.count(column).alias("n"), F.lit(field.dataType.simpleString()).alias("kind")]
    if _plain(field):
        counted = column if isinstance(field.dataType, _DIRECT) else column.cast("string")
        parts += [
            F.min(column).alias("lo"),
            F.max(column).alias("hi"),
            F.hll_sketch_agg(counted, LOG_REGISTERS).alias("distinct"),
            F.call_function("approx_top_k_accumulate", _value(column), F.lit(TRACKED)).alias("top"),
        ]
    if _numeric(field):
        number = column.cast("double")
        known = F.when(~F.isnan(number), number)
        parts += [
            F.avg(number).alias("mean"),
            (F.var_pop(number) * F.count(number)).alias("spread"),
            F.kll_sketch_agg_double(known, F.lit(QUANTILE_SIZE)).alias("ranks"),
        ]
    return F.struct(*parts).alias(_PREFIX + field.name)


def profile_states(df: DataFrame, columns: Sequence[str] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """One row of column states, or one per key, in a single aggregation.

    A nested column has its type and count alone. Keys are not profiled unless named.
    """
    names = columns if columns is not None else [c for c in df.columns if c not in keys]
    fields = [f for f in df.schema.fields if f.name in names]
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), *map(_state, fields))


def _moments(n: Column, mean: Column, spread: Column) -> Column:
    """Mean and sum of squared deviations of all parts, added up one after another.

    Sums of squares would cancel where values are large and near each other. The list
    holds three numbers per merged state, whatever the number of rows behind it.
    """
    parts = F.sort_array(F.collect_list(F.when(n > 0, F.struct(n.alias("n"), mean.alias("mean"), spread.alias("spread")))))

    def added(a: Column, x: Column) -> Column:
        n, apart = a["n"] + x["n"], x["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * x["n"] / n).alias("mean"),
            (a["spread"] + x["spread"] + apart * apart * a["n"] * x["n"] / n).alias("spread"),
        )

    first = F.get(parts, F.lit(0))
    return F.when(first.isNotNull(), F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), first, added))


def merge_states(states: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """States of the union of what ``states`` were taken from, optionally per key."""
    merged = []
    for field in states.schema.fields:
        if not field.name.startswith(_PREFIX):
            continue
        own = set(field.dataType.fieldNames())
        at = lambda name: F.col(f"`{field.name}`.`{name}`")  # noqa: B023, E731
        n = F.sum(at("n"))
        parts = [n.alias("n"), F.max(at("kind")).alias("kind")]
        if "lo" in own:
            parts += [
                F.min(at("lo")).alias("lo"),
                F.max(at("hi")).alias("hi"),
                F.hll_union_agg(at("distinct")).alias("distinct"),
                F.call_function("approx_top_k_combine", at("top")).alias("top"),
            ]
        if "mean" in own:
            moments = _moments(at("n"), at("mean"), at("spread"))
            parts += [
                moments["mean"].alias("mean"),
                moments["spread"].alias("spread"),
                F.kll_merge_agg_double(at("ranks")).alias("ranks"),
            ]
        merged.append(F.struct(*parts).alias(field.name))
    return states.groupBy(*keys).agg(F.sum("rows").alias("rows"), *merged)


def profile(states: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """The profile of all rows behind ``states``: one row per column."""
    whole = merge_states(states)
    lines = []
    fields = [f for f in whole.schema.fields if f.name.startswith(_PREFIX)]
    for i, field in enumerate(fields):
        own = set(field.dataType.fieldNames())
        at = lambda name: F.col(f"`{field.name}`.`{name}`")  # noqa: B023, E731
        plain, number = "lo" in own, "mean" in own
        null = lambda kind: F.lit(None).cast(kind)
        ranks = F.when(
            F.kll_sketch_get_n_double(at("ranks")) > 0,
            F.kll_sketch_get_quantile_double(at("ranks"), F.array(*(F.lit(float(q)) for q in quantiles))),
        ) if number and quantiles else null("array<double>")
        lines.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name.removeprefix(_PREFIX)).alias("column_name"),
                at("kind").alias("data_type"),
                F.col("rows"),
                at("n").alias("present"),
                (F.col("rows") - at("n")).alias("missing"),
                (F.hll_sketch_estimate(at("distinct")) if plain else null("bigint")).alias("distinct_values"),
                (at("lo").cast("string") if plain else null("string")).alias("min_value"),
                (at("hi").cast("string") if plain else null("string")).alias("max_value"),
                (at("mean") if number else null("double")).alias("mean"),
                (F.when(at("n") > 1, F.sqrt(at("spread") / (at("n") - 1))) if number else null("double")).alias("stddev"),
                ranks.alias("quantiles"),
            )
        )
    return whole.select(F.inline(F.array(*lines)))


def frequent_values(states: DataFrame, share: float = 0.01, k: int = 100) -> DataFrame:
    """Values that hold at least ``share`` of the rows: ``column_name``, ``value``, ``n``.

    At most ``k`` per column, which has to be as many as can hold such a share.
    """
    if k * share < 1:
        raise ValueError(f"{round(1 / share)} values can hold {share} of the rows each, more than {k}")
    whole = merge_states(states)
    names = [f.name for f in whole.schema.fields if f.name.startswith(_PREFIX) and "top" in f.dataType.fieldNames()]
    top = [
        F.transform(
            F.call_function("approx_top_k_estimate", F.col(f"`{name}`.top"), F.lit(k)),
            lambda x: F.struct(
                F.lit(name.removeprefix(_PREFIX)).alias("column_name"),  # noqa: B023
                x["item"].alias("value"),
                x["count"].alias("n"),
            ),
        )
        for name in names
    ]
    return whole.select("rows", F.inline(F.flatten(F.array(*top)))).where(F.col("n") >= share * F.col("rows")).drop("rows")
