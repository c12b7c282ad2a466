"""Mergeable column profiles."""

import datetime as dt
import hashlib
import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from revwatch.operators import profile, profile_states

KIND = "part string, i int, big long, d double, m decimal(20,3), t string, f boolean, day date, nested array<int>"


def rows(spark, n=4000):
    r = random.Random(3)
    out = []
    for at in range(n):
        null = at % 13 == 0
        out.append(
            (
                r.choice("abc"),
                None if null else r.randrange(-50, 50),
                (1 << 40) + at,
                math.nan if at % 97 == 0 else r.gauss(1e6, 3),
                Decimal(at) / 8,
                r.choice(("x", "y", "z", "", "long " * 100, f"v{at}")),
                None if null else at % 3 == 0,
                dt.date(2024, 1, 1) + dt.timedelta(at % 40),
                [at],
            )
        )
    return spark.createDataFrame(out, KIND)


EXACT = ("column_name", "data_type", "rows", "present", "missing", "min_value", "max_value")


def test_parts_merge_to_the_whole(spark, tmp_path):
    table = rows(spark)
    states = profile_states.profile_states(table, keys=["part"])
    states.write.parquet(f"{tmp_path}/states")
    kept = spark.read.parquet(f"{tmp_path}/states")
    twice = profile_states.merge_states(profile_states.merge_states(kept, ["part"]).drop("part"))
    names = [c for c in table.columns if c != "part"]
    whole = {r.column_name: r for r in profile.column_profile(table, names, exact_distinct=True).collect()}
    for merged in (profile_states.profile(kept), profile_states.profile(twice)):
        found = {r.column_name: r for r in merged.collect()}
        assert list(found) == names
        for name, line in found.items():
            for column in EXACT:
                assert line[column] == whole[name][column], (name, column)
            if whole[name].distinct_values is not None:
                assert abs(line.distinct_values - whole[name].distinct_values) <= max(1, 0.064 * whole[name].distinct_values)
            for figure in ("mean", "stddev"):
                ours, theirs = line[figure], whole[name][figure]
                assert (ours is None) == (theirs is None)
                if ours is not None and not math.isnan(theirs):
                    assert ours == pytest.approx(theirs, rel=1e-6)


def test_quantiles_of_merged_sketches_keep_their_rank(spark):
    table = spark.range(50_000).select(F.col("id").alias("x"), (F.col("id") % 7).alias("part"))
    merged = profile_states.profile(profile_states.profile_states(table, ["x"], ["part"])).first()
    for at, value in zip(profile.QUANTILES, merged.quantiles):
        assert abs(value / 50_000 - at) <= 2 * profile_states.RANK_ERROR


def test_frequent_values_beyond_what_is_tracked(spark):
    """Two heavy values among 20,000 single ones; a long text goes under its digest."""
    text = "t" * 500
    value = F.when(F.col("id") % 4 == 0, F.lit("heavy")).when(F.col("id") % 5 == 0, F.lit(text)).otherwise(F.col("id").cast("string"))
    table = spark.range(40_000).select(value.alias("v"), (F.col("id") % 3).alias("part"))
    states = profile_states.profile_states(table, keys=["part"])
    found = {r.value: r.n for r in profile_states.frequent_values(states, 0.05).collect()}
    assert set(found) == {"heavy", "md5:" + hashlib.md5(text.encode()).hexdigest()}
    assert abs(found["heavy"] - 10_000) <= 40_000 * profile_states.COUNT_ERROR
    with pytest.raises(ValueError, match="more than"):
        profile_states.frequent_values(states, 0.001, k=10)


def test_one_aggregation_and_empty_tables(spark):
    table = rows(spark, 50)
    assert plan(profile_states.profile_states(table)).count("Exchange") == 1
    none = profile_states.profile(profile_states.profile_states(table.limit(0)))
    assert {(r.rows, r.present, r.min_value, r.quantiles) for r in none.collect()} == {(0, 0, None, None)}
    assert profile_states.frequent_values(profile_states.profile_states(table.limit(0))).count() == 0
