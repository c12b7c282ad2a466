"""Helpers that shape how columns are computed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns, such as parsed JSON, computed once per row.

    A filter on a computed column is pushed below the computation by repeating
    the computation in the filter, once per condition. Here the columns are the
    output of a generator (one row in, one row out), which filters stay above.
    """
    row = F.struct(*(column.alias(name) for name, column in columns.items()))
    return df.select("*", F.inline_outer(F.array(row)))
