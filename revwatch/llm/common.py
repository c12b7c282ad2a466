"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.session import shared_folder

#: A word is a run of anything but ASCII white space.
WORD_GAP = r"[ \t-\r]+"


def importable(spark: SparkSession) -> SparkSession:
    """Lets Python workers look for the package where the driver found it.

    That serves local runs from any folder; on a cluster the package is installed or
    sent along with ``--py-files``.
    """
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    root = str(Path(__file__).resolve().parents[2])
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe if an executor is lost."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row.

    Inside ``transform`` or ``filter`` an outer expression is evaluated for each
    element; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_of(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: ASCII letters in lower case, digits and all other bytes above ASCII kept, the rest blank.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def folded_words(text: str | None) -> list[bytes]:
    """Lower-cased words as UTF-8; bytes beyond ASCII never part words."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
