"""Classes of copies and near copies, for counts of distinct documents; built-in functions only.

A text's sketch is the ``SKETCH`` least hashes of its 3-word shingles. Texts that share one of
their ``KEYS`` least hashes with others are held against the least text of that hash, and
linked to it if their shingles' Jaccard similarity, as the sketches estimate it, reaches
``SIMILAR``. So texts that have a common word, line or passage, but differ otherwise, are never
one class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.llm.common import written

SHINGLE = 3
SKETCH = 64
KEYS = 6
SIMILAR = 0.75


def shingles(hashes: Column) -> Column:
    """A hash for each run of ``SHINGLE`` words, from the words' hashes; the last ones are shorter."""
    return F.transform(hashes, lambda h, i: F.hash(h, *(F.get(hashes, i + k) for k in range(1, SHINGLE))))


def sketch(shingled: Column) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingled)), 1, SKETCH)


def _similar(a: Column, b: Column) -> Column:
    least = F.slice(F.sort_array(F.array_union(a, b)), 1, SKETCH)
    return F.size(F.array_intersect(least, F.array_intersect(a, b))) >= SIMILAR * F.size(least)


def near_copies(texts: DataFrame) -> DataFrame:
    """(copy, class) of the texts that are near copies of others, from (copy, sketch), one row each.

    ``copy`` names a text, so exact copies have one; all others are a class of their own.
    """
    keyed = texts.select("copy", F.explode(F.slice("sketch", 1, KEYS)).alias("key"))
    shared = (
        keyed.groupBy("key")
        .agg(F.min("copy").alias("least"), F.max("copy").alias("last"))
        .where("least < last")
        .select("key", "least")
    )
    pairs = written(keyed.join(shared, "key").where("copy <> least").select("copy", "least").distinct(), "near-pairs")
    involved = pairs.select(F.explode(F.array("copy", "least")).alias("copy")).distinct()
    sketches = written(texts.join(involved, "copy", "left_semi"), "near-sketches")
    other = sketches.select(F.col("copy").alias("least"), F.col("sketch").alias("other"))
    links = written(
        pairs.join(sketches, "copy")
        .join(other, "least")
        .where(_similar(F.col("sketch"), F.col("other")))
        .groupBy("copy")
        .agg(F.min("least").alias("class")),
        "near-links",
    )
    # A text's link may itself be linked on.
    onward = links.select(F.col("copy").alias("class"), F.col("class").alias("next"))
    return links.join(onward, "class", "left").select("copy", F.coalesce("next", "class").alias("class"))


def held_by_more(held: DataFrame, texts: DataFrame, limit: int, *keys: str) -> DataFrame:
    """The ``keys`` that more than ``limit`` distinct documents hold, from ``held`` (keys, copy).

    Near copies count once. ``texts`` has (copy, sketch) of each text; only those of keys that
    more than ``limit`` different texts hold are looked at.
    """
    once = held.select(*keys, "copy").distinct()
    many = written(once.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > limit).select(*keys), "held-by-many")
    holders = written(held.select(*keys, "copy").join(many, [*keys]).distinct(), "holders")
    # Exact copies are put together before they meet, in each task.
    sketches = written(
        texts.dropDuplicates(["copy"]).join(holders.select("copy").distinct(), "copy", "left_semi"), "copy-sketches"
    )
    near = written(near_copies(sketches), "near-copies")
    return (
        holders.join(near, "copy", "left")
        .select(*keys, F.coalesce("class", "copy").alias("class"))
        .distinct()
        .groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > limit)
        .select(*keys)
    )
