"""A training-data pipeline over ``documents``, one operator per stage.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over all that the stage before kept; all
but the last return the columns of ``documents``. Documents may have null texts, repeated
rows, any number of further columns, and may be none at all; see the operators for what each
makes of these.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.llm.common import importable, table, written
from revwatch.llm.decontaminate import find_contamination
from revwatch.llm.packing import pack
from revwatch.llm.quality import apply_rules, quality_rules
from revwatch.llm.simhash import near_duplicates
from revwatch.llm.templates import drop_templates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_REST = ("lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it now is."""
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", length).select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others lose the lines that are frequent on their host."""
    return _documents(apply_rules(docs.select(*COLUMNS), quality_rules(docs)))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go."""
    return _documents(drop_templates(docs, carry=_REST))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of least doc_id."""
    importable(spark)
    return _documents(near_duplicates(docs, carry=("text", *_REST)).where("first"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=("text", *_REST))
    return _documents(found.where("n_hit = 0"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 4096 tokens."""
    importable(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: SQL expresses neither fingerprints nor packing; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
