"""Quality rules with cross-document line frequency (operator 2), built-in functions only.

Each text gives its word statistics and, per line, a hash of the normalised line. A
line is counted once per document and host; copies and near copies of a text (see
:mod:`revwatch.llm.copies`) are one document. Lines above the limit are removed, and a document
left with too small a share of its words is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.columns import computed_once
from revwatch.llm.common import WORD_GAP, let, text_of, words_of, written
from revwatch.llm.copies import held_by_more, shingles, sketch

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # percent of the words
SYMBOLS = r"[#*$%&|<>]"


def _repeated_words(hashes: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, from the windows' hashes."""

    def covered(places: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda a, x: F.struct(
                (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")
            ),
            lambda a: a["n"],
        )

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    def twice(s: Column) -> Column:
        kept = F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1)))
        return F.sort_array(F.transform(kept, lambda x: x["i"]))

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        covered(let(pairs, twice))
    )


def _window_hashes(hashes: Column) -> Column:
    """A hash for each 8-word window, from the words' hashes."""
    windows = F.transform(
        hashes, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + k) for k in range(1, WINDOW)))
    )
    return F.slice(windows, F.lit(1), F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))


def normalised(line: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(line, WORD_GAP, " ")))


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t-\r]")


def text_statistics(docs: DataFrame) -> DataFrame:
    """Counts, sketch, and (hash, words) of each line with a word, from ``text``.

    Word arrays are generator output at each step: so they are computed once, and array
    functions on them run compiled, which lambda bodies do not.
    """

    def of_line(line: Column) -> Column:
        return let(
            normalised(line),
            lambda n: F.struct(F.xxhash64(n).alias("hash"), F.size(F.split(n, " ")).alias("words")),
        )

    text = F.col("text")
    split = computed_once(
        docs, {"t_words": words_of(text), "t_lines": F.filter(F.split(text, "\n"), _has_word)}
    )
    lined = split.select(
        *(c for c in split.columns if c not in ("t_words", "t_lines")),
        F.size("t_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("t_words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("t_lines") - F.size(F.array_distinct("t_lines"))).cast("bigint").alias("n_dup_lines"),
        F.transform("t_lines", of_line).alias("lines"),
        F.transform("t_words", lambda w: F.xxhash64(w)).alias("t_hashes"),
    )
    hashed = computed_once(lined, {"t_hash": F.col("t_hashes")}).drop("t_hashes")
    windows = computed_once(
        hashed, {"t_windows": _window_hashes(F.col("t_hash")), "t_shingles": shingles(F.col("t_hash"))}
    )
    return windows.select(
        *(c for c in lined.columns if c != "t_hashes"),
        F.xxhash64("text").alias("copy"),
        sketch(F.col("t_shingles")).alias("sketch"),
        _repeated_words(F.col("t_windows")).cast("bigint").alias("n_repeat_words"),
    )


def row_key() -> list[Column]:
    """Tells rows of ``docs`` apart, but for repeated ones, which are judged alike."""
    return [F.xxhash64("doc_id", "source", "text").alias("key"), F.hash("text", "doc_id").alias("key2")]


def quality_rules(docs: DataFrame, limit: int = 20, min_share: float = 0.3) -> DataFrame:
    """Statistics, frequent lines and the verdict for ``docs`` (doc_id, text, source).

    A line is frequent on a host (``source``; null is a host of its own) if more than
    ``limit`` distinct documents hold it, near copies counted once. A document is rejected if the base rules fail
    it or if less than ``min_share`` of its words is left without frequent lines. One
    row per input row, repeated rows included; a null text is empty and fails. ``key`` and
    ``key2`` are the row's :func:`row_key`; other columns are ignored.
    """
    found = text_statistics(
        docs.select(
            "doc_id", *row_key(), F.coalesce("source", F.lit("")).alias("host"), text_of().alias("text")
        )
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    stats = written(
        found.drop("text")
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("base_failed", base_failed),
        "quality",
    )

    once = stats.select("host", "copy", F.explode(F.transform("lines", lambda x: x["hash"])).alias("hash"))
    frequent = written(held_by_more(once, stats.select("copy", "sketch"), limit, "host", "hash"), "frequent-lines")
    removed = (
        stats.select("row", "host", F.inline("lines"))
        .join(frequent, ["host", "hash"])
        .groupBy("row")
        .agg(F.sum("words").alias("words_removed"), F.collect_set("hash").alias("frequent"))
    )
    left = F.col("n_words") - F.coalesce("words_removed", F.lit(0))
    return (
        stats.drop("lines", "copy", "sketch")
        .join(removed, "row", "left")
        .select(
            "*",
            left.alias("words_left"),
            (~F.col("base_failed") & (left >= min_share * F.col("n_words"))).alias("kept"),
        )
        .drop("row", "host", "words_removed")
    )


def without_lines(text: Column, frequent: Column) -> Column:
    """The text without the lines whose normalised hash is in ``frequent``."""
    keep = F.filter(
        F.split(text, "\n"),
        lambda line: ~_has_word(line) | ~F.array_contains(frequent, F.xxhash64(normalised(line))),
    )
    return F.when(frequent.isNull(), text).otherwise(F.array_join(keep, "\n"))


def apply_rules(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """``docs`` without rejected rows and frequent lines.

    Only the verdicts that change something meet the texts again, which so are written
    nowhere on the way.
    """
    changes = (
        judged.where(~F.col("kept") | F.col("frequent").isNotNull())
        .select("key", "key2", F.col("kept").alias("q_kept"), F.col("frequent").alias("q_frequent"))
        .dropDuplicates(["key", "key2"])
        .withColumnsRenamed({"key": "q_key", "key2": "q_key2"})
    )
    first, second = row_key()
    return (
        docs.join(changes, (first == F.col("q_key")) & (second == F.col("q_key2")), "left")
        .where(F.coalesce("q_kept", F.lit(True)))
        .withColumn("text", without_lines(F.col("text"), F.col("q_frequent")))
        .drop("q_key", "q_key2", "q_kept", "q_frequent")
    )


def quality_digest(judged: DataFrame) -> DataFrame:
    """The contract's columns from ``quality_rules``."""
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "words_left",
    )
