"""Line dedup through a log-template tree of fixed depth (operator 6), built-in functions only.

A line descends by its number of tokens and its leading tokens, where tokens with a digit
are variable from the start. In a leaf, a place that more than ``fanout`` different
tokens fill is variable as well; what is left constant is the line's template. Templates
with enough constant tokens that occur in more than ``limit`` distinct documents recur, and
their lines are dropped.

Copies and near copies of a text (see :mod:`revwatch.llm.copies`) count as one document.
Counting comes first and on hashes; tokens are looked at only in leaves that enough different
texts share, which is never fewer than the documents of any of their templates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.columns import computed_once
from revwatch.llm.common import WORD_GAP, text_of, written
from revwatch.llm.copies import held_by_more, shingles, sketch

DEPTH = 3  # leading tokens
FANOUT = 10
LIMIT = 10
MIN_CONSTANT = 0.5
VARIABLE = "<*>"
_DIGITS = r"[^ ]*[0-9][^ ]*"
_DIGITS_OF_LINES = r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*"


def normalised(line: Column) -> Column:
    """Tokens parted by single blanks, lower-case, those with a digit masked."""
    plain = F.lower(F.btrim(F.regexp_replace(line, WORD_GAP, " ")))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, _DIGITS, VARIABLE)).otherwise(plain)


def _leaf(tokens: Column) -> Column:
    """Number of tokens and the leading ones; the root's children are the numbers."""
    return F.xxhash64(F.octet_length(tokens) - F.octet_length(F.replace(tokens, F.lit(" "), F.lit(""))), F.substring_index(tokens, " ", DEPTH))


def _with_lines(texts: DataFrame) -> DataFrame:
    """Adds the words' hashes and, per line, ``lines`` (leaf, hash) of :func:`normalised`, from ``text``.

    A whole text is normalised at once, and split at single characters, which needs no pattern.
    """

    def hashed(line: Column) -> Column:
        return F.transform(
            F.array(F.btrim(line)),
            lambda t: F.struct(
                F.when(t != "", _leaf(t)).alias("leaf"), F.when(t != "", F.xxhash64(t)).alias("hash")
            ),
        )[0]

    # Few texts have digits or other blanks; all that are read once for them.
    rare, text = F.col("t_rare"), text_of()
    looked = computed_once(texts, {"t_rare": text.rlike("[0-9\t\x0b\f\r]")})
    spaced = computed_once(looked, {"t_spaced": F.when(rare, F.regexp_replace(text, "[\t\x0b\f\r]", " ")).otherwise(text)})
    plain = F.col("t_spaced")
    single = F.when(F.contains(plain, F.lit("  ")), F.regexp_replace(plain, " {2,}", " ")).otherwise(plain)
    masked = F.when(rare, F.regexp_replace(F.lower(single), _DIGITS_OF_LINES, VARIABLE)).otherwise(F.lower(single))
    words = F.array_remove(F.split(F.replace(plain, F.lit("\n"), F.lit(" ")), " "), "")
    found = {
        "lines": F.transform(F.split(masked, "\n"), hashed),
        "word_hashes": F.transform(words, lambda w: F.xxhash64(w)),
    }
    return computed_once(spaced, found).drop("t_rare", "t_spaced")


def find_templates(base: DataFrame, limit: int, fanout: int, min_constant: float) -> DataFrame:
    """(leaf, hash) of the lines whose template recurs, from ``base`` (copy, sketch, text, lines)."""
    rows = base.select("copy", F.inline(F.array_distinct("lines"))).where("leaf is not null")
    leaves = (
        rows.select("leaf", "copy").distinct().groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("leaf")
    )
    leaves = written(leaves, "template-leaves")
    held = base.select(
        "copy",
        F.inline(
            F.zip_with(
                "lines",
                F.split("text", "\n"),
                lambda x, line: F.struct(x["leaf"].alias("leaf"), x["hash"].alias("hash"), line.alias("line")),
            )
        ),
    ).where("leaf is not null")
    # One row for each line and text.
    found = written(
        held.join(leaves, "leaf").groupBy("leaf", "hash", "copy").agg(F.min("line").alias("line")),
        "template-lines",
    )
    lines = found.groupBy("leaf", "hash").agg(F.min("line").alias("line"))
    tokens = written(
        lines.select("leaf", "hash", F.posexplode(F.split(normalised(F.col("line")), " ")).alias("place", "token")),
        "template-tokens",
    )
    values = tokens.groupBy("leaf", "place", "token").agg(F.lit(1).alias("one"))
    variable = (
        values.groupBy("leaf", "place").agg(F.count("*").alias("n")).where(F.col("n") > fanout).select("leaf", "place", F.lit(True).alias("varies"))
    )
    constant = ~(F.coalesce("varies", F.lit(False)) | (F.col("token") == VARIABLE))
    template = (
        tokens.join(variable, ["leaf", "place"], "left")
        .groupBy("leaf", "hash")
        .agg(
            F.avg(constant.cast("int")).alias("share"),
            F.sort_array(
                F.collect_list(F.struct("place", F.when(constant, F.col("token")).otherwise(VARIABLE).alias("token")))
            ).alias("tokens"),
        )
        .where(F.col("share") >= min_constant)
        .select("leaf", "hash", F.xxhash64("leaf", "tokens").alias("template"))
    )
    template = written(template, "templates")
    of_documents = found.join(template, ["leaf", "hash"]).select("template", "copy")
    recurring = held_by_more(of_documents, base.select("copy", "sketch"), limit, "template")
    return template.join(recurring, "template").select("leaf", "hash")


def drop_templates(
    docs: DataFrame,
    limit: int = LIMIT,
    fanout: int = FANOUT,
    min_constant: float = MIN_CONSTANT,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` (doc_id, text) without the lines of recurring templates; one row per input row.

    Returns doc_id, the columns of ``carry``, text, n_lines (lines with a token) and
    n_dropped. A null text stays null and counts no lines; blank lines stay; repeated rows
    are one document in the counts and are cleaned alike; an empty table gives no rows.
    Other columns are ignored.
    """
    kept = [c for c in carry if c not in ("doc_id", "text")]
    wanted = docs.select("doc_id", *(F.col(c).alias(f"carry_{c}") for c in kept), "text")
    base = written(
        _with_lines(wanted).select(
            *wanted.columns,
            F.xxhash64(text_of()).alias("copy"),
            sketch(shingles(F.col("word_hashes"))).alias("sketch"),
            "lines",
            F.monotonically_increasing_id().alias("row"),
        ),
        "template-base",
    )
    dropped = written(find_templates(base, limit, fanout, min_constant), "template-drops")
    cut = (
        base.select("row", F.inline(F.array_distinct("lines")))
        .join(dropped, ["leaf", "hash"])
        .groupBy("row")
        .agg(F.collect_set("hash").alias("cut"))
    )
    gone = F.filter("lines", lambda x: F.array_contains(F.col("cut"), x["hash"]))
    left = F.transform(
        F.filter(
            F.zip_with(F.split("text", "\n"), "lines", lambda t, x: F.struct(t.alias("t"), x["hash"].alias("hash"))),
            lambda x: x["hash"].isNull() | ~F.array_contains(F.col("cut"), x["hash"]),
        ),
        lambda x: x["t"],
    )
    joined = base.join(cut, "row", "left")
    return joined.select(
        "doc_id",
        *(F.col(f"carry_{c}").alias(c) for c in kept),
        F.when(F.col("cut").isNull(), F.col("text")).otherwise(F.array_join(left, "\n")).alias("text"),
        F.size(F.filter("lines", lambda x: x["hash"].isNotNull())).cast("bigint").alias("n_lines"),
        F.when(F.col("cut").isNull(), F.lit(0)).otherwise(F.size(gone)).cast("bigint").alias("n_dropped"),
    )
