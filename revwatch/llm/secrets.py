"""Secret scan with multipart credential linking (operator 1), built-in functions only.

Strong parts (``assign``, ``access``, ``hex``) are always reported. Weak parts are
reported only where complementary parts stand within ``reach`` code points in one
scope, a scope being the text between blank lines:

* ``login`` (a user or client id in an assignment) needs a secret,
* ``key`` (a long token of mixed case and digits) needs an access identifier or login,
* ``endpoint`` (a URL of a service) needs both.

The link is an interval semi-join by sweep: parts become rows, and windows over one
document's parts, ordered by place, carry the nearest part of each role from either
side. No pairs are formed, and a row's parts never meet another row's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revwatch.llm.common import let, text_of

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LOGIN = r"""(?i)(client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=@-]+)"""
KEY = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = r"""(?:https?|ftp|wss?|s3|ssh|amqp|redis|mysql|postgresql|mongodb)://[^\x20\t-\r"'<>]+"""
BREAK = r"\n[\x20\t\r]*\n"
MIN_VALUE = 6  # characters of an assigned secret
MIN_LOGIN = 3

#: Order in which parts that start together are listed.
KINDS = ("assign", "access", "hex", "login", "key", "endpoint", "break")
ROLE = {"assign": "s", "hex": "s", "key": "s", "access": "i", "login": "i", "endpoint": "e"}
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"
_BLOCK = 128


def _span(start: Column, rank: Column, end: Column) -> Column:
    return F.struct(
        start.cast("bigint").alias("start"), rank.alias("rank"), end.cast("bigint").alias("end")
    )


def _placed(lengths: Column, rank: int) -> Column:
    """Spans from (gap, size) pairs: running sums in blocks, so that many matches stay cheap."""

    def total(pairs: Column) -> Column:
        return F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, x: a + x["gap"] + x["size"])

    def block(pairs: Column, b: Column) -> Column:
        return F.slice(pairs, b * _BLOCK + 1, F.lit(_BLOCK))

    def spans(pairs: Column, sums: Column, b: Column) -> Column:
        before = F.aggregate(F.slice(sums, F.lit(1), b), F.lit(0).cast("bigint"), lambda a, x: a + x)
        return let(
            before,
            lambda base: let(
                block(pairs, b),
                lambda own: F.transform(
                    own,
                    lambda x, i: let(
                        base + total(F.slice(own, F.lit(1), i)) + x["gap"],
                        lambda at: _span(at, F.lit(rank), at + x["size"]),
                    ),
                ),
            ),
        )

    def placed(pairs: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _BLOCK).cast("int"))
        return let(
            F.transform(blocks, lambda b: total(block(pairs, b))),
            lambda sums: F.flatten(F.transform(sums, lambda _, b: spans(pairs, sums, b))),
        )

    return let(lengths, lambda p: F.when(F.size(p) > 0, placed(p)).otherwise(F.array().cast(SPAN)))


def _matches(
    text: Column,
    kind: str,
    pattern: str,
    group: int = 0,
    keep: Callable[[Column], Column] | None = None,
) -> Column:
    """Spans of the leftmost non-overlapping matches whose ``group`` satisfies ``keep``.

    ``split`` gives what lies between the matches, so lengths add up to places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches)),
        matches,
        lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("size")),
    )
    spans = _placed(pairs, KINDS.index(kind))
    if keep is not None:
        judged = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), keep)
        both = F.zip_with(spans, judged, lambda s, k: F.struct(s.alias("s"), k.alias("k")))
        spans = F.transform(F.filter(both, lambda x: x["k"]), lambda x: x["s"])
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPAN))


def _mixed(value: Column) -> Column:
    """Digits and letters of either case."""
    return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"]),
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, reach: int = 300) -> DataFrame:
    """Secrets in every whole text of ``docs`` (doc_id, text); one row per input row.

    Returns doc_id, ``base`` (spans of the strong parts) and ``linked`` (weak parts that
    complementary parts bear out), both arrays of (start, rank, end) where rank indexes
    ``KINDS``; places are code points, end exclusive. Null and empty texts have none; a
    null doc_id is kept; repeated rows are scanned each by itself; a weak part that
    overlaps a strong one is left out; other columns are ignored.
    """
    text = F.col("text")
    base = docs.select("doc_id", text_of().alias("text")).withColumn(
        "base",
        F.concat(_matches(text, "assign", ASSIGN, 2, lambda v: F.length(v) >= MIN_VALUE), _matches(text, "access", ACCESS), _matches(text, "hex", HEX)),
    )
    weak = F.concat(
        _matches(text, "login", LOGIN, 2, lambda v: F.length(v) >= MIN_LOGIN),
        _matches(text, "key", KEY, 0, _mixed),
        _matches(text, "endpoint", ENDPOINT),
    )
    has_id = text.rlike(f"{ACCESS}|{LOGIN}")
    # Without an identifier nothing weak can be reported.
    parts = F.when(
        has_id,
        let(
            weak,
            lambda w: F.when(F.size(w) > 0, F.concat(F.col("base"), w, _matches(text, "break", BREAK))),
        ),
    )
    rows = (
        base.select("doc_id", "base", parts.alias("parts"))
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "base", F.inline_outer("parts"))
        .repartition("row")
    )
    kind = F.get(F.array(*(F.lit(ROLE.get(k, "b")) for k in KINDS)), F.col("rank"))
    order = [F.col("start"), F.col("rank"), F.col("end")]
    scoped = rows.select("*", kind.alias("role")).withColumn(
        "scope", F.sum((F.col("role") == "b").cast("int")).over(Window.partitionBy("row").orderBy(*order))
    )
    on = Window.partitionBy("row", "scope").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    back = (
        Window.partitionBy("row", "scope")
        .orderBy(*(c.desc() for c in order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    strong = F.col("rank") < KINDS.index("login")

    def near(role: str) -> Column:
        own = F.col("role") == role
        before = F.col("start") - F.max(F.when(own, F.col("end"))).over(on) <= reach
        after = F.min(F.when(own, F.col("start"))).over(back) - F.col("end") <= reach
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    swept = scoped.select(
        "row", "doc_id", "base", *order, "role", strong.alias("strong"),
        near("i").alias("near_id"), near("s").alias("near_secret"),
        F.coalesce(F.max(F.when(strong, F.col("end"))).over(on) > F.col("start"), F.lit(False)).alias("over_left"),
        F.coalesce(F.min(F.when(strong, F.col("start"))).over(back) < F.col("end"), F.lit(False)).alias("over_right"),
    )
    complete = (
        F.when(F.col("role") == "i", F.col("near_secret"))
        .when(F.col("role") == "s", F.col("near_id"))
        .when(F.col("role") == "e", F.col("near_secret") & F.col("near_id"))
        .otherwise(False)
    )
    report = complete & ~F.col("strong") & ~F.col("over_left") & ~F.col("over_right")
    return swept.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("base").alias("base"),
        F.collect_list(F.when(report, _span(F.col("start"), F.col("rank"), F.col("end")))).alias("linked"),
    ).drop("row")


def secret_digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``scan_secrets``."""

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("bigint")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.concat("base", "linked")).alias("spans"),
    )
