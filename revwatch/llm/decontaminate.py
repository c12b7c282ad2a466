"""Benchmark decontamination with one Aho-Corasick automaton (operator 3).

Every window of ten consecutive item words is a pattern; the automaton holds them all and
reads each normalised text once. Hits are word intervals, mapped back to code points of
the original text. Items go to the workers in blocks of bounded size: a benchmark that
fits in one block, as usual, needs a single pass; a larger one is a stated query set that
is run block by block against all rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import folded_words, written

WINDOW = 10
#: Characters of item text per automaton: about 2 GB of nodes at the most.
BLOCK_CHARS = 4_000_000

#: Words in the original text, where capitals are not yet lower-cased.
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
HITS = T.ArrayType(
    T.StructType(
        [T.StructField(n, T.LongType()) for n in ("first", "last", "start", "end")]
    )
)


def item_windows(text: str | None) -> set[bytes]:
    words = folded_words(text)
    last = max(len(words) - WINDOW, 0)
    return {b" ".join(words[i : i + WINDOW]) for i in range(last + 1)} if words else set()


def _automaton(items: list[tuple[str | None, str | None]]):
    """The automaton over a block's windows, each with its length in words and its items."""
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for window in item_windows(text):
            own = owners.setdefault(window, set())
            if item is not None:
                own.add(item)
    if not owners:
        return None
    built = ahocorasick.Automaton()
    for window, own in owners.items():
        # A blank on either side keeps matches to whole words.
        built.add_word(f" {window.decode('latin-1')} ", (window.count(b" ") + 1, tuple(own)))
    built.make_automaton()
    return built


@lru_cache(maxsize=1)
def _built(block: Broadcast):
    return _automaton(block.value)


def find_hits(text: str | None, automaton) -> tuple[int, list[tuple[int, int, int, int]], list[str]]:
    """Words, merged hit intervals as (first, last word, start, end), and the items found."""
    words = folded_words(text)
    if automaton is None or not words:
        return len(words), [], []
    line = f" {b' '.join(words).decode('latin-1')} "
    found = [(end, *value) for end, value in automaton.iter(line)]
    if not found:
        return len(words), [], []
    ends = {}
    at = 0
    for i, word in enumerate(words):
        at += len(word) + 1
        ends[at] = i
    merged: list[list[int]] = []
    for first, last in sorted((ends[end] - n + 1, ends[end]) for end, n, _ in found):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    places = [m.span() for m in _WORD.finditer(text)]
    hits = [(a, b, places[a][0], places[b][1]) for a, b in merged]
    return len(words), hits, sorted({item for _, _, own in found for item in own})


def _scan(keyed: DataFrame, block: Broadcast) -> DataFrame:
    schema = T.StructType(
        [
            *keyed.schema.fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("hits", HITS),
            T.StructField("items", T.ArrayType(T.StringType())),
        ]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _built(block)
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "end")]))
        for batch in batches:
            found = [find_hits(t.as_py(), automaton) for t in batch.column("text")]
            hits = [[dict(zip(("first", "last", "start", "end"), h, strict=True)) for h in x[1]] for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in batch.schema.names),
                    pa.array([x[0] for x in found], pa.int64()),
                    pa.array(hits, kind),
                    pa.array([x[2] for x in found], pa.list_(pa.string())),
                ],
                names=[*batch.schema.names, "n_words", "hits", "items"],
            )

    return keyed.mapInArrow(scan, schema)


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[str | None, str | None]]]:
    block, size = [], 0
    for item, text in benchmark.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        block.append((item, text))
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _hit_words(hits: Column) -> Column:
    """Words in the union of intervals."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).cast("bigint").alias("last"))
    return F.aggregate(
        F.sort_array(hits),
        start,
        lambda a, x: F.struct(
            (a["n"] + F.greatest(x["last"] - F.greatest(x["first"] - 1, a["last"]), F.lit(0))).alias("n"),
            F.greatest(a["last"], x["last"]).alias("last"),
        ),
        lambda a: a["n"],
    )


def find_contamination(docs: DataFrame, benchmark: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Benchmark windows in every whole text of ``docs`` (doc_id, text); one row per input row.

    Returns doc_id, the columns of ``carry``, n_words, n_hit, ``hits`` (word and code point
    intervals; end exclusive for code points) and ``items``. Null and empty texts have no
    words; a null benchmark text has no window; the windows of an item without an id count
    as hits but name no item; rows that repeat an item_id are one item; an empty benchmark
    hits nothing. Other columns are ignored.
    """
    spark = docs.sparkSession
    wanted = docs.select("doc_id", "text", *(c for c in carry if c not in ("doc_id", "text")))
    kept = [c for c in wanted.columns if c == "doc_id" or c in carry]
    blocks = _blocks(benchmark)
    first = next(blocks, [])
    second = next(blocks, None)
    if second is None:
        found = _scan(wanted, spark.sparkContext.broadcast(first))
    else:
        keyed = written(wanted.withColumn("c_row", F.monotonically_increasing_id()), "decontaminate")
        parts = [_scan(keyed.select("c_row", "text"), spark.sparkContext.broadcast(first))]
        while second is not None:
            parts.append(_scan(keyed.select("c_row", "text"), spark.sparkContext.broadcast(second)))
            second = next(blocks, None)
        every = parts[0].drop("text")
        for part in parts[1:]:
            every = every.unionAll(part.drop("text"))
        merged = every.groupBy("c_row").agg(
            F.first("n_words").alias("n_words"),
            F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        )
        found = keyed.join(merged, "c_row").drop("c_row")
    return found.select(*kept, "n_words", _hit_words(F.col("hits")).alias("n_hit"), "hits", "items")


def contamination_digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_contamination``."""
    items = F.sort_array(F.array_distinct("items"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
