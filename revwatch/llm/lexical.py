"""Ranked lexical search over a length-stratified index (operator 13).

Documents of one normaliser ``m`` form a stratum. Within it postings are kept by term and
occurrences, so a posting list has one impact, computed once. A stratum bounds the score of
its documents for each item by the impact of each term's largest occurrence count. The
strata of highest bounds are visited first; their scores give each item a score that the
others must reach, and strata whose bound stays below are not opened for that item.

Strata are held in index rows of bounded size, sorted by ``m`` across partitions of even size,
so neither a length that many documents share nor a frequent term gathers in one task.
Items come in blocks of bounded size, which alone are broadcast.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import folded_words, written

TOP = 20
#: Characters of item texts in a block.
BLOCK_CHARS = 4_000_000
#: Documents and postings of an index row; a stratum takes as many rows as it needs.
ROW_DOCS, ROW_POSTINGS = 2_048, 1 << 15
#: Index rows of highest bound opened for each item before all others.
FIRST = 8
#: Characters of a text that are taken to words at once.
_PIECE = 1 << 20
#: Pairs of document and item that are added up at once.
_ADDED = 1 << 21

_LISTS = ("terms", "tfs", "starts", "docs")


def term_counts(text: str | None) -> Counter[bytes]:
    """Occurrences of each term in the whole text, taken piece by piece."""
    text = text or ""
    counts: Counter[bytes] = Counter()
    at = 0
    while at < len(text):
        end = at + _PIECE
        if end < len(text):
            # A cut between two characters of a term would make two of it.
            while end < len(text) and (text[end].isalnum() or text[end] > "\x7f"):
                end += 1
        counts.update(folded_words(text[at:end]))
        at = end
    return counts


@dataclass
class Queries:
    """A block of items: for each term of the vocabulary, the items that hold it and how often."""

    rows: np.ndarray
    vocabulary: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray

    @classmethod
    def of(cls, block: list[tuple[int, str | None]]) -> Queries:
        counts = [term_counts(text) for _, text in block]
        vocabulary = {term: i for i, term in enumerate(sorted(set().union(*counts)))}
        held = sorted((vocabulary[t], i, n) for i, own in enumerate(counts) for t, n in own.items())
        terms, items, times = (np.array([h[at] for h in held], np.int64) for at in range(3))
        starts = np.searchsorted(terms, np.arange(len(vocabulary) + 1))
        return cls(np.array([r for r, _ in block], np.int64), vocabulary, starts, items, times)


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    block, size = [], 0
    for row, text in items.select("i_row", "text").toLocalIterator():
        block.append((row, text))
        size += len(text or "")
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def count_terms(docs: DataFrame, vocabulary) -> DataFrame:
    """``docs`` (doc_id, text) with n (all terms), and terms and tfs of a broadcast vocabulary."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("n", T.LongType()),
            T.StructField("terms", T.ArrayType(T.IntegerType())),
            T.StructField("tfs", T.ArrayType(T.IntegerType())),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = vocabulary.value.vocabulary
        for batch in batches:
            n, terms, tfs = [], [], []
            for text in batch.column("text"):
                counts = term_counts(text.as_py())
                known = sorted((place[t], c) for t, c in counts.items() if t in place)
                n.append(counts.total())
                terms.append([t for t, _ in known])
                tfs.append([c for _, c in known])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.select("doc_id", "text").mapInArrow(count, schema)


def normaliser(n: Column, documents: int, length: int) -> Column:
    """75 and 25 times a document's length over the mean length, in whole numbers."""
    whole = F.lit(25).cast("decimal(3,0)") * n.cast("decimal(18,0)") * F.lit(documents).cast("decimal(16,0)")
    return F.lit(75) + F.floor(whole / F.lit(max(length, 1)).cast("decimal(19,0)")).cast("long")


def stratified(counts: DataFrame) -> DataFrame:
    """Index rows (m, ids, postings) from documents (doc_id, m, terms, tfs).

    Postings of a row are lists of places in ``ids``, one for each term and occurrence count.
    """
    schema = T.StructType(
        [
            T.StructField("m", T.LongType()),
            T.StructField("ids", T.ArrayType(counts.schema["doc_id"].dataType)),
            *(T.StructField(name, T.ArrayType(T.IntegerType())) for name in _LISTS),
        ]
    )

    def row(m: int, ids: list, terms: list[np.ndarray], tfs: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        doc = np.repeat(np.arange(len(ids)), [len(t) for t in terms])
        term, tf = np.concatenate(terms), np.concatenate(tfs)
        order = np.lexsort((doc, tf, term))
        term, tf, doc = term[order], tf[order], doc[order]
        starts = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])])
        lists = (term[starts], tf[starts], np.r_[starts, len(doc)], doc)
        return pa.RecordBatch.from_arrays(
            [pa.array([m], pa.int64()), pa.array([ids], pa.list_(kind)), *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in lists)],
            names=["m", "ids", *_LISTS],
        )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, terms, tfs, size = None, [], [], [], 0
        kind = None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for doc_id, m, own, often in zip(*(batch.column(c) for c in ("doc_id", "m", "terms", "tfs")), strict=True):
                m = m.as_py()
                if ids and (m != held or len(ids) >= ROW_DOCS or size >= ROW_POSTINGS):
                    yield row(held, ids, terms, tfs, kind)
                    ids, terms, tfs, size = [], [], [], 0
                held = m
                ids.append(doc_id.as_py())
                terms.append(own.values.to_numpy())
                tfs.append(often.values.to_numpy())
                size += len(terms[-1])
        if ids:
            yield row(held, ids, terms, tfs, kind)

    order = ("m", "d_row")
    placed = counts.select("doc_id", "m", "terms", "tfs", F.monotonically_increasing_id().alias("d_row"))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(build, schema)


class _Stratum:
    """An index row, and what it yields for a block of items."""

    def __init__(self, batch: pa.RecordBatch, at: int, queries: Queries, weights: np.ndarray):
        self.m = batch.column("m")[at].as_py()
        self.terms, self.tfs, starts, self.docs = (
            batch.column(c)[at].values.to_numpy().astype(np.int64) for c in _LISTS
        )
        self.starts, self.sizes = starts[:-1], np.diff(starts)
        self.ids = batch.column("ids")[at].values
        self.queries, self.weights = queries, weights
        self.impact = 1_000_000_000 * self.tfs // (1000 * self.tfs + 12 * self.m)

    def _asked(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, list, value a document of it adds) for posting lists, by place."""
        term = self.terms[lists]
        first = self.queries.starts[term]
        n = self.queries.starts[term + 1] - first
        at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        which = np.repeat(lists, n)
        return self.queries.items[at], which, self.queries.times[at] * self.weights[self.terms[which]] * self.impact[which]

    def bounds(self) -> np.ndarray:
        """For each item, a score that no document of the row exceeds."""
        last = np.flatnonzero(np.r_[self.terms[1:] != self.terms[:-1], True])  # most occurrences of each term
        item, _, value = self._asked(last)
        bound = np.zeros(len(self.queries.rows), np.int64)
        np.add.at(bound, item, value)
        return bound

    def scores(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(items, scores of all documents for each) for the wanted items (mask)."""
        items = np.flatnonzero(wanted)
        place = np.cumsum(wanted) - 1
        total = np.zeros((len(items), len(self.ids)), np.int64)
        item, which, value = self._asked(np.arange(len(self.terms)))
        keep = wanted[item]
        item, which, value = place[item[keep]], which[keep], value[keep]
        cuts = np.searchsorted(np.cumsum(self.sizes[which]), np.arange(_ADDED, self.sizes[which].sum(), _ADDED))
        for part in np.split(np.arange(len(which)), cuts):
            n = self.sizes[which[part]]
            at = np.repeat(self.starts[which[part]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            np.add.at(total, (np.repeat(item[part], n), self.docs[at]), np.repeat(value[part], n))
        return items, total


class _Best:
    """The ``top`` highest scores of each item so far, equal ones by ascending id, nulls last."""

    def __init__(self, least: np.ndarray, top: int):
        self.least, self.top, self.held = np.maximum(least, 1), top, {}

    def add(self, item: int, scores: np.ndarray, ids: pa.Array) -> None:
        hit = np.flatnonzero(scores >= self.least[item])
        if len(hit) > self.top:
            own = scores[hit]
            hit = hit[own >= np.partition(own, -self.top)[-self.top]]
        if not len(hit):
            return
        found = zip((-scores[hit]).tolist(), ids.take(pa.array(hit)).to_pylist(), strict=True)
        held = sorted(self.held.get(item, []) + [(s, i is None, i) for s, i in found], key=lambda x: x[:2] + ((0,) if x[1] else (x[2],)))
        self.held[item] = held[: self.top]
        if len(held) >= self.top:
            self.least[item] = max(self.least[item], -self.held[item][-1][0])


def _searched(index: DataFrame, doc_type: T.DataType, told, top: int, first: bool) -> DataFrame:
    """(i_row, doc_id, score): the best of each partition of ``index``.

    ``told`` broadcasts the queries, the terms' weights and the score each item must reach.
    ``first``: each partition opens, for each item, its ``FIRST`` rows of highest bound alone.
    """
    schema = T.StructType(
        [T.StructField("i_row", T.LongType()), T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, least = told.value
        best = _Best(least.copy(), top)
        kind = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for at in range(batch.num_rows):
                stratum = _Stratum(batch, at, queries, weights)
                wanted = stratum.bounds() >= best.least
                if first:
                    wanted &= np.isin(np.arange(len(wanted)), batch.column("chosen")[at].as_py())
                if wanted.any():
                    for item, scores in zip(*stratum.scores(wanted), strict=True):
                        best.add(int(item), scores, stratum.ids)
        found = [(queries.rows[item], i, -s) for item, held in best.held.items() for s, _, i in held]
        if found:
            rows, ids, scores = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(ids, kind), pa.array(scores, pa.int64())], names=["i_row", "doc_id", "score"]
            )

    return index.mapInArrow(search, schema)


def _chosen(index: DataFrame, told, first: int) -> DataFrame:
    """The index rows of highest bound for some item, with these items' places in ``chosen``."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights, _ = told.value
        held: list[tuple[np.ndarray, np.ndarray]] = []  # per kept place: bounds and index rows, by item
        for batch in batches:
            for at in range(batch.num_rows):
                own = _Stratum(batch, at, queries, weights).bounds()
                row = np.full(len(own), batch.column("x_row")[at].as_py())
                for place in range(first):  # insert where it belongs, pass on what it displaces
                    if place == len(held):
                        held.append((own, row))
                        break
                    top, rows = held[place]
                    more = own > top
                    held[place] = (np.where(more, own, top), np.where(more, row, rows))
                    own, row = np.where(more, top, own), np.where(more, rows, row)
        for own, row in held:
            item = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item), pa.array(own[item]), pa.array(row[item])], names=["item", "bound", "x_row"]
            )

    bounds = index.mapInArrow(bound, "item long, bound long, x_row long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "x_row"))
    best = bounds.withColumn("rank", rank).where(F.col("rank") <= first)
    return index.join(best.groupBy("x_row").agg(F.collect_list("item").alias("chosen")), "x_row")


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("i_row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` highest-scoring of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Returns item_id, rank (from 1), doc_id and score (above 0), equal scores by ascending
    doc_id, null ids last. Null and empty texts have no terms: such items get no rows, such
    documents do not count. Rows that repeat a doc_id are documents, rows that repeat an item_id
    are items of their own. Other columns are ignored; empty tables give no rows.
    """
    context = docs.sparkSession.sparkContext
    asked = written(items.select("item_id", "text").withColumn("i_row", F.monotonically_increasing_id()), "items")
    doc_type = docs.schema["doc_id"].dataType
    parts = []
    for block in _blocks(asked):
        queries = Queries.of(block)
        counts = written(count_terms(docs, context.broadcast(queries)), "term-counts")
        documents, length = counts.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(queries.vocabulary), np.int64)
        for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        held = counts.where(F.size("terms") > 0).withColumn("m", normaliser(F.col("n"), documents, length))
        index = written(stratified(held).withColumn("x_row", F.monotonically_increasing_id()), "strata")
        least = np.zeros(len(queries.rows), np.int64)
        chosen = _chosen(index, context.broadcast((queries, weights, least)), FIRST)
        seen = _searched(chosen, doc_type, context.broadcast((queries, weights, least)), top, True)
        # A full list sets the score to reach; one row per item comes to the driver.
        place = {row: i for i, row in enumerate(queries.rows.tolist())}
        for row, score in _best(seen, top).where(F.col("rank") == top).select("i_row", "score").collect():
            least[place[row]] = score
        parts.append(_searched(index, doc_type, context.broadcast((queries, weights, least)), top, False))
    if not parts:
        none = T.StructType([T.StructField("i_row", T.LongType()), T.StructField("doc_id", doc_type), T.StructField("score", T.LongType())])
        parts = [docs.sparkSession.createDataFrame([], none)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionAll(part)
    return _best(found, top).join(asked.select("i_row", "item_id"), "i_row").select("item_id", "rank", "doc_id", "score")
