"""Fuzzy repeated passages by collinear chaining of shared k-mers (operator 9).

Exact copies are one document first. Every document gives its minimizers, of any ``SPAN``
consecutive k-mers the one of least hash, and each minimizer with the next one is a seed:
k-mers that lie less than their length apart, so that a seed stands for a run of 6 to 9
words, and a shared run of ``SEED + 2 * SPAN - 1`` words always shares a seed. Seeds meet by
value; each links to its value's first document, so a passage held by n documents makes n
links and not their square. Per pair of documents the
ordered matches are chained: a chain's score is the words of its seeds less a cost for
gaps in either document, and a Fenwick tree holds the best score by place, so chaining n
matches takes n log n steps. Chains are then aligned on the words themselves, which
travel in chunks: seeds fix the alignment, the gaps between them are aligned by edit
distance, and the ends are extended while they pay. A chain whose identity is too low is
parted at the gaps that cost more than they join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from revwatch.llm.common import folded_words, text_of, written

SEED = 5
SPAN = 4
MIN_WORDS = 50
MIN_IDENTITY = 0.8
#: Words between the ends of a chain that is aligned.
CANDIDATE = 8
#: Cost of a word of gap in either document; a gap of 25 words in both costs a seed.
GAP = 0.1
#: Words on either side of a chain that may extend it, and words a chunk holds.
EXTEND = 64
CHUNK = 64
#: How far an extension's score may fall below its best.
DROP = 6
#: Seeds that are looked up in a broadcast list, and the share of rows that are searched for them.
#: Either way gives the same links: the list only keeps frequent seeds off a single task.
FREQUENT = 1000
SEARCHED = 0.02
#: Seeds a batch may hold before it is passed on.
BATCH = 500_000

_FACTORS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(SEED)], np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """32 bits of each word's hash."""
    words = folded_words(text)
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).astype("<u4")


def seeds(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place of the first k-mer, distance of the second) of each pair of neighbouring minimizers."""
    n = len(hashes) - SEED + 1
    if n <= SPAN:
        return np.array([], np.uint64), np.array([], np.int64), np.array([], np.int64)
    wide = hashes.astype(np.uint64)
    mers = np.zeros(n, np.uint64)
    for i, factor in enumerate(_FACTORS):
        mers += wide[i : i + n] * factor
    mers ^= mers >> np.uint64(29)
    mers *= np.uint64(0xBF58476D1CE4E5B9)
    mers ^= mers >> np.uint64(32)
    windows = np.lib.stride_tricks.sliding_window_view(mers, SPAN)
    places = windows.argmin(axis=1) + np.arange(n - SPAN + 1)
    places = places[np.concatenate([[True], places[1:] != places[:-1]])]
    first, second = places[:-1], places[1:]
    apart = second - first
    values = mers[first] * _FACTORS[0] + mers[second] * _FACTORS[1] + apart.astype(np.uint64)
    return values ^ (values >> np.uint64(31)), first, apart


class Fenwick:
    """Greatest value among the first places, with its owner."""

    def __init__(self, n: int):
        self.best = [(-np.inf, -1)] * (n + 1)

    def put(self, place: int, value: float, owner: int) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place][0]:
                self.best[place] = (value, owner)
            place += place & -place

    def below(self, place: int) -> tuple[float, int]:
        """Over places less than ``place``."""
        out = (-np.inf, -1)
        while place > 0:
            if self.best[place][0] > out[0]:
                out = self.best[place]
            place -= place & -place
        return out


def chains(left: np.ndarray, right: np.ndarray) -> Iterator[list[int]]:
    """Chains of matches, best first, as places in ``left`` (ascending, distinct) and ``right``."""
    order = np.unique(right)
    rank = np.searchsorted(order, right).tolist()
    x, y = left.tolist(), right.tolist()
    tree = Fenwick(len(order))
    score, back = [0.0] * len(x), [-1] * len(x)
    for i in range(len(x)):
        reach = GAP * (x[i] + y[i])
        value, owner = tree.below(rank[i])
        gain = value - reach
        score[i], back[i] = (SEED + gain, owner) if gain > 0 else (float(SEED), -1)
        tree.put(rank[i], score[i] + reach, i)
    used = [False] * len(x)
    for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if len(chain) > 1:
            yield chain[::-1]


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of each (row, other), whose matches come together, ordered by place."""
    names = ("row", "other", "place", "other_place", "apart")
    rest = [np.array([], np.int64)] * len(names)

    def emit(columns: list[np.ndarray]) -> pa.RecordBatch:
        row, other, place, other_place, apart = columns
        new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (other[1:] != other[:-1])]))
        out: list[tuple] = []
        for a, b in zip(new.tolist(), np.append(new[1:], len(row)).tolist(), strict=True):
            # Both k-mers of a seed are matches; one that begins a seed of its own stands as that.
            x, first = np.unique(np.concatenate([place[a:b], place[a:b] + apart[a:b]]), return_index=True)
            y = np.concatenate([other_place[a:b], other_place[a:b] + apart[a:b]])[first]
            for chain in chains(x, y):
                xs, ys = x[chain], y[chain]
                if xs[-1] + SEED - xs[0] >= CANDIDATE:
                    out.append((int(row[a]), int(other[a]), xs.tolist(), ys.tolist()))
        columns = list(zip(*out, strict=True)) if out else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["row", "other", "xs", "ys"]
        )

    for batch in batches:
        now = [np.concatenate([r, batch.column(n).to_numpy()]) for r, n in zip(rest, names, strict=True)]
        if not len(now[0]):
            continue
        # The last pair may go on in the next batch.
        whole = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = int(whole[-1]) + 1 if len(whole) else 0
        rest = [c[cut:] for c in now]
        if cut:
            yield emit([c[:cut] for c in now])
    if len(rest[0]):
        yield emit(rest)


def edit_distance(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) == len(b) and np.array_equal(a, b):
        return 0
    row = np.arange(len(b) + 1)
    steps = row.copy()
    for i, x in enumerate(a, 1):
        best = np.minimum(row[1:] + 1, row[:-1] + (b != x))
        new = np.concatenate([[i], best])
        # An insertion costs one a place: running minimum after taking the places out.
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def _extension(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, mismatches) of the best extension along both, from their beginning."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    top = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(top - score > DROP)
    score = score[: int(stop[0])] if len(stop) else score
    best = int(score.argmax()) if len(score) else 0
    if not len(score) or score[best] <= 0:
        return 0, 0
    return best + 1, int(np.count_nonzero(~same[: best + 1]))


def _runs(scores: list[float]) -> list[tuple[int, int, float, float]]:
    """Runs of greatest score: (first, last, sum before, sum to its end) of each, disjoint and in order."""
    runs: list[tuple[int, int, float, float]] = []
    total = 0.0
    for k, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        run = (k, k, before, total)
        while True:
            j = next((j for j in range(len(runs) - 1, -1, -1) if runs[j][2] < run[2]), None)
            if j is None or runs[j][3] >= total:
                break
            run = (runs[j][0], k, runs[j][2], total)
            del runs[j:]
        runs.append(run)
    return runs


def _passages(steps: list[int], wrong: list[int]) -> list[tuple[int, int]]:
    """(first, last) seed of a chain's pieces, from the words and errors between its seeds.

    An error weighs as much as makes a piece of ``MIN_IDENTITY`` score nothing. Neighbours
    that reach it together are one piece.
    """
    scores: list[float] = [SEED]
    for step, errors in zip(steps, wrong, strict=True):
        scores += [step - errors / (1 - MIN_IDENTITY) - SEED, SEED]
    out: list[tuple[int, int, float, float]] = []
    for run in _runs(scores):
        while out and run[3] - out[-1][2] >= 0:
            first, _, before, _ = out.pop()
            run = (first, run[1], before, run[3])
        out.append(run)
    return [((first + 1) // 2, last // 2) for first, last, *_ in out]


def align(xs: np.ndarray, ys: np.ndarray, a: np.ndarray, b: np.ndarray, a0: int, b0: int) -> list[tuple[int, int, int, int, float]]:
    """Spans in both documents and their identity, for a chain and the words around it.

    A chain that falls below ``MIN_IDENTITY`` as a whole, as one with unrelated words
    between two passages does, is parted there and its pieces stand by themselves.
    ``a`` and ``b`` begin at word ``a0`` and ``b0`` of their documents.
    """
    x, y = (xs - a0).tolist(), (ys - b0).tolist()
    wrong, steps = [], []
    for i in range(len(x) - 1):
        # Seeds may overlap: what is left of the gap on either side is aligned.
        left, right = (x[i] + SEED, y[i] + SEED)
        step = max(0, left - x[i + 1], right - y[i + 1])
        wrong.append(edit_distance(a[left - step : x[i + 1]], b[right - step : y[i + 1]]))
        steps.append(max(x[i + 1] - x[i], y[i + 1] - y[i]))

    def piece(first: int, last: int, extend: bool = True) -> tuple[int, int, int, int, float]:
        before = missed = after = more = 0
        if extend:
            # Not into the next piece's seeds.
            x0, y0 = (x[first - 1] + SEED, y[first - 1] + SEED) if first else (0, 0)
            x1, y1 = (x[last + 1], y[last + 1]) if last + 1 < len(x) else (len(a), len(b))
            before, missed = _extension(a[x0 : x[first]][::-1], b[y0 : y[first]][::-1])
            after, more = _extension(a[x[last] + SEED : x1], b[y[last] + SEED : y1])
        spans = (x[first] - before, x[last] + SEED + after, y[first] - before, y[last] + SEED + after)
        length = max(spans[1] - spans[0], spans[3] - spans[2])
        identity = 1 - (sum(wrong[first:last]) + missed + more) / length
        return spans[0] + a0, spans[1] + a0, spans[2] + b0, spans[3] + b0, identity

    whole = piece(0, len(x) - 1)
    if whole[-1] >= MIN_IDENTITY:
        return [whole]
    out = []
    for first, last in _passages(steps, wrong):
        own = piece(first, last)
        out.append(own if own[-1] >= MIN_IDENTITY else piece(first, last, extend=False))
    return out


@F.arrow_udf(BinaryType())
def _words(text: pa.Array) -> pa.Array:
    return pa.array([word_hashes(t.as_py()).tobytes() for t in text], pa.binary())


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def emit(batch: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        at = pa.array(np.concatenate([np.full(len(f[1]), f[0]) for f in found]))
        seed, place, apart = (np.concatenate([f[i] for f in found]) for i in (1, 2, 3))
        columns = [
            pa.array(seed.view(np.int64)), batch.column("doc_id").take(at), batch.column("row").take(at),
            pa.array(place), pa.array(apart),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["seed", "doc_id", "row", "place", "apart"])

    for batch in batches:
        found, held = [], 0
        for i, words in enumerate(batch.column("words")):
            found.append((i, *seeds(np.frombuffer(words.as_buffer(), "<u4"))))
            held += len(found[-1][1])
            if held >= BATCH:
                yield emit(batch, found)
                found, held = [], 0
        if found:
            yield emit(batch, found)


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, words in zip(batch.column("row").to_pylist(), batch.column("words"), strict=True):
            data = words.as_py()
            starts = range(0, len(data), 4 * CHUNK)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row] * len(starts), pa.int64()),
                    pa.array([s // (4 * CHUNK) for s in starts], pa.int64()),
                    pa.array([data[s : s + 4 * CHUNK] for s in starts], pa.binary()),
                ],
                names=["row", "chunk", "words"],
            )


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def joined(chunks: list[dict], other: bool) -> tuple[np.ndarray, int]:
        own = sorted((c["chunk"], c["words"]) for c in chunks if c["other"] == other)
        return np.frombuffer(b"".join(w for _, w in own), "<u4"), own[0][0] * CHUNK

    for batch in batches:
        rows = []
        for row, other, xs, ys, chunks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            (a, a0), (b, b0) = joined(chunks, False), joined(chunks, True)
            for start, end, other_start, other_end, identity in align(np.array(xs), np.array(ys), a, b, a0, b0):
                if end - start >= MIN_WORDS and identity >= MIN_IDENTITY:
                    rows.append((row, start, end, other, other_start, other_end, identity))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
        kinds = [*[pa.int64()] * 6, pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["row", "start", "end", "other", "other_start", "other_end", "identity"],
        )


def _matches(single: DataFrame) -> DataFrame:
    """Each seed with the first holder of its value: row, other, place, other_place, apart.

    First is the least doc_id, then row, then place. Seeds shuffle once, by value. Values
    that are frequent among ``SEARCHED`` of the rows, ``FREQUENT`` of them at the most, are
    aggregated on the map side and looked up where they are, so none gathers in one task.
    """
    kind = single.schema["doc_id"].dataType.simpleString()

    def seeded(rows: DataFrame) -> DataFrame:
        return rows.mapInArrow(_seeded, f"seed long, doc_id {kind}, row long, place long, apart long")

    searched = seeded(single.sample(SEARCHED, seed=1)).groupBy("seed").count().where("count > 1")
    frequent = F.broadcast(written(searched.orderBy(F.desc("count"), "seed").limit(FREQUENT).select("seed"), "frequent"))
    place = F.struct("doc_id", "row", "place")

    often = written(seeded(single).join(frequent, "seed"), "frequent-seeds")
    holders = written(often.groupBy("seed").agg(F.min(place).alias("least")), "frequent-holders")
    looked_up = often.join(F.broadcast(holders), "seed")

    so_far = Window.partitionBy("seed").orderBy("doc_id", "row", "place").rowsBetween(Window.unboundedPreceding, 0)
    met = seeded(single).join(frequent, "seed", "left_anti").withColumn("least", F.first(place).over(so_far))
    return looked_up.unionByName(met).where("doc_id <> least.doc_id").select(
        "row", F.col("least.row").alias("other"), "place", F.col("least.place").alias("other_place"), "apart"
    )


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Passages of 50 words or more that ``docs`` (doc_id, text) share, at 0.8 identity or more.

    A row links a passage of a document (word places, end exclusive) with one of a document
    of smaller doc_id; n_words is its length. An exact copy is linked whole with the
    least doc_id of its text and not expanded further. Words are runs of letters, digits and
    non-ASCII characters, in lower case. Where the seeds at a passage's end are first
    held by a third document, words may be missing there, and a passage all of whose seeds
    are first held by others may be lost. Null, empty and short texts share nothing; rows
    without doc_id are left out, and rows that repeat a doc_id are one document each but
    are not compared with one another; of such rows with equal texts one counts. doc_id
    may be of any type that has an order. Other columns are ignored.
    """
    text = text_of().alias("text")
    keys = [F.xxhash64("text").alias("h1"), F.hash("text").alias("h2"), F.length("text").alias("h3")]
    base = written(
        docs.where("doc_id is not null").select("doc_id", text)
        .select("doc_id", *keys, _words("text").alias("words"))
        .withColumn("n_words", (F.octet_length("words") / 4).cast("long"))
        .withColumn("row", F.monotonically_increasing_id()),
        "words",
    )
    marked = base.where(F.col("n_words") >= MIN_WORDS).select("row", "doc_id", "h1", "h2", "h3", "n_words")
    first = marked.groupBy("h1", "h2", "h3").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.count("*").alias("n"))
    copies = written(
        marked.join(first.where("n > 1").drop("n"), ["h1", "h2", "h3"]).where("row <> first.row")
        .select("row", "doc_id", "n_words", F.col("first.doc_id").alias("source_id")),
        "text-copies",
    )
    single = (
        base.where(F.col("n_words") >= MIN_WORDS).join(copies.select("row"), "row", "left_anti")
        .select("row", "doc_id", "words")
    )

    ordered = _matches(single).repartition("row", "other").sortWithinPartitions("row", "other", "place", "other_place")
    found = written(
        ordered.mapInArrow(_chained, "row long, other long, xs array<long>, ys array<long>")
        .withColumn("chain", F.monotonically_increasing_id()),
        "chains",
    )

    def needs(row: str, places: str, other: bool) -> DataFrame:
        low = F.greatest(F.get(places, F.lit(0)) - EXTEND, F.lit(0)) / CHUNK
        high = (F.get(places, F.size(places) - 1) + SEED + EXTEND) / CHUNK
        chunks = F.sequence(F.floor(low), F.floor(high))
        return found.select(F.col(row).alias("row"), F.explode(chunks).alias("chunk"), "chain", F.lit(other).alias("other"))

    needed = needs("row", "xs", False).unionAll(needs("other", "ys", True))
    involved = found.select(F.explode(F.array("row", "other")).alias("row")).distinct()
    chunks = written(
        single.join(involved, "row", "left_semi").select("row", "words")
        .mapInArrow(_chunked, "row long, chunk long, words binary"),
        "chunks",
    )
    # One plan at all sizes.
    slices = (
        needed.hint("merge").join(chunks.hint("merge"), ["row", "chunk"])
        .groupBy("chain")
        .agg(F.collect_list(F.struct("other", "chunk", "words")).alias("chunks"))
    )
    aligned = written(
        found.hint("merge").join(slices.hint("merge"), "chain").select("row", "other", "xs", "ys", "chunks")
        .mapInArrow(_aligned, "row long, start long, end long, other long, other_start long, other_end long, identity double"),
        "passages",
    )
    ids = base.select("row", "doc_id")
    sources = base.select(F.col("row").alias("other"), F.col("doc_id").alias("source_id"))
    passages = aligned.join(ids, "row").join(sources, "other").select(
        "doc_id", "start", "end", (F.col("end") - F.col("start")).alias("n_words"),
        "source_id", F.col("other_start").alias("source_start"), F.col("other_end").alias("source_end"),
        F.round("identity", 4).alias("identity"),
    )
    zero, whole = F.lit(0).cast("long"), F.col("n_words")
    return passages.unionByName(
        copies.where("doc_id <> source_id").select(
            "doc_id", zero.alias("start"), whole.alias("end"), "n_words",
            "source_id", zero.alias("source_start"), whole.alias("source_end"), F.lit(1.0).alias("identity"),
        )
    )
