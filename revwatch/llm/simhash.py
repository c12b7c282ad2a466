"""SimHash near-duplicates through vantage-point trees (operator 5).

Equal fingerprints are one node. Fingerprints within three bits agree in one of their
halves but for one bit, so each half gets a vantage-point tree over its Hamming distance
with radius one. The trees are fitted on a bounded sample and only say how the space is
cut into shards: a fingerprint lives in one shard per half, and is sent as a query to all
shards that the triangle bound does not rule out, so no pair is lost across a boundary.
Within a shard the same pruning goes on over the whole fingerprint with radius three,
down to small blocks that are compared outright. Shards larger than a block size are cut
into blocks of homes and queries, so no task holds a whole dense region. A task puts out
a spanning forest of the links it finds, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import written
from revwatch.llm.components import components

SEED = 42
SHINGLE = 3
RADIUS = 3
HALF_RADIUS = RADIUS // 2
#: About as many fingerprints, by hash, fit the trees; these alone go to the driver.
SAMPLE = 20_000
#: Fingerprints a shard should hold, and homes or queries a task may compare.
SHARD = 1_024
BLOCK = 8_192
_PLAIN = 192
#: Share of a node's points that a cut may send both ways; a region denser than that is not cut
#: further, as queries would be copied faster than shards shrink, but compared in blocks.
BOTH = 0.4


def fingerprint(text: str | None) -> int:
    """64 majority bits over the hashes of 3-word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    ends = ends.tolist()
    n = max(len(words) - SHINGLE + 1, 1)
    last = ends[SHINGLE - 1 :] if len(words) >= SHINGLE else ends[-1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, last, strict=False)], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65_536):  # bounded memory for very long texts
        part = hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` and one more column, ``fingerprint`` (64 bits in a long)."""
    schema = T.StructType([*docs.schema.fields, T.StructField("fingerprint", T.LongType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(marks.view(np.int64))], names=[*batch.schema.names, "fingerprint"]
            )

    return docs.mapInArrow(mark, schema)


@dataclass
class Vantage:
    """A cut of the space: ``near`` holds what is within ``bound`` of ``point``."""

    point: int
    bound: int
    near: Vantage | int
    far: Vantage | int


def _distance(values: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(point)).astype(np.int16)


def _cut(values: np.ndarray, radius: int, most_both: float = 1.0) -> tuple[int, int] | None:
    """The point and bound, of a few tried, that send the fewest queries both ways."""
    best = None
    for point in values[:: max(1, len(values) // 8)][:8]:
        far = _distance(values, int(point))
        for bound in {int(np.median(far)), int(np.median(far)) - 1}:
            near = np.count_nonzero(far <= bound)
            if not 0 < near < len(values):
                continue
            both = np.count_nonzero((far - radius <= bound) & (far + radius > bound))
            if both > most_both * len(values):
                continue
            cost = both / len(values) + abs(near / len(values) - 0.5)
            if best is None or cost < best[0]:
                best = (cost, int(point), bound)
    return best and best[1:]


def fit_tree(sample: np.ndarray, leaf: int, radius: int, first: int = 0) -> tuple[Vantage | int, int]:
    """A tree whose leaves hold about ``leaf`` of the sample; leaves are numbered from ``first``."""
    cut = _cut(sample, radius, BOTH) if len(sample) > leaf else None
    if cut is None:
        return first, first + 1
    inside = _distance(sample, cut[0]) <= cut[1]
    near, after = fit_tree(sample[inside], leaf, radius, first)
    far, after = fit_tree(sample[~inside], leaf, radius, after)
    return Vantage(*cut, near, far), after


def routes(tree: Vantage | int, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each leaf: (leaf, places in ``values`` that it may concern, whether they live there)."""
    todo = [(tree, np.arange(len(values)), np.ones(len(values), bool))]
    while todo:
        node, rows, home = todo.pop()
        if not len(rows):
            continue
        if isinstance(node, int):
            yield node, rows, home
            continue
        far = _distance(values[rows], node.point)
        inside = far <= node.bound
        for child, reach, own in (
            (node.near, far - radius <= node.bound, home & inside),
            (node.far, far + radius > node.bound, home & ~inside),
        ):
            todo.append((child, rows[reach], own[reach]))


def close_pairs(queries: np.ndarray, homes: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (query, home) within ``radius`` bits, in batches, by recursive pruning."""
    todo = [(np.arange(len(queries)), np.arange(len(homes)))]
    while todo:
        q, h = todo.pop()
        if not len(q) or not len(h):
            continue
        cut = _cut(homes[h], radius) if len(h) > _PLAIN else None
        if cut is not None:
            to_home, to_query = _distance(homes[h], cut[0]), _distance(queries[q], cut[0])
            inside = to_home <= cut[1]
            near, far = to_query - radius <= cut[1], to_query + radius > cut[1]
            work = near.sum() * inside.sum() + far.sum() * (~inside).sum()
            if work < 0.9 * len(q) * len(h):
                todo += [(q[near], h[inside]), (q[far], h[~inside])]
                continue
        rows = max(1, 2_000_000 // len(h))
        for at in range(0, len(q), rows):
            part = q[at : at + rows]
            a, b = np.nonzero(np.bitwise_count(queries[part][:, None] ^ homes[h][None, :]) <= radius)
            yield part[a], h[b]


def spanning_links(queries: np.ndarray, homes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the same components as all close pairs, as pairs of fingerprints."""
    values, place = np.unique(np.concatenate([queries, homes]), return_inverse=True)
    root = np.arange(len(values))
    left, right = [], []
    for q, h in close_pairs(queries, homes):
        a, b = place[: len(queries)][q], place[len(queries) :][h]
        while True:
            ra, rb = root[a], root[b]
            apart = ra != rb
            if not apart.any():
                break
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            # Each root hangs below at most one smaller root in a round.
            low, high = np.minimum(ra, rb), np.maximum(ra, rb)
            _, one = np.unique(high, return_index=True)
            left.append(values[a[one]])
            right.append(values[b[one]])
            root[high[one]] = low[one]
            while not np.array_equal(jumped := root[root], root):
                root = jumped
    empty = np.array([], np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _links(nodes: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct ``fingerprint`` values that connect all within reach."""
    spark = nodes.sparkSession
    n = nodes.count()
    by_hash = F.pmod(F.xxhash64("fingerprint"), F.lit(max(n, 1))) < SAMPLE  # about that many, or all
    picked = nodes.where(by_hash).select("fingerprint").collect()
    sample = np.array([r.fingerprint for r in picked], np.int64).view(np.uint64)
    leaf = max(8, SHARD * len(sample) // max(n, 1))
    low, high = np.uint64(0xFFFFFFFF), np.uint64(32)
    upper, after = fit_tree(np.unique(sample >> high), leaf, HALF_RADIUS)
    lower, shards = fit_tree(np.unique(sample & low), leaf, HALF_RADIUS, after)
    trees = spark.sparkContext.broadcast((upper, lower))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column("fingerprint").to_numpy(zero_copy_only=False)
            values = marks.view(np.uint64)
            for tree, half in zip(trees.value, (values >> high, values & low), strict=True):
                for shard, rows, home in routes(tree, half, HALF_RADIUS):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), shard, np.int32)), pa.array(marks[rows]), pa.array(home)],
                        names=["shard", "fingerprint", "home"],
                    )

    routed = written(nodes.select("fingerprint").mapInArrow(route, "shard int, fingerprint long, home boolean"), "shards")
    sizes = routed.groupBy("shard").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / BLOCK).cast("int").alias("home_blocks"),
        F.ceil(F.count("*") / BLOCK).cast("int").alias("query_blocks"),
    )  # a row per shard, fewer than twice the sample
    blocked = routed.join(F.broadcast(sizes), "shard").where("home_blocks > 0")
    own = F.pmod(F.xxhash64("fingerprint"), F.lit(1 << 30))

    def dealt(rows: DataFrame, own_blocks: str, other_blocks: str, home: bool) -> DataFrame:
        mine = (own % F.col(own_blocks)).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
        pair = rows.select("shard", "fingerprint", mine.alias("mine"), other.alias("other"))
        first, second = ("mine", "other") if home else ("other", "mine")
        return pair.select(
            "shard", F.col(first).alias("hb"), F.col(second).alias("qb"), "fingerprint", F.lit(home).alias("home")
        )

    tasks = dealt(blocked.where("home"), "home_blocks", "query_blocks", True).unionAll(
        dealt(blocked, "query_blocks", "home_blocks", False)
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        values = rows["fingerprint"].to_numpy().view(np.uint64)
        home = rows["home"].to_numpy()
        a, b = spanning_links(values[~home], values[home])
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return tasks.groupBy("shard", "hb", "qb").applyInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Components of ``docs`` (doc_id, text) linked at three or fewer differing bits.

    One row per input row: doc_id, the columns of ``carry``, fingerprint (long),
    component_id (least doc_id reachable, null if none has one) and ``first`` (true for one
    row of each component, of least doc_id). Null and empty texts have fingerprint zero and
    are linked like any other; repeated rows fall together; other columns are ignored.
    """
    wanted = docs.select("doc_id", "text", *(c for c in carry if c not in ("doc_id", "text")))
    marked = fingerprints(wanted).withColumn("s_row", F.monotonically_increasing_id())
    rows = written(marked if "text" in carry else marked.drop("text"), "simhash")
    nodes = written(
        rows.groupBy("fingerprint").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "s_row")).alias("least")
        ),
        "fingerprints",
    )
    roots = components(_links(nodes))
    placed = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("least"))
    classes = placed.drop("least").join(least, "root").select("fingerprint", "least")
    return rows.join(classes, "fingerprint").select(
        *(c for c in rows.columns if c not in ("fingerprint", "s_row")),
        "fingerprint",
        F.col("least.doc_id").alias("component_id"),
        (F.col("least.s_row") == F.col("s_row")).alias("first"),
    )


def near_duplicate_digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``near_duplicates``."""
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
