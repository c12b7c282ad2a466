"""Embedding near-duplicates through NN-descent (operator 11).

Vectors of one label and length form a space. Equal vectors are one node, and nodes within
half the link angle of a leader form a ball, whose members are all linked: a dense group costs
one leader, not all its pairs. The neighbour graph is built over leaders. Its first lists come
from a forest of random sign cuts: nodes sorted by their signs, compared within blocks of
neighbouring rows. Rounds of NN-descent then join the neighbours of each node with one another
where one of the two is new. Lists hold the nearest ``k``; one that is full of possible links
grows until all of them have room. An audit compares sampled nodes with all others, and more
trees are planted while its recall is too low.

Links between balls follow from the triangle bound on angles where it decides, and from
comparing members, in tiles, where it does not.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import written
from revwatch.llm.components import components

LOG = logging.getLogger(__name__)

THRESHOLD = 0.93
#: Length of a list that is not full of possible links.
K = 10
#: Neighbours below this cosine lead nowhere near a link and are not listed.
FLOOR = 0.5
#: Nodes compared outright in a leaf of the forest, and members of a pivot joined at once.
LEAF, JOINED = 512, 256
#: Members of two balls compared in one task.
TILE = 1_024
#: Rounds over the leaders in which balls form; each divides a dense group by up to LEAF.
BALL_ROUNDS = 2
#: Share of pairs at the threshold that the first forest should meet; sets the number of trees.
MET = 0.9
#: Descent ends when a round adds fewer than this share of the lists' places, or after ROUNDS.
SETTLED, ROUNDS = 0.001, 12
#: Nodes audited, by hash; these alone go to the driver. Trees are added up to AUDITS times.
AUDITED, RECALL, AUDITS = 1_024, 0.97, 4
SEED = 11
#: Angles closer than this to a bound are decided by comparing the vectors.
MARGIN = 1e-6
_BITS = 62
_PLACES = "space string, tree int, mark long, node long, embedding array<{}>"


def _units(vectors: pa.Array) -> np.ndarray:
    """Unit vectors in double precision from lists of one length."""
    rows = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    rows /= np.abs(rows).max(axis=1, keepdims=True)  # squares of extreme values would overflow
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _by_length(vectors: pa.Array) -> Iterator[np.ndarray]:
    """Places of the lists of each length."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths):
        yield np.flatnonzero(lengths == n)


def _runs(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of equal ``keys``, cut into runs of ``most``; expects sorted batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        change = np.zeros(rows.num_rows - 1, bool)
        for key in keys:
            values = rows.column(key).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for at, end in zip(starts, starts[1:], strict=False):
            for cut in range(at, end, most):
                yield rows.slice(cut, min(most, end - cut))
        at = starts[-1]
        while rows.num_rows - at > most:
            yield rows.slice(at, most)
            at += most
        held = rows.slice(at)
    if held is not None and held.num_rows:
        yield held


def usable(embedding: Column, label: Column) -> Column:
    """Whether a vector may link: a label, and finite components that are not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _classes(rows: DataFrame) -> DataFrame:
    """One node per distinct usable vector of a space, named after its least row."""
    return (
        rows.where("usable")
        .groupBy("space", "digest")
        .agg(
            F.min("e_row").alias("node"),
            F.min("vec_id").alias("least"),
            F.count("*").alias("weight"),
            F.first("embedding").alias("embedding"),
        )
    )


def _centres(nodes: DataFrame) -> dict[int, np.ndarray]:
    """The mean unit vector for the commonest lengths of vectors; others are cut through zero."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            vectors = batch.column("embedding")
            for rows in _by_length(vectors):
                units = _units(vectors.take(pa.array(rows)))
                n, total = sums.get(units.shape[1], (0, 0.0))
                sums[units.shape[1]] = (n + len(units), total + units.sum(axis=0))
        if sums:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(sums), pa.int64()),
                    pa.array([n for n, _ in sums.values()], pa.int64()),
                    pa.array([t.tolist() for _, t in sums.values()], pa.list_(pa.float64())),
                ],
                names=["dim", "n", "total"],
            )

    parts = nodes.select("embedding").mapInArrow(add, "dim long, n long, total array<double>")
    means = (
        parts.select("dim", "n", F.posexplode("total").alias("at", "x"))
        .groupBy("dim", "at")
        .agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
        .groupBy("dim")
        .agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("at", F.col("x") / F.col("n")))).alias("mean"))
        .orderBy(F.desc("n"))
        .limit(16)
    )
    return {r["dim"]: np.array([x for _, x in r["mean"]]) for r in means.collect()}


def _forest(nodes: DataFrame, trees: list[int], centres: dict[int, np.ndarray]) -> DataFrame:
    """A row per node and tree; rows of like signs stand together, in partitions of even size."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _by_length(batch.column("embedding")):
                part = batch.take(pa.array(rows))
                units = _units(part.column("embedding"))
                dim = units.shape[1]
                units = units - centres.get(dim, 0.0)
                for tree in trees:
                    planes = np.random.default_rng([SEED, tree, dim]).standard_normal((dim, _BITS))
                    marks = (units @ planes > 0) @ (1 << np.arange(_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column("space"),
                            pa.array(np.full(len(rows), tree, np.int32)),
                            pa.array(marks),
                            part.column("node"),
                            part.column("embedding"),
                        ],
                        names=["space", "tree", "mark", "node", "embedding"],
                    )

    order = ("space", "tree", "mark", "node")
    kind = nodes.schema["embedding"].dataType.elementType.simpleString()
    marked = nodes.select("space", "node", "embedding").mapInArrow(sign, _PLACES.format(kind))
    return marked.repartitionByRange(*order).sortWithinPartitions(*order)


def _numbers(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).to_numpy(zero_copy_only=False)


def _balls(nodes: DataFrame, radius: float, centres: dict[int, np.ndarray], leaf: int) -> DataFrame:
    """``nodes`` with ``ball`` (the leader's node) and ``angle`` (to it, at most ``radius``)."""
    least = math.cos(radius)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("space", "tree"), leaf):
            units = _units(rows.column("embedding"))
            near = units @ units.T >= least
            boss, free = np.arange(len(units)), np.ones(len(units), bool)
            for i in range(len(units)):
                if free[i]:
                    own = near[i] & free
                    own[i] = True
                    boss[own] = i
                    free &= ~own
            node = _numbers(rows, "node")
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(node[boss])], names=["node", "ball"])

    place, leaders = None, nodes
    for at in range(BALL_ROUNDS):
        found = written(_forest(leaders, [-1 - at & 0xFFFF], centres).mapInArrow(lead, "node long, ball long"), "balls")
        # Leaders of this round go on; a node follows its leader to where that one went.
        then = found.select(F.col("node").alias("ball"), F.col("ball").alias("next"))
        place = found if place is None else place.join(then, "ball").select("node", F.col("next").alias("ball"))
        leaders = leaders.join(found.where("node = ball").select("node"), "node", "left_semi")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angle = np.empty(batch.num_rows)
            for rows in _by_length(batch.column("embedding")):
                part = batch.take(pa.array(rows))
                apart = np.linalg.norm(_units(part.column("embedding")) - _units(part.column("centre")), axis=1)
                angle[rows] = 2 * np.arcsin(np.minimum(apart / 2, 1))  # exact for small angles too
            inside = angle <= radius
            node, ball = _numbers(batch, "node"), _numbers(batch, "ball")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(np.where(inside, ball, node)), pa.array(np.where(inside, angle, 0.0))],
                names=[*batch.schema.names[:-2], "ball", "angle"],
            )

    centre = nodes.select(F.col("node").alias("ball"), F.col("embedding").alias("centre"))
    led = nodes.join(place, "node").join(centre, "ball").select(*nodes.columns, "ball", "centre")
    schema = T.StructType([*nodes.schema.fields, T.StructField("ball", T.LongType()), T.StructField("angle", T.DoubleType())])
    return led.mapInArrow(measure, schema)


def _listed(a: np.ndarray, b: np.ndarray, sim: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sim)], names=["a", "b", "sim"])


def _nearest(rows: pa.RecordBatch, name: str, k: int, link: float, fresh: np.ndarray | None = None) -> pa.RecordBatch:
    """Each row's nearest ``k`` of the others, and all that may link; pairs need a fresh one."""
    node, units = _numbers(rows, name), _units(rows.column("embedding"))
    sims = units @ units.T
    sims[node[:, None] == node[None, :]] = -2
    if fresh is not None:
        sims[~(fresh[:, None] | fresh[None, :])] = -2
    kth = np.partition(sims, -min(k, len(node)), axis=1)[:, -min(k, len(node))]
    a, b = np.nonzero((sims >= FLOOR) & ((sims >= kth[:, None]) | (sims >= link)))
    return _listed(node[a], node[b], sims[a, b])


def _kept(lists: DataFrame, k: int, link: float) -> DataFrame:
    """The lists cut to their nearest ``k``, or as far as possible links go.

    ``lists`` has a row per find, ``old`` for those of the round before.
    """
    once = lists.groupBy("a", "b").agg(F.max("sim").alias("sim"), (~F.max("old")).alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("rank", rank).where((F.col("rank") <= k) | (F.col("sim") >= link)).drop("rank")


def _planted(nodes: DataFrame, trees: list[int], centres: dict, k: int, link: float, leaf: int) -> DataFrame:
    """Lists from the leaves of new trees."""

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("space", "tree"), leaf):
            yield _nearest(rows, "node", k, link)

    return _forest(nodes, trees, centres).mapInArrow(leaves, "a long, b long, sim double")


def descend(lists: DataFrame, nodes: DataFrame, k: int, link: float, rounds: int) -> DataFrame:
    """Rounds of NN-descent over ``lists`` (a, b, sim, fresh) of ``nodes`` (node, embedding).

    In each round a node's neighbours, and those that list it, are joined with one another
    where one of the two is fresh. A hub's members are sorted and joined in runs, so none
    gathers in one task. Ends when few places change.
    """
    n = nodes.count()
    vectors = nodes.select(F.col("node").alias("member"), "embedding")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("pivot",), JOINED):
            fresh = _numbers(rows, "fresh").astype(bool)
            if rows.num_rows > 1 and fresh.any():
                yield _nearest(rows, "member", k, link, fresh)

    for at in range(rounds):
        fresh = lists.where("fresh").count()
        LOG.info("descent round %d: %d fresh of %d nodes", at, fresh, n)
        if fresh <= SETTLED * k * n and at:
            break
        ends = lists.select(F.col("a").alias("pivot"), F.col("b").alias("member"), "fresh").unionAll(
            lists.select(F.col("b").alias("pivot"), F.col("a").alias("member"), "fresh")
        )
        ends = ends.groupBy("pivot", "member").agg(F.max("fresh").alias("fresh"))
        order = ("pivot", "member")
        met = ends.join(vectors, "member").repartitionByRange(*order).sortWithinPartitions(*order)
        found = met.mapInArrow(meet, "a long, b long, sim double")
        both = lists.select("a", "b", "sim", F.lit(True).alias("old")).unionAll(found.withColumn("old", F.lit(False)))
        lists = written(_kept(both, k, link), "lists")
    return lists


def _tiled(side: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
    """Rows dealt to each tile of (own tile, every tile of the other side)."""
    mine = F.pmod(F.xxhash64("node"), F.col(own)).cast("int")
    pair = side.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
    first, second = ("mine", "other") if is_query else ("other", "mine")
    return pair.select(
        "qb", "hb", F.col(first).alias("qt"), F.col(second).alias("ht"), F.lit(is_query).alias("query"), "node", "weight", "embedding"
    )


def _links(members: DataFrame, lists: DataFrame, threshold: float, tile: int) -> DataFrame:
    """(node, ball, other, n): how many vectors of the ball ``other`` a node links to, if any."""
    angle = math.acos(threshold)
    balls = members.groupBy("ball").agg(
        F.max("angle").alias("reach"), F.sum("weight").alias("size"), F.count("*").alias("nodes")
    )
    pairs = lists.select("a", "b", "sim").unionAll(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))
    pairs = pairs.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    home = balls.select(F.col("ball").alias("b"), "reach", "size", F.col("nodes").alias("homes"))
    query = balls.select(F.col("ball").alias("a"), F.col("reach").alias("spread"), F.col("nodes").alias("queries"))
    apart = F.acos(F.least(F.greatest(F.col("sim"), F.lit(-1.0)), F.lit(1.0)))
    near = (
        pairs.join(home, "b")
        .join(query, "a")
        .withColumn("apart", apart)
        .where(F.col("apart") - F.col("reach") - F.col("spread") <= angle + MARGIN)
    )
    single = (F.col("homes") == 1) & (F.col("queries") == 1)
    asked = near.join(
        members.select(F.col("ball").alias("a"), "node", "weight", "embedding", "angle"), "a"
    ).withColumn(
        "decided",
        F.when(single, F.col("sim") >= threshold)
        .when(F.col("apart") + F.col("angle") + F.col("reach") <= angle - MARGIN, True)
        .when(F.col("apart") - F.col("angle") - F.col("reach") > angle + MARGIN, False),
    )
    asked = written(asked, "asked")
    sure = asked.where("decided").select("node", F.col("a").alias("ball"), F.col("b").alias("other"), F.col("size").alias("n"))
    open_ = asked.where("decided IS NULL").withColumnsRenamed({"a": "qb", "b": "hb"})
    tiles = lambda c: F.ceil(F.col(c) / tile).cast("int")
    open_ = open_.withColumn("q_tiles", tiles("queries")).withColumn("h_tiles", tiles("homes"))
    needed = open_.select("qb", "hb", "q_tiles", "h_tiles").distinct()
    homes = needed.join(members.select(F.col("ball").alias("hb"), "node", "weight", "embedding"), "hb")
    dealt = _tiled(open_, "q_tiles", "h_tiles", True).unionAll(_tiled(homes, "h_tiles", "q_tiles", False))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, ("qb", "hb", "qt", "ht"), 1 << 62):
            is_query = _numbers(rows, "query").astype(bool)
            units, node, weight = _units(rows.column("embedding")), _numbers(rows, "node"), _numbers(rows, "weight")
            linked = units[is_query] @ units[~is_query].T >= threshold
            n = linked @ weight[~is_query]
            hit = n > 0
            ball, other = rows.column("qb")[0].as_py(), rows.column("hb")[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[is_query][hit]),
                    pa.array(np.full(hit.sum(), ball)),
                    pa.array(np.full(hit.sum(), other)),
                    pa.array(n[hit].astype(np.int64)),
                ],
                names=["node", "ball", "other", "n"],
            )

    order = ("qb", "hb", "qt", "ht")
    tested = dealt.repartition(*order).sortWithinPartitions(*order).mapInArrow(
        compare, "node long, ball long, other long, n long"
    )
    return sure.unionAll(tested)


def audit(nodes: DataFrame, n_links: DataFrame, threshold: float = THRESHOLD, audited: int = AUDITED) -> float:
    """Share of the links of sampled nodes that ``n_links`` (node, n) holds; 1 if there are none.

    The sample, by hash, is compared with all nodes; only it and its counts pass the driver.
    """
    picked = nodes.orderBy(F.xxhash64("node", F.lit(SEED)), "node").limit(audited)
    kinds = {}
    for r in picked.select("space", "node", "embedding").collect():
        kinds.setdefault(r["space"], []).append((r["node"], r["embedding"]))
    sample = {
        space: (np.array([n for n, _ in own]), _units(pa.array([list(e) for _, e in own]))) for space, own in kinds.items()
    }

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces = batch.column("space").to_numpy(zero_copy_only=False)
            for space in set(spaces.tolist()) & sample.keys():
                rows = batch.take(pa.array(np.flatnonzero(spaces == space)))
                node, units = sample[space]
                linked = units @ _units(rows.column("embedding")).T >= threshold
                linked &= node[:, None] != _numbers(rows, "node")[None, :]
                true = linked @ _numbers(rows, "weight")
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(true.astype(np.int64))], names=["node", "n"])

    true = nodes.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("true"))
    copies = picked.select("node", (F.col("weight") - 1).alias("copies"))
    found = copies.join(true, "node").join(n_links, "node", "left")
    seen, all_ = found.agg(F.sum(F.coalesce("n", "copies") - F.col("copies")), F.sum("true")).first()
    return 1.0 if not all_ else seen / all_


def _trees(nodes: DataFrame, threshold: float, leaf: int) -> int:
    """Trees that meet a pair at the threshold with probability ``MET``, from the largest space."""
    most = nodes.groupBy("space").count().agg(F.max("count")).first()[0] or 0
    depth = max(0.0, math.log2(max(most, 1) / leaf))
    met = (1 - math.acos(threshold) / math.pi) ** depth
    return 1 if met >= MET else math.ceil(math.log(1 - MET) / math.log(1 - met))


def near_vectors(
    rows: DataFrame,
    threshold: float = THRESHOLD,
    k: int = K,
    leaf: int = LEAF,
    tile: int = TILE,
    recall: float = RECALL,
    carry: tuple[str, ...] = (),
    on_audit: Callable[[float], None] | None = None,
) -> DataFrame:
    """Links of ``rows`` (vec_id, embedding, label) of one label at a cosine of ``threshold``.

    One row per input row: vec_id, the columns of ``carry``, n_links (other rows linked
    directly), component_id (least vec_id reachable, itself included; null if none has one)
    and kept (vec_id equals component_id, or both are null). Null, empty and zero vectors,
    those with null or non-finite components and those without a label link with nothing;
    so do vectors of unlike length. Repeated rows link with each other. Other columns are
    ignored. ``on_audit`` is told the recall of each audit.
    """
    kind = rows.schema["embedding"].dataType.elementType
    if not isinstance(kind, (T.FloatType, T.DoubleType)):
        rows = rows.withColumn("embedding", F.col("embedding").cast("array<double>"))
    own = [c for c in carry if c not in ("vec_id", "embedding", "label")]
    marked = rows.select("vec_id", "embedding", "label", *(F.col(c).alias(f"c_{i}") for i, c in enumerate(own)))
    digest = F.struct(F.xxhash64("embedding").alias("x"), F.xxhash64(F.lit(SEED), "embedding").alias("y"))
    marked = written(
        marked.select(
            "*",
            F.monotonically_increasing_id().alias("e_row"),
            usable(F.col("embedding"), F.col("label")).alias("usable"),
            F.concat_ws(":", F.size("embedding"), F.col("label").cast("string")).alias("space"),
            digest.alias("digest"),
        ),
        "vectors",
    )
    nodes = written(_classes(marked), "vector-nodes")
    angle = math.acos(threshold)
    radius = angle / 2 - MARGIN
    centres = _centres(nodes)
    members = written(_balls(nodes.drop("digest", "least"), radius, centres, leaf), "members")
    leaders = members.where("node = ball")
    # Leaders farther apart than this have no linked members.
    link = math.cos(min(math.pi, angle + 2 * radius + MARGIN))
    trees = _trees(leaders, threshold, leaf)
    n_links = edges = None
    lists = None
    for at in range(AUDITS):
        more = _planted(leaders, list(range(at * trees, (at + 1) * trees)), centres, k, link, leaf).withColumn("old", F.lit(False))
        if lists is not None:
            more = more.unionAll(lists.select("a", "b", "sim", F.lit(True).alias("old")))
        lists = descend(written(_kept(more, k, link), "lists"), leaders, k, link, ROUNDS)
        between = written(_links(members, lists, threshold, tile), "links")
        sizes = members.groupBy("ball").agg(F.sum("weight").alias("size"))
        sums = between.groupBy("node").agg(F.sum("n").alias("across"))
        n_links = written(
            members.select("node", "ball")
            .join(sizes, "ball")
            .join(sums, "node", "left")
            .select("node", "ball", (F.col("size") - 1 + F.coalesce("across", F.lit(0))).alias("n")),
            "link-counts",
        )
        edges = between.select(F.col("ball").alias("a"), F.col("other").alias("b"))
        seen = audit(nodes, n_links.select("node", "n"), threshold)
        LOG.info("audit %d: recall %.4f", at, seen)
        if on_audit is not None:
            on_audit(seen)
        if seen >= recall:
            break
    roots = components(edges).select(F.col("node").alias("ball"), "root")
    placed = (
        n_links.join(roots, "ball", "left")
        .withColumn("root", F.coalesce("root", "ball"))
        .join(nodes.select("node", "space", "digest", "least"), "node")
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component"))
    found = placed.join(least, "root").select("space", "digest", "n", "component", F.lit(True).alias("usable"))
    all_rows = marked.drop("embedding", "label").join(found, ["usable", "space", "digest"], "left")
    component = F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
    return all_rows.select(
        "vec_id",
        *(F.col(f"c_{i}").alias(c) for i, c in enumerate(own)),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
