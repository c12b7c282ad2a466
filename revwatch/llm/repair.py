"""Conversation structure repair by grammar-compressed dynamic programming (operator 12).

A row is a symbol of its role and fault. Over the sequences of all conversations a Re-Pair
grammar is learnt: each round counts neighbouring symbols and gives the most frequent pairs
a rule. A symbol acts on four states (nothing yet, after system, user, assistant) as a min-plus
matrix of edit costs, whose entries carry the audit of their edits as a rope. A rule's matrix
is the product of those of its two symbols, built once, bottom-up, and used by all
conversations; a conversation multiplies what its sequence has shrunk to.

Inserts stand before an edit of a row, so audits of the same rows never are prefixes of
one another: the least of equal cost is found from the ranks of parts, without their text.

Rows are sorted across partitions of even size and cut into segments. A conversation in one
segment is repaired where it lies. Of one that is longer, or lies on a partition's edge,
each segment has its own matrix; a row of costs and ranks per segment then picks the states
at the cuts.
"""

from __future__ import annotations

import functools
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import written

#: Rows, and characters of text, of a segment.
ROWS, CHARS = 4_096, 1 << 20
#: Rounds of the grammar, new rules in each, and the occurrences that earn a rule.
ROUNDS, RULES, SEEN = 8, 128, 2
#: Sequences, no longer than _SHORT, whose repair a worker remembers.
_REMEMBERED, _SHORT = 1 << 16, 64

DELETE, CHANGE, CUT_OFF = 4, 3, 3
_MOST = (1 << 63) - 1
SPACE = " \t\n\x0b\f\r"
ENDS = (".", "!", "?")
LEGAL = ("su", "ua", "au")
#: Symbols: system, user, assistant, other; lower case if cut off; to be deleted.
SYMBOLS = "SUAXsuaxD"
#: States: nothing yet, after system, after user, after assistant; then what may follow.
_NEXT = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_AFTER = {"s": 1, "u": 2, "a": 3}
_INSERTS = {0: {0: "", 2: "I", 3: "II"}, 1: {1: "", 2: "I", 3: "II"}, 2: {2: "", 3: "I"}, 3: {3: "", 2: "I"}}
#: Inserts that end a conversation well.
_ENDING = {0: "", 1: "II", 2: "I", 3: ""}

#: state -> state -> (cost, rank of the audit, audit as a rope: text or a pair of ropes)
Matrix = dict[int, dict[int, tuple]]


def _ranked(best: dict[tuple[int, int], tuple]) -> Matrix:
    """A matrix from (from, to) -> (cost, sortable audit, rope)."""
    rank = {key: at for at, key in enumerate(sorted({key for _, key, _ in best.values()}))}
    out: Matrix = {}
    for (i, j), (cost, key, rope) in best.items():
        out.setdefault(i, {})[j] = (cost, rank[key], rope)
    return out


def symbol_matrix(symbol: str) -> Matrix:
    """Inserts, then one edit of a row with this symbol."""
    role, cut_off = symbol.lower(), CUT_OFF if symbol.islower() else 0
    best: dict[tuple[int, int], tuple] = {}
    for i, reached in _INSERTS.items():
        for k, inserts in reached.items():
            edits = [("D", k, DELETE)]
            if symbol != "D":
                edits.append(("R", _AFTER[_NEXT[k][0]], CHANGE + cut_off))
                if role in _AFTER and (role == "s" and k == 0 or role == _NEXT[k][0]):
                    edits.append(("K", _AFTER[role], cut_off))
            for edit, j, cost in edits:
                audit = inserts + edit
                found = (CHANGE * len(inserts) + cost, audit, audit)
                best[i, j] = min(best.get((i, j), found), found)
    return _ranked(best)


def times(left: Matrix, right: Matrix) -> Matrix:
    """The min-plus product; equal costs go to the audit that is ASCII-least."""
    best: dict[tuple[int, int], tuple] = {}
    for i, row in left.items():
        for k, (a_cost, a_rank, a_rope) in row.items():
            for j, (b_cost, b_rank, b_rope) in right.get(k, {}).items():
                found = (a_cost + b_cost, (a_rank, b_rank))
                if (i, j) not in best or found < best[i, j][:2]:
                    best[i, j] = (*found, (a_rope, b_rope))
    return _ranked(best)


def text_of(rope) -> str:
    parts, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(parts)


def replaced(sequence: list[int], rules: dict[tuple[int, int], int]) -> list[int]:
    """Left to right, pairs that have a rule; the more frequent of two that overlap goes first."""
    out, i, n = [], 0, len(sequence)
    while i < n:
        rule = rules.get(tuple(sequence[i : i + 2]))
        if rule is not None and rules.get(tuple(sequence[i + 1 : i + 3]), rule) >= rule:
            out.append(rule)
            i += 2
        else:
            out.append(sequence[i])
            i += 1
    return out


class Grammar:
    """Rules by round, lesser numbers for more frequent pairs, and a matrix for each symbol."""

    def __init__(self, rounds: list[dict[tuple[int, int], int]]):
        self.rounds = rounds
        self.matrices = [symbol_matrix(s) for s in SYMBOLS]
        for rules in rounds:
            for (left, right), _ in sorted(rules.items(), key=lambda x: x[1]):
                self.matrices.append(times(self.matrices[left], self.matrices[right]))

    def compressed(self, symbols: str) -> list[int]:
        sequence = [SYMBOLS.index(s) for s in symbols]
        for rules in self.rounds:
            sequence = replaced(sequence, rules)
        return sequence

    def matrix(self, symbols: str, starts: tuple[int, ...]) -> Matrix:
        """Of a whole sequence, from the given states."""
        out: Matrix = {i: {i: (0, 0, "")} for i in starts}
        for symbol in self.compressed(symbols):
            out = times(out, self.matrices[symbol])
        return out

    def best(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of the cheapest repair."""
        if not symbols:
            return 0, ""
        ends = self.matrix(symbols, (0,))[0]
        cost, _, rope, j = min((c + CHANGE * len(_ENDING[j]), r, rope, j) for j, (c, r, rope) in ends.items())
        return cost, text_of(rope) + _ENDING[j]


def learn(symbols: DataFrame, rounds: int = ROUNDS, rules: int = RULES) -> Grammar:
    """A grammar over the distinct sequences of ``symbols``; only its rules pass the driver."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [[SYMBOLS.index(s) for s in text.as_py()] for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], names=["sequence"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs: Counter = Counter()
            for own in batch.column("sequence").to_pylist():
                pairs.update(zip(own, own[1:]))
            found = [(*pair, n) for pair, n in pairs.items()]
            columns = zip(*found, strict=True) if found else ([], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["l", "r", "n"])

    def shrink(batches: Iterator[pa.RecordBatch], chosen: dict) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [replaced(s, chosen) for s in batch.column("sequence").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.int32()))], names=["sequence"])

    sequences = symbols.select("symbols").distinct().mapInArrow(number, "sequence array<int>")
    sequences = written(sequences.where("size(sequence) > 1"), "sequences")
    found: list[dict[tuple[int, int], int]] = []
    first = len(SYMBOLS)
    for _ in range(rounds):
        pairs = sequences.mapInArrow(count, "l long, r long, n long").groupBy("l", "r").agg(F.sum("n").alias("n"))
        top = pairs.where(F.col("n") >= SEEN).orderBy(F.desc("n"), "l", "r").limit(rules).collect()
        if not top:
            break
        chosen = {(x.l, x.r): first + at for at, x in enumerate(top)}
        found.append(chosen)
        first += len(chosen)
        step = functools.partial(shrink, chosen=chosen)
        sequences = written(sequences.mapInArrow(step, sequences.schema).where("size(sequence) > 1"), "sequences")
    return Grammar(found)


def is_blank(text: str) -> bool:
    return not text.strip(SPACE)


def symbol(role: str, text: str, repeated: bool) -> str:
    if repeated or is_blank(text):
        return "D"
    own = role[:1] if role[:1] in _AFTER else "x"
    return own.upper() if text.rstrip(SPACE).endswith(ENDS) else own


def repaired(audit: str, roles: list[str], texts: list[str], state: int = 0) -> list[dict[str, str]]:
    """The rows that the edits of ``audit`` make, from a state on."""
    out, at = [], 0
    for edit in audit:
        if edit != "D":
            role = roles[at] if edit == "K" else _NEXT[state]
            out.append({"role": role, "text": "" if edit == "I" else texts[at]})
            state = _AFTER[role[:1]]
        at += edit != "I"
    return out


def _key(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass")).digest()


_MESSAGES = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ORDER = ("o_turn", "o_tie", "o_row")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text; nulls are one space) with faults by a checksum.

    A dropped row stays with ``present`` false, so that its conversation keeps its name.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    text, role = blank("text"), blank("role")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.sequence(F.lit(0), F.when(F.col("fault") == 3, 1).otherwise(0))).alias("copy"),
    ).drop("copy")


def _segments(rows: DataFrame) -> DataFrame:
    """Rows of each conversation in order, cut into bounded segments.

    ``whole`` marks conversations known to lie in one segment; their symbols are final.
    """
    tie = F.md5(F.concat_ws(":", "role", "text"))
    placed = rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("o_turn"),
        tie.alias("o_tie"),
        F.monotonically_increasing_id().alias("o_row"),
        "role",
        "text",
        "present",
    )
    order = ("conv_id", *_ORDER)
    strings = T.ArrayType(T.StringType())
    schema = T.StructType(
        [
            *(placed.schema[c] for c in order),
            T.StructField("whole", T.BooleanType()),
            T.StructField("turns", T.ArrayType(T.LongType())),
            T.StructField("roles", strings),
            T.StructField("texts", strings),
            T.StructField("symbols", T.StringType()),
            T.StructField("keys", T.ArrayType(T.BinaryType())),
        ]
    )
    names = schema.names

    def made(first: tuple, own: list[tuple], whole: bool) -> tuple:
        turns, roles, texts = ([x[at] for x in own] for at in range(3))
        if not whole:
            return (*first, whole, turns, roles, texts, "", list(map(_key, roles, texts)))
        seen: set[tuple[str, str]] = set()
        marks = []
        for role, text in zip(roles, texts, strict=True):
            marks.append(symbol(role, text, (role, text) in seen))
            seen.add((role, text))
        return (*first, whole, turns, roles, texts, "".join(marks), [])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] = []
        out: list[tuple] = []

        def full() -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        conv = first = None
        own: list[tuple] = []
        size = held = cuts = 0
        edge, began = True, False  # edge: the partition's first conversation may begin in another
        for batch in batches:
            types = types or [
                *(batch.schema.field(c).type for c in order),
                pa.bool_(),
                pa.list_(pa.int64()),
                *(pa.list_(pa.string()),) * 2,
                pa.string(),
                pa.list_(pa.binary()),
            ]
            for conv_id, turn, tie_, row, role, text, present in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if began and (conv_id != conv or len(own) >= ROWS or size >= CHARS):
                    other = conv_id != conv
                    out.append(made(first, own, other and not edge and not cuts))
                    held += size
                    own, size, first = [], 0, None
                    cuts, edge = (0, False) if other else (cuts + 1, edge)
                    if len(out) >= 1_000 or held >= CHARS:
                        yield full()
                        held = 0
                conv, began = conv_id, True
                first = first or (conv_id, turn, tie_, row)
                if present:
                    own.append((turn, role, text))
                    size += len(text)
        if began:
            out.append(made(first, own, False))
            yield full()

    return placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, schema)


def _with_duplicates(parts: DataFrame) -> DataFrame:
    """The symbols of segments whose conversations may reach beyond them."""
    place = F.struct(F.col("o_turn").isNotNull().alias("t"), *_ORDER, "at")
    each = parts.select("conv_id", *_ORDER, F.posexplode("keys").alias("at", "key"))
    first = each.groupBy("conv_id", "key").agg(F.min(place).alias("first"))
    same = each.conv_id.eqNullSafe(first.conv_id) & (each.key == first.key)
    again = (
        each.join(first, same)
        .where((F.col("first.o_row") != F.col("o_row")) | (F.col("first.at") != F.col("at")))
        .groupBy("o_row")
        .agg(F.collect_list("at").alias("again"))
    )
    marked = parts.drop("symbols", "keys").join(again, "o_row", "left")
    schema = T.StructType([*marked.drop("again").schema.fields, T.StructField("symbols", T.StringType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for roles, texts, again in zip(*(batch.column(c).to_pylist() for c in ("roles", "texts", "again")), strict=True):
                again = set(again or ())
                out.append("".join(symbol(r, t, at in again) for at, (r, t) in enumerate(zip(roles, texts, strict=True))))
            kept = [c for c in batch.schema.names if c != "again"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(out, pa.string())], names=[*kept, "symbols"])

    return marked.mapInArrow(mark, schema)


def _faults(symbols: str, roles: list[str], texts: list[str]) -> tuple[int, int, int, int]:
    """blank, duplicate, truncated, illegal"""
    blank = sum(map(is_blank, texts))
    cut_off = sum(s.islower() for s in symbols)
    illegal = sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:]))
    return blank, symbols.count("D") - blank, cut_off, illegal


def _gaps(turns: list[int | None]) -> int:
    own = {t for t in turns if t is not None}
    return min(max(own) - min(own) + 1 - len(own), _MOST) if own else 0


def _wholes(segments: DataFrame, grammar) -> DataFrame:
    """Conversations of one segment."""
    schema = T.StructType(
        [
            segments.schema["conv_id"],
            *(T.StructField(c, T.LongType()) for c in _COUNTS),
            T.StructField("audit", T.StringType()),
            T.StructField("repaired", _MESSAGES),
        ]
    )
    messages = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = functools.lru_cache(_REMEMBERED)(grammar.value.best)
        for batch in batches:
            counts, audits, out = [], [], []
            for symbols, turns, roles, texts in zip(
                *(batch.column(c).to_pylist() for c in ("symbols", "turns", "roles", "texts")), strict=True
            ):
                cost, audit = (best if len(symbols) <= _SHORT else grammar.value.best)(symbols)
                counts.append((_gaps(turns), *_faults(symbols, roles, texts), cost))
                audits.append(audit)
                out.append(repaired(audit, roles, texts))
            columns = zip(*counts, strict=True) if counts else [[]] * len(_COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(audits, pa.string()), pa.array(out, messages)],
                names=schema.names,
            )

    return segments.mapInArrow(mend, schema)


_STATES = tuple(_INSERTS)


def _joined(parts: DataFrame, grammar) -> DataFrame:
    """Conversations of several segments."""
    edges = "n long, first string, last string, lo long, hi long, turns long, first_turn long, last_turn long"
    kinds = f"o_row long, n_blank long, n_dup long, n_cut long, n_bad long, {edges}, costs array<long>, ranks array<long>"
    head = parts.select("conv_id", *_ORDER)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, symbols, turns, roles, texts in zip(
                *(batch.column(c).to_pylist() for c in ("o_row", "symbols", "turns", "roles", "texts")), strict=True
            ):
                matrix = grammar.value.matrix(symbols, _STATES)
                entries = [matrix.get(i, {}).get(j, (-1, -1)) for i in _STATES for j in _STATES]
                known = [t for t in turns if t is not None]
                span = (known[0], known[-1], len(set(known)), known[0], known[-1]) if known else (None, None, 0, None, None)
                ends = (roles[0][:1], roles[-1][:1]) if roles else (None, None)
                out.append(
                    (row, *_faults(symbols, roles, texts), len(roles), *ends, *span, [e[0] for e in entries], [e[1] for e in entries])
                )
            names = [x.split()[0] for x in kinds.split(", ")]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            types = {"long": pa.int64(), "string": pa.string(), "array<long>": pa.list_(pa.int64())}
            arrow = [pa.array(c, types[k.split()[1]]) for c, k in zip(columns, kinds.split(", "), strict=True)]
            yield pa.RecordBatch.from_arrays(arrow, names=names)

    weighed = head.join(parts.mapInArrow(weigh, kinds), "o_row")
    counts = weighed.groupBy("conv_id").agg(
        F.sum("n_blank").alias("blank"), F.sum("n_dup").alias("duplicate"), F.sum("n_cut").alias("truncated")
    )
    picked_kind = "o_row long, o_at long, start int, stop int, cost long, gaps long, cuts long, bad long"

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        """The states at a conversation's cuts, from a row per segment."""
        rows = rows.sort_values(list(_ORDER), na_position="first").reset_index(drop=True)
        full = rows[rows["n"] > 0]
        at, back = {0: (0, 0)}, []  # state: cost, rank of the audit so far
        for costs, ranks in zip(full["costs"], full["ranks"], strict=True):
            best: dict[int, tuple] = {}
            for k, (cost, rank) in at.items():
                for j in _STATES:
                    if costs[4 * k + j] >= 0:
                        found = (cost + int(costs[4 * k + j]), (rank, int(ranks[4 * k + j])), k)
                        best[j] = min(best.get(j, found), found)
            order = {key: i for i, key in enumerate(sorted({x[1] for x in best.values()}))}
            at = {j: (cost, order[key]) for j, (cost, key, _) in best.items()}
            back.append({j: k for j, (_, _, k) in best.items()})
        cost, _, state = min((c + CHANGE * len(_ENDING[j]), r, j) for j, (c, r) in at.items())
        stops = []
        for step in reversed(back):
            stops.append((step[state], state))
            state = step[state]
        stops = stops[::-1]
        initials = list(zip(full["last"], full["first"].iloc[1:], strict=False))
        bad = int(full["n_bad"].sum()) + sum(a + b not in LEGAL for a, b in initials)
        known = full[full["lo"].notna()]
        gaps = 0
        if len(known):
            shared = int((known["last_turn"].iloc[:-1].to_numpy() == known["first_turn"].iloc[1:].to_numpy()).sum())
            gaps = min(int(known["hi"].iloc[-1]) - int(known["lo"].iloc[0]) + 1 - int(known["turns"].sum()) + shared, _MOST)
        n = len(full)
        if not n:  # all its rows were dropped
            only = int(rows["o_row"].iloc[0])
            return pd.DataFrame([(only, 0, 0, 0, 0, 0, 0, 0)], columns=[x.split()[0] for x in picked_kind.split(", ")])
        return pd.DataFrame(
            {
                "o_row": full["o_row"].to_numpy(),
                "o_at": np.arange(n),
                "start": [a for a, _ in stops],
                "stop": [b for _, b in stops],
                "cost": cost,
                "gaps": gaps,
                "cuts": n,
                "bad": bad,
            }
        )

    # Nullable longs would reach pandas as doubles.
    exact = {c: F.col(c).cast("decimal(20,0)") for c in ("lo", "hi", "first_turn", "last_turn", "o_turn")}
    small = weighed.drop("n_blank", "n_dup", "n_cut").withColumns(exact)
    picked = small.groupBy("conv_id").applyInPandas(pick, picked_kind)
    chosen = parts.drop("whole", "turns", "o_turn", "o_tie").join(picked, "o_row")
    schema = T.StructType(
        [
            *(chosen.schema[c] for c in ("conv_id", "o_at", "cost", "gaps", "bad")),
            T.StructField("audit", T.StringType()),
            T.StructField("repaired", _MESSAGES),
        ]
    )
    messages = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, out = [], []
            columns = ("symbols", "roles", "texts", "start", "stop", "o_at", "cuts")
            for symbols, roles, texts, start, stop, at, cuts in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                audit = text_of(grammar.value.matrix(symbols, (start,))[start][stop][2]) if symbols else ""
                audit += _ENDING[stop] if at + 1 == cuts else ""
                audits.append(audit)
                out.append(repaired(audit, roles, texts, start))
            kept = [batch.column(c) for c in schema.names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(audits, pa.string()), pa.array(out, messages)], names=schema.names)

    mended = chosen.mapInArrow(mend, schema)
    pieces = F.sort_array(F.collect_list(F.struct("o_at", "audit", "repaired")))
    joined = mended.groupBy("conv_id").agg(
        F.max("cost").alias("cost"), F.max("gaps").alias("gaps"), F.max("bad").alias("illegal"), pieces.alias("pieces")
    )
    return joined.join(counts.withColumnRenamed("conv_id", "c_id"), joined.conv_id.eqNullSafe(F.col("c_id"))).select(
        "conv_id", *_COUNTS, F.array_join("pieces.audit", "").alias("audit"), F.flatten("pieces.repaired").alias("repaired")
    )


def repair_conversations(rows: DataFrame) -> DataFrame:
    """The cheapest repair of each conversation in ``rows`` (conv_id, turn, role, text).

    One row per conv_id (null is one of its own): gaps, blank, duplicate, truncated, illegal,
    cost, audit (K keep, R change the role, D delete, I insert; of equal cost the ASCII-least)
    and ``repaired`` (role, text). Gaps beyond 64 bits are the largest long. Rows are taken by turn, nulls first; rows of one turn by
    the MD5 of ``role:text``, equal ones in any order. Null roles and texts are one space; an
    empty role has no initial and is never kept. Where a boolean column ``present`` is given,
    rows without it count for nothing but name their conversation. Other columns are
    ignored; an empty table gives no rows.
    """
    given = F.coalesce("present", F.lit(True)) if "present" in rows.columns else F.lit(True)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    wanted = rows.select("conv_id", "turn", blank("role"), blank("text"), given.alias("present"))
    segments = written(_segments(wanted), "segments")
    parts = written(_with_duplicates(segments.where("NOT whole")), "segment-parts")
    symbols = segments.where("whole").select("symbols").unionAll(parts.select("symbols"))
    grammar = rows.sparkSession.sparkContext.broadcast(learn(symbols))
    return _wholes(segments.where("whole"), grammar).unionByName(_joined(parts, grammar))


def repair_digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``repair_conversations``."""
    lines = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    return found.select("conv_id", *_COUNTS, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
