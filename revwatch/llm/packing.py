"""Packing documents into fixed-length training sequences (operator 7).

Tasks tokenize and cut; what leaves them is one small row per piece. A piece's length is
all that packing depends on, so the instance is the histogram of lengths: at most
``capacity`` rows, whatever the corpus. On it the Martello-Toth dominance test fixes
sets of one or two pieces that no other filling beats, the instance shrinks, and best-fit
decreasing packs the rest. Identical bins are one pattern with a multiplicity, so the
plan too is bounded by the capacity. Pieces then find their place by their rank among
those of their length: an ordinal within the task, counted while it tokenized, and a
prefix sum over tasks.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_right, insort
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revwatch.llm.common import written

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker keeps (about 200 bytes each); a full store is emptied.
CACHED_WORDS = 500_000
#: Words that are looked up together.
GROUP_WORDS = 1_000_000
WORD_BYTES = 6  # about
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # white space to Python alone
_MARK_AFTER_MARK = re.compile(r"(?:[^\w\s]|_)[.,]\s")
#: Texts, some more among them, whose words are not found by lower-casing, replacing and splitting
#: at ASCII white space; for Arrow, where classes like \s are ASCII.
_ODD = r"[\x1c-\x1f\x{85}\x{a0}]|[^\x{00}-\x{ff}]|<\||[^\pL\pN\t\n\f\r ][.,][\t-\r ]"

Bins = list[tuple[int, list[tuple[int, int]]]]  # (how many such bins, [(length, pieces of it in each bin)])


class WordTokens:
    """Ids of whole texts, put together from the ids of their words.

    The vocabulary drops white space, lower-cases, and joins neither words nor letters with
    marks, so a text's ids are those of its words, and a full stop or comma that closes a
    word may stand alone; each different word is tokenized once. Tests compare with whole
    texts.
    """

    def __init__(self, path: str, cached: int = CACHED_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        # Two generations: when the younger is full it takes the older one's place, and words
        # that are met again come back from there. Frequent words are never lost.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def words(text: str) -> list[str]:
        """Parts of the text whose ids, in order, are the text's."""
        if any(c in text for c in _SEPARATORS):
            return text.split(" ")
        try:
            text.encode("latin-1")  # letters that lower-case one for one and do not compose
        except UnicodeEncodeError:
            return text.split()
        # "<|" may begin a special token, which is matched by its case.
        if "<|" in text or _MARK_AFTER_MARK.search(text):
            return text.split()
        return text.lower().replace("\n", " ").replace(". ", " . ").replace(", ", " , ").split()

    def _know(self, words: set[str]) -> None:
        missing = words.difference(self.known)
        if len(self.known) + len(missing) > self.cached // 2:
            self.known, self.older = {}, self.known
            missing = words
        known, older = self.known, self.older
        new = []
        for word in missing:  # an intersection with a dictionary would walk all of it
            coded = older.get(word)
            if coded is None:
                new.append(word)
            else:
                known[word] = coded
        for at in range(0, len(new), 1000):  # encodings die young, before garbage is looked for
            some = new[at : at + 1000]
            coded = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update(zip(some, [array("I", c.ids).tobytes() for c in coded], strict=True))

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, one after another, and where each word's ids end."""
        ids, ends, before = [], [], 0
        for at in range(0, len(words), GROUP_WORDS):
            coded = words.slice(at, GROUP_WORDS).dictionary_encode()
            different = coded.dictionary.to_pylist()
            self._know(set(different))
            own = list(map(self.known.__getitem__, different))
            sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
            starts = np.cumsum(sizes) - sizes
            places = coded.indices.to_numpy()
            sizes = sizes[places]
            end = np.cumsum(sizes)
            from_start = np.repeat(starts[places] - (end - sizes), sizes)
            ids.append(np.frombuffer(b"".join(own), "<u4")[from_start + np.arange(len(from_start))])
            ends.append(end + before)
            before += len(from_start)
        return np.concatenate([np.empty(0, "<u4"), *ids]), np.concatenate([np.zeros(1, np.int64), *ends])

    def _texts_ids(self, lists: pa.ListArray) -> Iterator[bytes]:
        """Ids of texts, given as lists of their words."""
        ids, ends = self._ids(lists.flatten())
        words = np.cumsum([0, *pc.list_value_length(lists).to_pylist()])
        places = ends[words].tolist()
        return (ids[a:b].tobytes() for a, b in zip(places, places[1:]))

    def _group(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, _ODD)
        plain = pc.utf8_lower(texts.filter(pc.invert(odd)))
        for mark, apart in (("\n", " "), (". ", " . "), (", ", " , ")):
            plain = pc.replace_substring(plain, mark, apart)
        of_plain = self._texts_ids(pc.ascii_split_whitespace(plain))
        others = [self.words(text) for text in texts.filter(odd).to_pylist()]
        of_others = self._texts_ids(pa.array(others, pa.list_(pa.string())))
        return (next(of_others if own else of_plain) for own in odd.to_pylist())

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; a null text has none.

        Texts are taken in groups of about ``GROUP_WORDS`` words, whose different words are
        looked up once. Arrow does for plain texts what :meth:`words` does for the others.
        """
        column = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        column = pc.fill_null(column, "")
        first = size = 0
        for row, own in enumerate(pc.binary_length(column).to_pylist()):
            if row > first and size + own > WORD_BYTES * GROUP_WORDS:
                yield from self._group(column.slice(first, row - first))
                first, size = row, 0
            size += own
        yield from self._group(column.slice(first))


@lru_cache(maxsize=2)
def _tokens(path: str, cached: int) -> WordTokens:
    return WordTokens(path, cached)


def tokenized_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, cached: int = CACHED_WORDS
) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every whole text of ``docs`` (doc_id, text)."""
    wanted = docs.select("doc_id", "text")
    fields = [
        wanted.schema["doc_id"],
        T.StructField("piece", T.IntegerType()),
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "chunk", "ordinal")),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
    ]
    tail = np.array([END_ID], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, chunk = _tokens(path, cached), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows, out = [], []
            for row, ids in enumerate(tokens.encode(batch.column("text"))):
                data = ids + tail
                for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                    own = data[at : at + 4 * capacity]
                    size = len(own) // 4
                    rows.append(row)
                    kept = own if keep_ids else None
                    out.append((piece, at // 4, size, zlib.crc32(own), chunk, int(seen[size]), kept))
                    seen[size] += 1
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()][: 6 + keep_ids]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=False)),
                ],
                names=[f.name for f in fields],
            )

    return wanted.mapInArrow(cut, T.StructType(fields))


class _Left:
    """Lengths not yet packed, with their numbers."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n}
        self.sizes = sorted(self.counts)

    def take(self, length: int, n: int) -> None:
        self.counts[length] -= n
        if not self.counts[length]:
            del self.counts[length]
            self.sizes.remove(length)

    def add(self, length: int, n: int) -> None:
        if length not in self.counts:
            insort(self.sizes, length)
        self.counts[length] = self.counts.get(length, 0) + n

    def smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for size in self.sizes[:k]:
            out += [size] * min(self.counts[size], k - len(out))
        return out[:k]

    def largest_at_most(self, room: int) -> int | None:
        i = bisect_right(self.sizes, room)
        return self.sizes[i - 1] if i else None


def _best_pair(left: _Left, room: int) -> int:
    """The largest sum of two pieces that fits."""
    best, sizes = 0, left.sizes
    hi = bisect_right(sizes, room) - 1
    for lo, a in enumerate(sizes):
        while hi >= 0 and a + sizes[hi] > room:
            hi -= 1
        if hi < lo or best == room:
            break
        if hi > lo or left.counts[a] > 1:
            best = max(best, a + sizes[hi])
        elif hi - 1 >= 0 and hi - 1 > lo:
            best = max(best, a + sizes[hi - 1])
    return best


def reduce_instance(counts: dict[int, int], capacity: int) -> tuple[Bins, dict[int, int]]:
    """Bins fixed by dominance, and what is left.

    For the largest piece j, let i be the largest that fits beside it. {j} is fixed if
    nothing fits; {j, i} if i fills the bin, if no two pieces fit beside j, or if no three
    do and no fitting pair outweighs i. In each case the pieces of any other filling of j's bin can
    be put in i's place, so some best packing has the fixed bin.
    """
    left, fixed = _Left(counts), []
    below = capacity + 1
    while (head := left.largest_at_most(below - 1)) is not None:
        left.take(head, 1)  # what may lie beside it is all the rest, longer pieces too
        n = 1 + left.counts.get(head, 0)
        room = capacity - head
        i = left.largest_at_most(room)
        few = left.smallest(3)
        if i is None:
            k, beside = n, []
        elif (
            i == room
            or sum(few[:2]) > room
            or len(few) < 2
            or ((len(few) < 3 or sum(few) > room) and _best_pair(left, room) <= i)
        ):
            # Taking pieces away only strengthens the conditions, so they hold as long as i lasts.
            k, beside = (n // 2, [head]) if i == head else (min(n, left.counts[i]), [i])
        else:
            left.add(head, 1)
            below = head
            continue
        left.add(head, 1)
        for length in (head, *beside):
            left.take(length, k)
        fixed.append((k, [(head, 2)] if beside == [head] else [(x, 1) for x in (head, *beside)]))
    return fixed, dict(left.counts)


def best_fit(counts: dict[int, int], capacity: int) -> Bins:
    """Best-fit decreasing, over bins that are alike at once."""
    by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    rooms: list[int] = []

    def put(room: int, n: int, pattern: list[tuple[int, int]]) -> None:
        if n:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append((n, pattern))

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n:
            at = bisect_right(rooms, length - 1)
            if at == len(rooms):
                room, have, pattern = capacity, n, []
            else:
                room = rooms[at]
                have, pattern = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room]
                    rooms.pop(at)
            each = room // length
            full = min(have, n // each)
            put(room - each * length, full, [*pattern, (length, each)])
            n -= full * each
            have -= full
            if have and 0 < n < each:
                put(room - n * length, 1, [*pattern, (length, n)])
                n, have = 0, have - 1
            if pattern:
                put(room, have, pattern)
    return [bins for groups in by_room.values() for bins in groups]


def pack_lengths(counts: dict[int, int], capacity: int = CAPACITY) -> Bins:
    """All bins for a histogram of lengths."""
    fixed, rest = reduce_instance(counts, capacity)
    return fixed + best_fit(rest, capacity)


def _places(bins: Bins) -> dict[int, np.ndarray]:
    """Per length, by rank: (first rank, first sequence, pieces a bin, offset)."""
    next_rank: dict[int, int] = {}
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    sequence = 0
    for n, pattern in bins:
        offset = 0
        for length, each in pattern:
            rank = next_rank.get(length, 0)
            out.setdefault(length, []).append((rank, sequence, each, offset))
            next_rank[length] = rank + n * each
            offset += length * each
        sequence += n
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, keep_ids: bool = False, cached: int = CACHED_WORDS
) -> DataFrame:
    """Packs every text of ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and the
    ids themselves (little-endian, 32 bits) if asked for. A null or empty text is its end
    token alone; repeated rows are packed each by itself; an empty table gives no rows;
    other columns are ignored. ``cached`` words a worker keeps save time for memory.
    """
    spark = docs.sparkSession
    pieces = written(tokenized_pieces(docs, path, capacity, keep_ids, cached), "pieces")
    per_chunk = pieces.groupBy("length", "chunk").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(
        per_chunk.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-ranks"
    )
    counts = {r.length: r.n for r in bases.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(_places(pack_lengths(counts, capacity)))
    # A row per length and task: small as a file, but growing with the corpus, so not broadcast.
    ranked = pieces.join(bases.drop("n").hint("merge"), ["length", "chunk"]).withColumn(
        "rank", F.col("before") + F.col("ordinal")
    )
    kept = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else []), "rank"]
    fields = [ranked.schema[c] for c in kept[:-1]]
    places = [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for length in np.unique(lengths):
                own = lengths == length
                first, base, each, at = plan.value[int(length)].T
                slot = np.searchsorted(first, ranks[own], "right") - 1
                inside = ranks[own] - first[slot]
                sequence[own] = base[slot] + inside // each[slot]
                offset[own] = at[slot] + inside % each[slot] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in fields), pa.array(sequence), pa.array(offset)],
                names=[f.name for f in (*fields, *places)],
            )

    return ranked.select(*kept).mapInArrow(place, T.StructType([*fields, *places]))
