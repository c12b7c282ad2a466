"""Which monitored page does a record belong to?

A record matches a needle (a monitored title or alias) of the same wiki when
one normalised text contains the other. Precedence: exact title, exact alias,
containing title, containing alias; within each, list order.

Two plans give the same answer:

* ``broadcast``: the needles of a wiki travel as one array in one broadcast row,
  a left join on ``wiki`` adds it without fan-out, and a higher-order function
  picks the best match. No shuffle, no state, so it also runs on a stream. Only
  for a list whose length, known on the driver, is within ``BROADCAST_NEEDLES``.
* ``grams``: for longer lists, on batch frames. Containment becomes equality on
  short character grams, so needles and distinct titles meet in a shuffled
  equi-join and no side is broadcast by us or compared all against all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.functions.text import contains_either_way, normalize_title
from revwatch.session import written_once
from revwatch.sources.allowlist import Needle

#: Longest list that is broadcast: at 10,000 needles the row is a few MB.
BROADCAST_NEEDLES = 10_000

#: Length of the grams that stand for containment in the shuffled plan.
GRAM = 4

_NEEDLE_DDL = "wiki STRING, raw STRING, kind INT, position INT, canonical STRING"


def allowlist_frame(spark: SparkSession, allowlist: Sequence[Needle]) -> DataFrame:
    """One row per needle, with its normalised text."""
    rows = [(n.wiki, n.raw, n.kind, n.position, n.canonical) for n in allowlist]
    return spark.createDataFrame(rows, _NEEDLE_DDL).withColumn(
        "needle", normalize_title(F.col("raw"))
    )


def match_entity(
    df: DataFrame,
    allowlist: Sequence[Needle] | DataFrame,
    title: str = "title",
    wiki: str = "wiki",
    output: str = "canonical_entity",
    strategy: str | None = None,
) -> DataFrame:
    """Add the canonical page (``wiki:Title``) of each row, or null.

    ``allowlist`` is a driver-side list, or a needle frame as made by
    :func:`allowlist_frame` when the list itself is a table; a frame has no
    known length, so it always takes the shuffled plan. For a list the caller says
    which plan to take; the length only guards the broadcast.
    """
    if isinstance(allowlist, DataFrame):
        if strategy == "broadcast":
            raise ValueError("only a driver-side list has the known length a broadcast needs")
        return _match_by_grams(df, allowlist, title, wiki, output)
    if strategy in (None, "broadcast"):
        if len(allowlist) > BROADCAST_NEEDLES:
            raise ValueError(f"{len(allowlist)} needles are too many to broadcast; use strategy='grams'")
        return _match_by_broadcast(df, allowlist, title, wiki, output)
    frame = allowlist_frame(df.sparkSession, allowlist)
    return _match_by_grams(df, frame, title, wiki, output)


def is_monitored(canonical: Column) -> Column:
    return canonical.isNotNull()


def _match_by_broadcast(
    df: DataFrame, allowlist: Sequence[Needle], title: str, wiki: str, output: str
) -> DataFrame:
    by_wiki: dict[str, tuple[list, list]] = {}
    for n in sorted(allowlist, key=lambda n: (n.kind, n.position)):
        raws, canonicals = by_wiki.setdefault(n.wiki, ([], []))
        raws.append(n.raw)
        canonicals.append(n.canonical)
    listed = df.sparkSession.createDataFrame(
        [(name, *lists) for name, lists in by_wiki.items()],
        "_needle_wiki STRING, _raws ARRAY<STRING>, _canonicals ARRAY<STRING>",
    )
    per_wiki = listed.withColumn("_needles", F.transform("_raws", normalize_title)).withColumn(
        "_haystack", F.array_join("_needles", "\n")
    )
    name = F.col("_title")

    def canonical_at(place: Column) -> Column:
        return F.get("_canonicals", (place - 1).cast("int"))

    def first(hits: Column) -> Column:
        # Titles come before aliases, each in list order, so the first hit is the best.
        return canonical_at(F.array_position(hits, F.lit(True)))

    exact = canonical_at(F.array_position("_raws", F.col(title)))
    # A title inside one needle is inside all of them put together; few are, and
    # only for those both directions have to be tried needle by needle.
    both = F.transform("_needles", lambda n: contains_either_way(name, n))
    forward = F.transform("_needles", lambda n: F.contains(name, n))
    flexible = first(F.when(F.contains("_haystack", name), both).otherwise(forward))
    return (
        df.withColumn("_title", normalize_title(F.col(title)))
        .join(F.broadcast(per_wiki), F.col(wiki) == F.col("_needle_wiki"), "left")
        .withColumn(output, F.coalesce(exact, flexible))
        .drop("_title", "_needle_wiki", "_raws", "_canonicals", "_needles", "_haystack")
    )


def _grams(text: Column, length: int) -> Column:
    """The distinct substrings of one length."""
    starts = F.sequence(F.lit(1), F.length(text) - (length - 1))
    cut = F.array_distinct(F.transform(starts, lambda at: F.substring(text, at, F.lit(length))))
    return F.when(F.length(text) >= length, cut)


def _grams_up_to(text: Column, longest: int) -> Column:
    """The distinct substrings of every length from 1 to ``longest``."""
    none = F.array().cast("array<string>")
    parts = [F.coalesce(_grams(text, n), none) for n in range(1, longest + 1)]
    return F.array_distinct(F.concat(*parts))


def _own_grams(text: Column) -> Column:
    """Grams every text that contains ``text`` must have: itself if short."""
    return F.coalesce(_grams(text, GRAM), F.array(text))


def _meet(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that shuffles both sides, whatever Spark takes their sizes to be.

    It sizes a side by the files below it: compressed, and before texts are exploded into
    grams. That is small enough for a broadcast where the rows are a thousand times as much.
    """
    return left.join(right.hint("merge"), on, how)


def _rarest_gram(texts: DataFrame, text: str, grams: DataFrame) -> DataFrame:
    """Give each of ``texts`` its one own gram that the fewest others share.

    Meeting on the rarest gram instead of, say, the first keeps common beginnings
    ("list of ...") from pairing everything with everything. A text that has a
    gram nobody shares cannot be contained anywhere and drops out.
    """
    sharing = grams.groupBy("_w", "_gram").agg(F.count("*").alias("_sharing"))
    own = texts.select("_w", text, F.explode(_own_grams(F.col(text))).alias("_gram"))
    rarest = (
        _meet(own, sharing, ["_w", "_gram"], "left")
        .groupBy("_w", text)
        .agg(F.min(F.struct(F.coalesce("_sharing", F.lit(0)).alias("n"), "_gram")).alias("_least"))
        .filter("_least.n > 0")
        .select("_w", text, F.col("_least._gram").alias("_gram"))
    )
    return _meet(texts, rarest, ["_w", text])


def _match_by_grams(
    df: DataFrame, needles: DataFrame, title: str, wiki: str, output: str
) -> DataFrame:
    """Shuffled plan: match the distinct titles, then give the result to their rows.

    The distinct titles are written to the shared folder, so that the input is read once
    for them and once for the result, whatever the number of branches below.
    """
    names = written_once(
        df.select(F.col(wiki).alias("_w"), F.col(title).alias("_t"))
        .filter("_w IS NOT NULL AND _t IS NOT NULL")
        .distinct()
        .withColumn("_n", normalize_title(F.col("_t"))),
        "titles",
    )
    # Titles before aliases, then by place in the list.
    rank = F.struct("kind", "position", "canonical")
    exact = needles.select(F.col("wiki").alias("_w"), F.col("raw").alias("_t"), rank.alias("_r"))

    # Needles of one wiki and text differ only in rank, so the best of them stands for all.
    best = (
        needles.select(F.col("wiki").alias("_w"), "needle", rank.alias("_r"))
        .groupBy("_w", "needle")
        .agg(F.min("_r").alias("_r"))
    )
    # Titles that differ only in spelling match alike.
    spelled = names.select("_w", "_n").distinct()

    def verified(left: DataFrame, right: DataFrame) -> DataFrame:
        hits = _meet(left, right, ["_w", "_gram"])
        return hits.filter(contains_either_way(F.col("_n"), F.col("needle"))).select("_w", "_n", "_r")

    # The title contains the needle: every gram of the needle is one of the title.
    of_titles = spelled.withColumn("_gram", F.explode(_grams_up_to(F.col("_n"), GRAM)))
    inside = verified(of_titles, _rarest_gram(best.filter("needle <> ''"), "needle", of_titles))

    # The needle contains the title. A short title is itself a gram, so the best
    # needle per gram decides; a longer one is compared with those that share its rarest gram.
    of_needles = best.withColumn("_gram", F.explode(_grams_up_to(F.col("needle"), GRAM)))
    short_titles = spelled.filter(F.length("_n").between(1, GRAM - 1)).withColumn("_gram", F.col("_n"))
    per_gram = of_needles.groupBy("_w", "_gram").agg(F.min("_r").alias("_r"))
    short = _meet(short_titles, per_gram, ["_w", "_gram"]).select("_w", "_n", "_r")
    long_titles = spelled.filter(F.length("_n") >= GRAM)
    around = verified(_rarest_gram(long_titles, "_n", of_needles), of_needles)

    # An empty text is contained in everything of its wiki. Only empty titles, and wikis
    # that list an empty needle, take part.
    of_wiki = best.groupBy("_w").agg(F.min("_r").alias("_r"))
    empty = _meet(spelled.filter("_n = ''"), of_wiki, "_w").select("_w", "_n", "_r")
    listed = best.filter("needle = ''").select("_w", "_r")
    blank = _meet(spelled.filter("_n <> ''"), listed, "_w").select("_w", "_n", "_r").unionByName(empty)

    loose = inside.unionByName(short).unionByName(around).unionByName(blank)
    by_spelling = loose.groupBy("_w", "_n").agg(F.min("_r").alias("_loose"))
    by_title = exact.groupBy("_w", "_t").agg(F.min("_r").alias("_exact"))
    matched = (
        _meet(_meet(names, by_spelling, ["_w", "_n"], "left"), by_title, ["_w", "_t"], "left")
        .withColumn("_best", F.coalesce("_exact", "_loose"))
        .filter("_best IS NOT NULL")
        .select("_w", "_t", F.col("_best.canonical").alias(output))
    )
    same = (F.col(wiki) == F.col("_w")) & (F.col(title) == F.col("_t"))
    return _meet(df, matched, same, "left").drop("_w", "_t")
