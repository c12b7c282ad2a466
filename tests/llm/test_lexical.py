"""Ranked search against a plain scorer."""

import math
import random
import re
from collections import Counter

import pytest

from revwatch.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
CLASHING = ("n", "m", "terms", "tfs", "ids", "rank", "score", "i_row", "d_row", "x_row", "chosen")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, top=20):
    own = [Counter(terms(t)) for _, t in docs]
    n = sum(1 for c in own if c)
    length = sum(c.total() for c in own)
    df = Counter(t for c in own for t in c)
    rows = []
    for item_id, text in items:
        asked = Counter(terms(text))
        scored = []
        for (doc_id, _), c in zip(docs, own):
            if not c:
                continue
            m = 75 + 25 * c.total() * n // length
            score = sum(
                k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, k in asked.items()
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        rows += [(item_id, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored)[:top], 1)]
    return sorted(rows, key=repr)


def made(spark, rows, name):
    full = [(*r, *["x"] * len(CLASHING)) for r in rows]
    return spark.createDataFrame(full, f"{name} long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)).repartition(3)


def taken(found):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect()), key=repr)


def prose(r, n):
    return " ".join(f"w{min(int(r.paretovariate(0.6)), 400)}" for _ in range(n))


def cases(edges):
    r = random.Random(8)
    docs = list(edges) + [(1000 + i, prose(r, r.choice((1, 5, 30, 30, 30, 200, 900)))) for i in range(260)]
    docs += [(2000 + i, docs[40][1]) for i in range(50)] + [(2000, docs[40][1])]  # copies, and one row twice
    items = [(i, prose(r, 25)) for i in range(12)] + [(3, prose(r, 4)), (None, "w1 w2 w2 W1"), (50, None), (51, ""), (52, "...")]
    items += [(53, docs[40][1]), (54, "words ümläuts 日本語"), (55, "nowhere"), (56, "same TEXT of a few words, here")]
    return docs, items


@pytest.mark.parametrize("row_docs,postings,first", [(2048, 1 << 15, 8), (4, 40, 1)])
def test_ranks_equal_plain_scoring(spark, edges, monkeypatch, row_docs, postings, first):
    monkeypatch.setattr(lexical, "ROW_DOCS", row_docs)
    monkeypatch.setattr(lexical, "ROW_POSTINGS", postings)
    monkeypatch.setattr(lexical, "FIRST", first)
    docs, items = cases(edges)
    found = lexical.ranked_search(made(spark, docs, "doc_id"), made(spark, items, "item_id"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert taken(found) == ranked(docs, items)


def test_blocks_of_items_and_short_lists(spark, edges, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_CHARS", 150)
    docs, items = cases(edges)
    found = lexical.ranked_search(made(spark, docs, "doc_id"), made(spark, items[:6], "item_id"), top=3)
    assert taken(found) == ranked(docs, items[:6], 3)


def test_empty_tables(spark):
    none, some = made(spark, [], "doc_id"), made(spark, [(1, "a b")], "doc_id")
    assert lexical.ranked_search(none, made(spark, [(1, "a")], "item_id")).count() == 0
    assert lexical.ranked_search(some, made(spark, [], "item_id")).count() == 0
    assert lexical.ranked_search(made(spark, [(1, None)], "doc_id"), made(spark, [(1, "a")], "item_id")).count() == 0


def test_pieces_of_a_long_text_keep_terms_whole(monkeypatch):
    text = "Alpha bétà, x1\x00y " * 50 + "日" * 40 + " end"
    whole = Counter(t.encode() for t in terms(text))
    for piece in (1, 2, 7, 33):
        monkeypatch.setattr(lexical, "_PIECE", piece)
        assert lexical.term_counts(text) == whole


def test_a_bound_is_never_exceeded_and_closes_strata(spark, edges, monkeypatch):
    """Rows below the score to reach are not opened, and none of their documents would rank."""
    opened = []
    docs, items = cases(edges)
    queries = lexical.Queries.of([(i, t) for i, (_, t) in enumerate(items)])
    monkeypatch.setattr(lexical, "ROW_DOCS", 8)
    told = spark.sparkContext.broadcast(queries)
    counts = lexical.count_terms(made(spark, docs, "doc_id"), told).where("size(terms) > 0")
    rows = lexical.stratified(counts.withColumn("m", lexical.normaliser(counts.n, 300, 30_000))).toArrow()
    weights = lexical.np.arange(len(queries.vocabulary)) % 900
    for batch in rows.to_batches():
        for at in range(batch.num_rows):
            stratum = lexical._Stratum(batch, at, queries, weights)
            bound = stratum.bounds()
            _, scores = stratum.scores(lexical.np.ones(len(bound), bool))
            assert (scores.max(axis=1) <= bound).all()
            opened.append((bound > bound.max() // 2).mean())
    assert min(opened) < 1
