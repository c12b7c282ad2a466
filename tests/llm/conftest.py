import pytest

#: Columns named like those the operators make on the way.
CLASHING = ("row", "hits", "class", "lines", "fingerprint", "start", "host", "cut", "chunk", "kept", "hash", "n_words")


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text[, source]) rows, with clashing further columns."""

    def make(rows, slices=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", 0, *["x"] * len(CLASHING)) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long, "
        df = spark.createDataFrame(full, kinds + ", ".join(f"`{c}` string" for c in CLASHING))
        return df.repartition(slices)

    return make


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one"),
    (5, LONG),
    (6, "same text of a few words here"),
    (6, "same text of a few words here"),
    (7, "same text of a few words here"),
    (None, "a row without an id, but with words"),
    (9, "Ünïcödé wörds, ümläuts 日本語 \U0001f600 end"),
]


@pytest.fixture(scope="session")
def edges():
    return list(EDGES)
