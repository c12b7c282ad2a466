import json
import random

import pytest
from pyspark.sql import functions as F

from revwatch.functions.text import normalize_title
from revwatch.operators import matching
from revwatch.operators.matching import allowlist_frame, match_entity
from revwatch.sources.allowlist import Needle, default_allowlist, load_allowlist, needles


def plain(text):
    return text.lower().replace("_", " ").replace("  ", " ").strip()


def expected(listed, wiki, title):
    """The rules, read out one by one."""
    if wiki is None or title is None:
        return None
    ordered = sorted((n for n in listed if n.wiki == wiki), key=lambda n: (n.kind, n.position))
    for n in ordered:
        if n.raw == title:
            return n.canonical
    for n in ordered:
        if plain(n.raw) in plain(title) or plain(title) in plain(n.raw):
            return n.canonical
    return None


def found(spark, listed, rows, strategy):
    frame = spark.createDataFrame(rows, "wiki string, title string")
    target = allowlist_frame(spark, listed) if strategy == "table" else listed
    result = match_entity(frame, target, strategy=None if strategy == "table" else strategy)
    return sorted(((r.wiki, r.title, r.canonical_entity) for r in result.collect()), key=repr)


@pytest.mark.parametrize("text", ["A_b  C", "  x  ", "\tT\n", "a   b", "___", " é_ ", "ÄÖ"])
def test_normalisation(spark, text):
    got = spark.createDataFrame([(text,)], "t string").select(normalize_title(F.col("t"))).first()[0]
    assert got == plain(text)


@pytest.mark.parametrize("strategy", ["broadcast", "grams", "table"])
def test_default_list(spark, strategy):
    titles = [
        "United States", "united_states", "2026 United States Senate election in Minnesota", "USA",
        "King of Pop", "Duke", "India", "History of India", "indian", "", "i", "zz", "WWII",
        "World_War_II battles", "List of", "44th U.S. President", "Talk:Jesus", None,
    ]
    rows = [(w, t) for w in ("enwiki", "dewiki", None) for t in titles]
    listed = default_allowlist()
    want = sorted(((w, t, expected(listed, w, t)) for w, t in rows), key=repr)
    assert found(spark, listed, rows, strategy) == want


@pytest.mark.parametrize("strategy", ["broadcast", "grams"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, strategy, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abC_ ") for _ in range(rng.randint(0, 7)))
    entities = [
        {"title": word(), "wiki": rng.choice("xy"), "aliases": [word() for _ in range(rng.randint(0, 3))]}
        for _ in range(12)
    ]
    listed = needles(entities)
    rows = [(rng.choice(["x", "y", "z", None]), word()) for _ in range(150)]
    want = sorted(((w, t, expected(listed, w, t)) for w, t in rows), key=repr)
    assert found(spark, listed, rows, strategy) == want


def test_hot_title_and_common_beginnings(spark):
    listed = needles({"title": f"List of things {i}"} for i in range(200))
    rows = [("enwiki", "List of things 7")] * 300 + [("enwiki", f"List of people {i}") for i in range(200)]
    got = found(spark, listed, rows, "grams")
    assert sum(c == "enwiki:List of things 7" for _, _, c in got) == 300
    assert sum(c is None for _, _, c in got) == 200


def test_alias_given_twice_keeps_its_place_and_takes_the_last_page():
    listed = needles([
        {"title": "A", "aliases": ["x", "y"]},
        {"title": "B", "aliases": ["x"]},
        {"title": "A", "aliases": []},
    ])
    assert [(n.raw, n.kind, n.position, n.canonical) for n in listed] == [
        ("A", 0, 0, "enwiki:A"), ("B", 0, 1, "enwiki:B"), ("x", 1, 0, "enwiki:B"), ("y", 1, 1, "enwiki:A"),
    ]


def test_default_list_size_and_files(tmp_path):
    listed = default_allowlist()
    assert (sum(n.kind == 0 for n in listed), sum(n.kind == 1 for n in listed)) == (20, 40)
    config = {"entities": [{"title": "A", "aliases": ["b"]}, {"title": "C", "wiki": "dewiki"}]}
    (tmp_path / "list.json").write_text(json.dumps(config))
    want = [Needle("enwiki", "A", 0, 0, "enwiki:A"), Needle("dewiki", "C", 0, 1, "dewiki:C"), Needle("enwiki", "b", 1, 0, "enwiki:A")]
    assert load_allowlist(str(tmp_path / "list.json")) == want
    yaml = pytest.importorskip("yaml")
    (tmp_path / "list.yaml").write_text(yaml.safe_dump(config))
    assert load_allowlist(str(tmp_path / "list.yaml")) == want


def test_plan_choice_by_length(spark, monkeypatch):
    frame = spark.createDataFrame([("enwiki", "India")], "wiki string, title string")
    listed = default_allowlist()

    def plan(df):
        return df._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(match_entity(frame, listed))
    monkeypatch.setattr(matching, "BROADCAST_NEEDLES", 59)
    for strategy in (None, "broadcast"):
        with pytest.raises(ValueError):
            match_entity(frame, listed, strategy=strategy)
    assert "strategy=broadcast" not in plan(match_entity(frame, listed, strategy="grams"))
    with pytest.raises(ValueError):
        match_entity(frame, allowlist_frame(spark, listed), strategy="broadcast")


def test_shuffled_plan_broadcasts_nothing(spark, tmp_path):
    """Neither as planned, where exploded grams look as small as their file, nor as run."""
    titles = spark.range(200).selectExpr("'enwiki' AS wiki", "concat('A rather long title, number ', id) AS title")
    titles.write.parquet(f"{tmp_path}/titles")
    stored = spark.read.parquet(f"{tmp_path}/titles")
    listed = stored.where("title LIKE '%7'").selectExpr("wiki", "title AS raw", "0 AS kind", "0 AS position", "title AS canonical")
    matched = match_entity(stored, listed.withColumn("needle", normalize_title(F.col("raw"))))
    assert matched.where("canonical_entity = title").count() == 20
    executed = matched._jdf.queryExecution().executedPlan()
    assert "Broadcast" not in executed.toString()
    matched.collect()
    assert "Broadcast" not in executed.toString()
