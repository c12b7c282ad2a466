"""The pipeline's stages against what their operators say, and the registered queries."""

from collections import Counter

import pytest
from oracle_check import connect, differences
from test_duplicates import fingerprint, roots

import __spark_entry__ as entry
import corpus_pipeline
from revwatch.llm import decontaminate, packing, quality, simhash, templates
from revwatch.llm.common import table
from revwatch.llm.oracle import ORACLE
from revwatch.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = table(spark, SF_DIR, "documents")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_keep_the_columns_of_documents(stages):
    for name in list(stages)[:-1]:
        assert stages[name].columns == list(corpus_pipeline.COLUMNS)
        lengths = stages[name].selectExpr("coalesce(length(text), 0) = coalesce(n_chars, 0) AS ok")
        assert lengths.where("not ok").count() == 0


def test_quality_stage_takes_effect(stages):
    kept = {r.doc_id for r in quality.quality_rules(stages["documents"]).where("kept").collect()}
    assert {r.doc_id for r in stages["quality_rules"].collect()} == kept
    assert 0 < len(kept) < stages["documents"].count()


def test_line_stage_takes_effect(stages):
    expected = Counter((r.doc_id, r.text) for r in templates.drop_templates(stages["quality_rules"]).collect())
    assert Counter((r.doc_id, r.text) for r in stages["line_dedup"].collect()) == expected


def test_near_dedup_keeps_one_of_each_group(stages):
    rows = stages["line_dedup"].collect()
    marks = [fingerprint(r.text) for r in rows]
    n = len(rows)
    pairs = [(i, j) for i in range(n) for j in range(i + 1) if (marks[i] ^ marks[j]).bit_count() <= 3]
    least = {}
    for i, root in roots(pairs).items():
        least[root] = min(least.get(root, rows[i].doc_id), rows[i].doc_id)
    kept = [r.doc_id for r in stages["simhash_near_dedup"].collect()]
    assert sorted(kept) == sorted(least.values())


def test_decontamination_drops_the_contaminated(spark, stages):
    found = decontaminate.find_contamination(stages["simhash_near_dedup"], table(spark, SF_DIR, "benchmark"))
    clean = {r.doc_id for r in found.where("n_hit = 0").collect()}
    assert {r.doc_id for r in stages["benchmark_decontamination"].collect()} == clean


def test_packing_holds_every_document(stages):
    docs = {r.doc_id for r in stages["benchmark_decontamination"].collect()}
    rows = stages["best_fit_packing"].collect()
    assert {r.doc_id for r in rows} == docs
    fill = Counter()
    for r in rows:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= packing.CAPACITY


def test_run_gives_the_last_stage(spark, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    found = Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(*columns).collect()))
    assert found == Counter(map(tuple, stages["best_fit_packing"].select(*columns).collect()))


@pytest.mark.parametrize("empty", [True, False])
def test_stages_take_odd_documents(spark, frame, edges, empty):
    docs = frame([] if empty else edges)
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF_DIR)
        count = result.count()
        assert count == 0 if empty else name == "quality_rules" or count > 0


def test_stage_order_and_registration():
    assert list(STAGES) == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "best_fit_packing",
    ]
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_run_and_agree_with_their_oracle(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    if name in ORACLE:
        assert differences(found, connect(SF_DIR), ORACLE[name]) is None
    else:
        assert found.count() > 0


def test_near_duplicates_carry_columns_and_survive_clashes(frame, edges):
    found = simhash.near_duplicates(frame(edges), carry=("text", "lang", "source", "n_chars"))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "fingerprint", "component_id", "first"]
