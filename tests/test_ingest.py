import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revwatch.operators import ingest
from revwatch.sources.allowlist import default_allowlist

NOW = dt.datetime(2026, 1, 27, 14, 19, 8, 616344)


def routed(spark, *texts):
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    return ingest.route_events(frame, default_allowlist(), now=F.lit(NOW))


@pytest.mark.parametrize(
    "text, route, error",
    [
        (None, "skipped", None),
        ("", "skipped", None),
        ("{\"title\": ", "malformed", None),
        ("words", "malformed", None),
        ("[1, 2]", "dlq", ingest.NOT_AN_OBJECT),
        ("17", "dlq", ingest.NOT_AN_OBJECT),
        ("null", "dlq", ingest.NOT_AN_OBJECT),
        ("\"title wiki\"", "dlq", ingest.NOT_AN_OBJECT),
        ("{}", "dlq", ingest.MISSING_FIELDS),
        ("{\"title\": \"India\"}", "dlq", ingest.MISSING_FIELDS),
        ("{\"wiki\": \"enwiki\"}", "dlq", ingest.MISSING_FIELDS),
        ("{\"title\": null, \"wiki\": \"enwiki\"}", "dlq", ingest.TITLE_NOT_TEXT),
        ("{\"title\": 5, \"wiki\": \"enwiki\"}", "dlq", ingest.TITLE_NOT_TEXT),
        ("{\"title\": \"India\", \"wiki\": null}", "filtered", None),
        ("{\"title\": \"India\", \"wiki\": \"dewiki\"}", "filtered", None),
        ("{\"title\": \"Nothing here\", \"wiki\": \"enwiki\"}", "filtered", None),
        ("{\"title\": \"India\", \"wiki\": \"enwiki\"}", "cleaned", None),
        (" \n{\"title\": \"\", \"wiki\": \"enwiki\"} ", "cleaned", None),
        ("{\"title\": \"x\", \"title\": \"India\", \"wiki\": \"enwiki\"}", "cleaned", None),
    ],
)
def test_routes(spark, text, route, error):
    row = routed(spark, text).first()
    assert (row.route, row.error) == (route, error)
    assert (row.key is not None) == (row.enriched is not None) == (route == "cleaned")


def test_enrichment_keeps_unknown_fields(spark):
    source = {"$schema": "/a/1", "title": "History of India", "wiki": "enwiki", "n": [1, {"x": "é\"\n"}]}
    row = routed(spark, "  " + json.dumps(source) + "\n").first()
    assert row.key == "enwiki:History of India"
    assert json.loads(row.enriched) == {
        **source,
        "_metadata": {
            "ingestion_timestamp": "2026-01-27T14:19:08.616344",
            "source": "wikimedia_sse",
            "version": "1.0",
            "canonical_entity": "enwiki:India",
        },
    }
    assert row.value == "  " + json.dumps(source) + "\n"


def test_enrichment_replaces_old_metadata(spark):
    source = {"_metadata": {"canonical_entity": "old", "z": 1}, "title": "USA", "wiki": "enwiki", "d": {"k": [1]}}
    enriched = json.loads(routed(spark, json.dumps(source)).first().enriched)
    assert enriched["_metadata"]["canonical_entity"] == "enwiki:United States"
    assert "z" not in enriched["_metadata"] and enriched["d"] == {"k": [1]}


def test_messages_and_counters(spark):
    good = "{\"title\": \"India\", \"wiki\": \"enwiki\"}"
    frame = routed(spark, good, good, "{}", "[1]", "{", "", "{\"title\": \"q9\", \"wiki\": \"enwiki\"}")
    sent = ingest.queue_records(frame, now=F.lit(NOW))
    assert sent.columns == ["topic", "key", "value"]
    counts = {r.topic: r["count"] for r in sent.groupBy("topic").count().collect()}
    assert counts == {"raw_events": 2, "cleaned_events": 2, "dlq_events": 2}
    letters = [json.loads(r.value) for r in sent.filter("topic = 'dlq_events'").collect()]
    assert {json.dumps(x["original_event"]) for x in letters} == {"{}", "[1]"}
    assert all(x["timestamp"] == "2026-01-27T14:19:08.616344" for x in letters)
    counters = ingest.route_counters(frame).first()
    assert counters.asDict() == {"processed": 5, "filtered": 1, "sent": 6, "errors": 2}


def test_dead_letter_of_a_failed_send(spark):
    letter = ingest.dlq_record(F.lit("{\"a\": 1}"), F.lit("timed out"), F.lit(NOW), F.lit("raw_events"))
    row = json.loads(spark.range(1).select(letter).first()[0])
    assert row["original_event"] == {"a": 1} and row["target_topic"] == "raw_events"


def test_unfiltered(spark):
    frame = spark.createDataFrame(
        [("{\"id\": 5, \"a\": 1}",), ("{}",), ("[1]",), ("{",), (None,), ("{\"id\": null}",), ("{\"_ingestion_timestamp\": 1}",)],
        "value string",
    )
    rows = {r.key: json.loads(r.value) for r in ingest.unfiltered_records(frame, F.lit(NOW)).collect() if r.key}
    stamp = "2026-01-27T14:19:08.616344"
    assert rows == {
        "5": {"id": 5, "a": 1, "_ingestion_timestamp": stamp},
        "None": {"id": None, "_ingestion_timestamp": stamp},
    }
    blank = [json.loads(r.value) for r in ingest.unfiltered_records(frame, F.lit(NOW)).collect() if not r.key]
    assert blank == [{"_ingestion_timestamp": stamp}] * 2


def test_text_is_parsed_once(spark):
    frame = routed(spark, "{}")
    only = frame.filter((F.col("route") == "dlq") & F.col("error").isNotNull()).select("error")
    texts = spark.createDataFrame([("{}",)], "value string")
    for df in (frame.select("route"), only, ingest.unfiltered_records(texts).select("key")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson(value") == 1
