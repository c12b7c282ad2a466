import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from revwatch.operators.bronze import to_bronze
from revwatch.operators.quality import silver_gate
from revwatch.operators.silver import bronze_to_silver, derive, drop_replays, parse_events, to_silver
from revwatch.schemas import BRONZE, SILVER

ARRIVAL = dt.datetime(2026, 1, 27, 14, 20)


def bronze(spark, *texts, arrival=ARRIVAL):
    rows = [(f"k{i}", t, "edits", 0, i, arrival, arrival.date()) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, BRONZE)


def record(**changes):
    base = {
        "id": 7,
        "type": "edit",
        "namespace": 0,
        "title": "A page",
        "comment": "Update",
        "timestamp": 1769523539,
        "user": "Ann",
        "bot": False,
        "minor": False,
        "wiki": "enwiki",
        "length": {"old": 67285, "new": 67667},
        "revision": {"old": 1, "new": 2},
        "meta": {"id": "m1", "dt": "2026-01-27T14:19:08.334Z", "domain": "en"},
        "_metadata": {"canonical_entity": "enwiki:United States"},
    }
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def derived(spark, **changes):
    return derive(parse_events(bronze(spark, record(**changes)))).first()


def test_sample_record(spark):
    row = derived(spark)
    assert row.bytes_changed == 382
    assert (row.is_revert, row.is_anonymous, row.is_large_edit) == (False, False, False)
    assert (row.is_bot_consistent, row.has_comment, row.is_allowlisted) == (True, True, True)
    assert row.event_hour == 14
    assert row.processing_lag_seconds == 61
    assert row.event_date == dt.date(2026, 1, 27)
    assert row.meta_dt == "2026-01-27T14:19:08.334Z" and row.meta_domain == "en"


@pytest.mark.parametrize(
    "text", ["{\"id\": 1", "[1]", "17", "", "not json"], ids=["cut", "list", "number", "empty", "words"]
)
def test_unusable_text_gives_nulls(spark, text):
    row = parse_events(bronze(spark, text)).first()
    assert row.wikimedia_id is None and row.title is None and row.length_old is None


@pytest.mark.parametrize(
    "changes, column",
    [
        ({"id": "seven"}, "wikimedia_id"),
        ({"namespace": 99999999999}, "namespace"),
        ({"length": 5}, "length_old"),
        ({"length": {"old": "x", "new": 3}}, "length_old"),
    ],
)
def test_wrong_type_spoils_only_its_field(spark, changes, column):
    row = derived(spark, **changes)
    assert row[column] is None
    assert row.title == "A page" and row.meta_id == "m1"


def test_number_becomes_text(spark):
    assert derived(spark, title=12).title == "12"


@pytest.mark.parametrize(
    "length, change, revert, large",
    [
        ({"old": 5, "new": 10245}, 10240, False, False),
        ({"old": 5, "new": 10246}, 10241, False, True),
        ({"old": 10245, "new": 5}, -10240, True, False),
        ({"old": 10246, "new": 5}, -10241, True, True),
        ({"new": 4}, 4, False, False),
        ({"old": 4}, -4, True, False),
        (..., 0, False, False),
        ({"old": -2147483648, "new": 2147483647}, None, False, True),
    ],
)
def test_size_change(spark, length, change, revert, large):
    row = derived(spark, length=length)
    assert (row.bytes_changed, row.is_revert, row.is_large_edit) == (change, revert, large)


@pytest.mark.parametrize(
    "user, anonymous",
    [
        ("192.168.1.1", True),
        ("999.999.999.999", True),
        ("2001:db8::1", True),
        ("::", True),
        ("a:b:c", True),
        ("1.2.3", False),
        ("1.2.3.4.5", False),
        ("Ann", False),
        ("g:b:c", False),
        (None, None),
    ],
)
def test_anonymous(spark, user, anonymous):
    assert derived(spark, user=user).is_anonymous is anonymous


@pytest.mark.parametrize(
    "bot, user, consistent",
    [
        (True, "CleanBOT", True),
        (True, "Ann", False),
        (False, "Ann", True),
        (False, "Talbot", False),
        (None, "Ann", True),
        (None, "abot", False),
        (True, None, None),
        (False, None, None),
    ],
)
def test_bot_consistency(spark, bot, user, consistent):
    assert derived(spark, bot=bot, user=user).is_bot_consistent is consistent


def test_comment_and_time_edges(spark):
    assert derived(spark, comment="").has_comment is False
    assert derived(spark, comment=None).has_comment is False
    row = derived(spark, timestamp=-9223372036854775808)
    assert row.event_hour is None and row.processing_lag_seconds is None
    assert derived(spark, timestamp=None).event_hour is None


def test_projection_has_the_table_columns(spark):
    frame = to_silver(derive(parse_events(bronze(spark, record()))))
    assert frame.columns == SILVER.fieldNames() and len(frame.columns) == 35
    assert [f.dataType for f in frame.schema] == [f.dataType for f in SILVER]


def test_batch_dedup_keeps_first_arrival_and_every_broken_row(spark):
    first = bronze(spark, record(title="late"), arrival=ARRIVAL + dt.timedelta(minutes=5))
    second = bronze(spark, record(title="early"), "broken", "broken too", "broken")
    rows = bronze_to_silver(first.unionByName(second)).collect()
    assert [r.title for r in rows if r.meta_id] == ["early"]
    # Same text but another offset: another record.
    assert sum(r.meta_id is None for r in rows) == 3


def test_backfilled_rows_share_coordinates_but_stay_apart(spark):
    frame = bronze(spark, "broken", "broken too").withColumn("kafka_offset", F.lit(0).cast("bigint"))
    assert drop_replays(derive(parse_events(frame))).count() == 2


def test_hot_id_is_reduced_before_the_shuffle(spark):
    frame = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("m"), "id")).alias("meta_id"),
        F.lit("edits").alias("kafka_topic"),
        F.lit(0).alias("kafka_partition"),
        F.col("id").alias("kafka_offset"),
        F.lit(ARRIVAL).alias("ingestion_timestamp"),
    )
    kept = drop_replays(frame)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert kept.count() == 20000 - 6667 + 1
    assert kept.filter("meta_id = 'hot'").first().kafka_offset == 0


def test_gate_names_an_unparseable_text(spark):
    rows = bronze_to_silver(bronze(spark, "{\"id\":", "{}", record()))
    result = silver_gate().run(rows, "b")
    reasons = {r.event_id: r._failed_rules for r in result.failed.collect()}
    assert "unparseable:event_data" in reasons["k0"]
    assert "unparseable:event_data" not in reasons["k1"]
    assert "k2" not in reasons
    result.release()


def test_bronze_projection(spark):
    rows = spark.createDataFrame(
        [(bytearray(b"enwiki:A"), bytearray(b"{}"), "edits", 3, 9, ARRIVAL, 0), (None, None, "edits", 3, 10, ARRIVAL, 0)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int",
    )
    frame = to_bronze(rows, now=F.lit(ARRIVAL))
    assert frame.columns == BRONZE.fieldNames()
    first, second = frame.orderBy("kafka_offset").collect()
    assert (first.event_id, first.event_data, first.kafka_partition) == ("enwiki:A", "{}", 3)
    assert second.event_id is None and second.event_date == ARRIVAL.date()


def test_text_is_parsed_once_below_filters(spark):
    rows = derive(parse_events(bronze(spark, record())))
    kept = rows.filter("meta_id IS NOT NULL AND namespace >= 0 AND title <> 'x' AND bytes_changed < 9")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
