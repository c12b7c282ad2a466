"""Records parsed once: Silver from members equals Silver from text."""

from pyspark.sql import functions as F
from test_plans import plan
from test_silver import bronze, record
from test_streaming import START, message, put, queue

from revwatch.operators import silver
from revwatch.schemas import SHREDDED_TABLE, SILVER_TABLE
from revwatch.sinks.warehouse import Warehouse
from revwatch.streaming.pipeline import start_bronze, start_silver

ODD = [
    record(),
    *(record(id=v) for v in ("7", 7.0, 1e3, 2**70, 2**63 - 1, None, ...)),
    *(record(title=v) for v in (5, True, None, {"a": [1, 2]}, [1], "é\n\"", "x" * 5000)),
    *(record(bot=v) for v in ("true", 1, None)),
    *(record(length=v) for v in (None, 5, {"old": "3"}, {"old": 3, "new": None})),
    record(namespace=2**40),
    record(meta=...),
    record(meta=[]),
    *("[1]", '[{"id":5}]', '{"id": 5', "", "null", "5", '"x"', "{}", '{"id":1,"id":2}', '{"id": 5} trailing', '{"ID":5}'),
    '{"length":{"old":1,"old":2}}',
    None,
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_members_equal_the_parsed_text(spark, tmp_path):
    table = bronze(spark, *ODD)
    silver.shredded(table).write.parquet(f"{tmp_path}/stored")
    stored = spark.read.parquet(f"{tmp_path}/stored")
    by_text = silver.parse_events(table)
    for source in (silver.shredded(table), stored):
        found = silver.parse_shredded(source)
        assert found.columns == by_text.columns
        assert rows(found) == rows(by_text)
    assert rows(silver.bronze_to_silver(stored)) == rows(silver.bronze_to_silver(table))


def test_numbers_in_text_columns_are_canonical(spark):
    found = silver.parse_shredded(silver.shredded(bronze(spark, '{"title": 1.50}'))).first()
    assert found.title == "1.5"


def test_scan_reads_the_paths_asked_for(spark, tmp_path):
    silver.shredded(bronze(spark, *ODD)).write.parquet(f"{tmp_path}/stored")
    wanted = silver.derive(silver.parse_shredded(spark.read.parquet(f"{tmp_path}/stored"))).select("title", "bytes_changed")
    schema = plan(wanted).split("ReadSchema: ")[1].split("\n")[0]
    # Title, and the old and new length, each as a typed member and as it is; no text, no other member.
    assert schema.startswith("struct<event:struct<") and "event_data" not in schema
    assert schema.count(":variant") == 3 and schema.count(",") == 5
    assert "from_json" not in plan(wanted) and "JsonToStructs" not in plan(wanted)


def test_streams_over_the_shredded_table(spark, tmp_path):
    folder = f"{tmp_path}/queue"
    put(spark, folder, [message(i, i, title=f"Page {i}") for i in range(6)])
    lakes = {}
    for shred in (False, True):
        lake = Warehouse(spark, f"{tmp_path}/lake-{shred}")
        lake.create_tables()
        start_bronze(
            queue(spark, folder), lake, f"{tmp_path}/b-{shred}", once=True, now=F.col("timestamp"), shred=shred
        ).awaitTermination()
        start_silver(lake, f"{tmp_path}/s-{shred}", once=True, from_shredded=shred).awaitTermination()
        lakes[shred] = rows(lake.read(SILVER_TABLE))
    assert len(lakes[True]) == 6 and lakes[True] == lakes[False]
    assert Warehouse(spark, f"{tmp_path}/lake-True").read(SHREDDED_TABLE).where(F.col("ingestion_timestamp") >= F.lit(START)).count() == 6


def test_objects_are_told_apart_without_their_schema(spark):
    texts = ['{"id": 1}', ' \t\r\n{"id": 2}', "[1]", '"{"', "{", "", " ", "null", "7", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, event_data string")
    found = silver.shredded(rows)
    assert "schemaofvariant" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert sorted(r.n for r in found.where("event IS NOT NULL").collect()) == [0, 1]
