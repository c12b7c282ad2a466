"""Edit records derived from the ``events`` table.

The tables at hand hold no edit records, so every row of ``events`` is mapped to
one by integer arithmetic that Spark and ANSI SQL share: nulls, replays, late
and misdated rows, bots and network addresses appear in known places. Nothing is
left out; the map has as many rows as the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.session import shared_folder

#: Columns of the map in SQL that both engines read; ``{epoch}`` is the whole second.
RECORD_COLUMNS = {
    "rid": "event_id",
    "event_id": "CASE WHEN event_id % 89 = 0 THEN NULL ELSE 'k' || (event_id % 7) END",
    "meta_id": (
        "CASE WHEN event_id % 97 = 0 THEN NULL"
        " WHEN event_id % 50 = 1 THEN 'm' || (event_id - 1) ELSE 'm' || event_id END"
    ),
    "wikimedia_id": "event_id + 1",
    "event_type": (
        "CASE WHEN event_id % 41 = 0 THEN 'external'"
        " WHEN event_type IN ('view', 'click', 'error') THEN 'edit'"
        " WHEN event_type = 'purchase' THEN 'new'"
        " WHEN event_id % 2 = 0 THEN 'categorize' ELSE 'log' END"
    ),
    "namespace": "CAST(CASE WHEN event_id % 53 = 0 THEN -1 ELSE event_id % 4 END AS INT)",
    "title": (
        "CASE event_id % 4 WHEN 0 THEN 'United States' WHEN 1 THEN 'History of India'"
        " WHEN 2 THEN 'Page ' || (event_id % 7) ELSE 'World_War_II battles' END"
    ),
    "title_url": "'https://site.example/wiki/' || event_id",
    "comment": (
        "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 6 = 0 THEN ''"
        " ELSE 'edit ' || event_id END"
    ),
    "event_timestamp": "{epoch}",
    "user_name": (
        "CASE user_id % 4 WHEN 0 THEN '10.0.0.' || (user_id % 40)"
        " WHEN 1 THEN 'CleanBot' || (user_id % 40) ELSE 'User' || (user_id % 40) END"
    ),
    "is_bot": "CASE WHEN event_id % 31 = 0 THEN NULL ELSE user_id % 4 = 1 END",
    "is_minor": "event_id % 9 = 0",
    "wiki": "CASE event_id % 3 WHEN 0 THEN 'enwiki' WHEN 1 THEN 'dewiki' ELSE 'frwiki' END",
    "server_url": "'https://site.example'",
    "notify_url": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'https://site.example/d/' || event_id END",
    "canonical_entity": (
        "CASE WHEN event_id % 3 <> 0 THEN NULL WHEN event_id % 4 = 0 THEN 'enwiki:United States'"
        " WHEN event_id % 4 = 1 THEN 'enwiki:India' WHEN event_id % 4 = 3 THEN 'enwiki:World War II' END"
    ),
    "length_old": "CAST(5000 + event_id % 4000 AS INT)",
    "length_new": (
        "CASE WHEN event_id % 29 = 0 THEN NULL ELSE CAST(5000 + event_id % 4000"
        " + (event_id * 13) % 2500 - 300 + CASE WHEN event_id % 37 = 0 THEN 60000 ELSE 0 END AS INT) END"
    ),
    "revision_old": "event_id * 2",
    "revision_new": "event_id * 2 + 1",
    "kafka_topic": "'edits'",
    "kafka_partition": "CAST(event_id % 3 AS INT)",
    "kafka_offset": "CAST(floor(event_id / 3) AS BIGINT)",
    "lag_s": "CASE WHEN event_id % 23 = 0 THEN 3601 + event_id % 100 ELSE (event_id * 37) % 240 END",
}

SPARK_EPOCH = "unix_timestamp(CAST(ts AS TIMESTAMP))"

#: Faults put into the JSON text, first match wins; the rest stays well formed.
FAULTS = (
    ("event_id % 101 = 0", "'{\"id\": ' || event_id"),
    ("event_id % 103 = 0", "''"),
    ("event_id % 107 = 0", "'[' || event_id || ']'"),
    ("event_id % 109 = 0", "'{\"id\": ' || event_id || ', \"wiki\": \"enwiki\"}'"),
    ("event_id % 113 = 0", "'{\"id\": ' || event_id || ', \"title\": null, \"wiki\": \"enwiki\"}'"),
    ("event_id % 127 = 0", "CAST(NULL AS STRING)"),
)


#: Rows of a file that a stream follows, about.
ROWS_PER_FILE = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def follow_events(spark: SparkSession, sf_dir: str, shares: int = 3) -> DataFrame:
    """The ``events`` table as a stream, one share of its time to a trigger, in order of arrival.

    The last share brings the rows of the first once more: they are older than the watermark
    by then, so a stream has to drop them as late. All shares have the same number of files,
    which grows with the table, and a trigger takes so many: of a share cut in two, the second
    part would come after the watermark that the first part moved.
    """
    events = table(spark, sf_dir, "events")
    seconds = (F.expr(RECORD_COLUMNS[name].format(epoch=SPARK_EPOCH)) for name in ("event_timestamp", "lag_s"))
    arrived = events.withColumn("_arrival", next(seconds) + next(seconds))
    places = [i / shares for i in range(1, shares)]
    rows, cuts = arrived.agg(F.count("*"), F.percentile_approx("_arrival", places)).first()
    files = -(-rows // (shares * ROWS_PER_FILE)) or 1
    bounds = [None, *(cuts or []), None]
    folder = shared_folder(spark, "event-files")
    followed = spark.read.schema(events.schema)
    for share, (low, high) in enumerate([*zip(bounds, bounds[1:]), (None, bounds[1])], 1):
        part = arrived if low is None else arrived.where(F.col("_arrival") > low)
        part = part if high is None else part.where(F.col("_arrival") <= high)
        part.drop("_arrival").repartition(files).write.mode("append").parquet(folder)
        # A task without rows leaves no file.
        for _ in range(share * files - len(followed.parquet(folder).inputFiles())):
            events.limit(0).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(folder)


def edit_records(events: DataFrame) -> DataFrame:
    """The parsed form of the records: what JSON parsing would yield, plus ``rid``."""
    mapped = events.select(
        *(F.expr(sql.format(epoch=SPARK_EPOCH)).alias(name) for name, sql in RECORD_COLUMNS.items())
    )
    arrival = F.timestamp_seconds(F.col("event_timestamp") + F.col("lag_s"))
    return mapped.withColumn("ingestion_timestamp", arrival)


def _nested(canonical: bool) -> list:
    fields = [
        F.col("wikimedia_id").alias("id"),
        F.col("event_type").alias("type"),
        "namespace",
        "title",
        "title_url",
        "comment",
        F.col("event_timestamp").alias("timestamp"),
        F.col("user_name").alias("user"),
        F.col("is_bot").alias("bot"),
        F.col("is_minor").alias("minor"),
        "wiki",
        "server_url",
        "notify_url",
        F.struct(F.col("length_old").alias("old"), F.col("length_new").alias("new")).alias("length"),
        F.struct(F.col("revision_old").alias("old"), F.col("revision_new").alias("new")).alias("revision"),
        F.struct(F.col("meta_id").alias("id")).alias("meta"),
    ]
    if canonical:
        fields.append(F.struct("canonical_entity").alias("_metadata"))
    return fields


def queue_shaped(events: DataFrame, canonical: bool = True) -> DataFrame:
    """The records as a queue delivers them: key and JSON value, with coordinates."""
    return edit_records(events).select(
        "rid",
        F.col("event_id").cast("binary").alias("key"),
        F.to_json(F.struct(*_nested(canonical))).cast("binary").alias("value"),
        F.col("kafka_topic").alias("topic"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingestion_timestamp").alias("timestamp"),
    )


def raw_texts(events: DataFrame) -> DataFrame:
    """``rid`` and JSON ``value`` as a source sends them, faults included."""
    good = queue_shaped(events, canonical=False).select("rid", F.col("value").cast("string").alias("value"))
    fault = None
    for condition, text in FAULTS:
        when = F.expr(condition.replace("event_id", "rid"))
        value = F.expr(text.replace("event_id", "rid"))
        fault = F.when(when, value) if fault is None else fault.when(when, value)
    return good.withColumn("value", fault.otherwise(F.col("value")))
