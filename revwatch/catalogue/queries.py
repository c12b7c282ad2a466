"""The registered queries: each operator over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revwatch.catalogue.records import (
    edit_records,
    follow_events,
    queue_shaped,
    raw_texts,
    table,
)
from revwatch.operators import gold, history, ingest, matching, profile, profile_states, quality, silver, states
from revwatch.operators.bronze import to_bronze
from revwatch.plans import recovery, serving
from revwatch.plans.staging import QuarantineStaging
from revwatch.schemas import GOLD_ENTITY_TABLE, SHREDDED_TABLE, SILVER_TABLE, STATES_TABLE
from revwatch.session import configure, shared_folder, written_once
from revwatch.sinks.landing import land_stream, read_topic, with_landing_folders
from revwatch.sinks.layers import record_metrics, write_batch
from revwatch.sinks.warehouse import Warehouse, utc_now
from revwatch.sources.allowlist import default_allowlist
from revwatch.sources.files import sample_records, save_sample, to_backfill
from revwatch.sources.layers import follow_silver
from revwatch.streaming import late
from revwatch.streaming.pipeline import start, store_ingest

Query = Callable[[SparkSession, str], DataFrame]

#: The "today" and "now" of queries that otherwise follow the clock.
TODAY = dt.date(2024, 1, 30)
NOW = dt.datetime(2024, 2, 1)
REPLAY_FROM = dt.date(2024, 1, 15)

_QUERIES: dict[str, Query] = {}

#: Columns of the metric tables that depend on the clock or, on a stream, on sketches.
CLOCK = "aggregation_timestamp"


def query(build: Query) -> Query:
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir.rstrip("/"))

    prepared.__name__ = build.__name__
    prepared.__doc__ = build.__doc__
    _QUERIES[build.__name__] = prepared
    return prepared


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# Inputs shared by the queries. ---------------------------------------------------------


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events")


def _derived(spark, sf_dir):
    """Derived records, before the gate."""
    return silver.derive(edit_records(_events(spark, sf_dir)))


def _cleaned(spark, sf_dir):
    """What the Silver table holds: first copies that pass the gate."""
    kept = silver.drop_replays(_derived(spark, sf_dir))
    return kept.filter(quality.passes(quality.silver_rules(kept.columns)))


def _entity(spark, sf_dir, window):
    return gold.entity_metrics(_cleaned(spark, sf_dir), window, exact_distinct=True).drop(CLOCK)


def _user(spark, sf_dir, window):
    return gold.user_metrics(_cleaned(spark, sf_dir), window, exact_distinct=True).drop(CLOCK)


def _global(spark, sf_dir, window):
    return gold.global_metrics(_cleaned(spark, sf_dir), window, exact_distinct=True).drop(CLOCK)


# Raw layer. ----------------------------------------------------------------------------


@query
def bronze_projection(spark, sf_dir):
    """Queue records whose value is the ``props`` text of each event."""
    records = _events(spark, sf_dir).select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("edits").alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).alias("offset"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("timestamp"),
    )
    return to_bronze(records, now=F.col("timestamp"))


@query
def backfill_bronze(spark, sf_dir):
    """Historic records to raw rows, without the texts and the arrival clock."""
    lines = queue_shaped(_events(spark, sf_dir)).select(F.col("value").cast("string").alias("value"))
    return to_backfill(lines).select(
        "event_id", "kafka_topic", "kafka_partition", "kafka_offset", "event_date"
    )


@query
def landing_read_back(spark, sf_dir):
    """Records landed as JSON lines by a stream, per folder, as they are read back."""
    root = shared_folder(spark, "landing-query")
    queue_shaped(_events(spark, sf_dir)).select("value", "timestamp").write.parquet(f"{root}/queue")
    records = spark.readStream.schema("value binary, timestamp timestamp").parquet(f"{root}/queue")
    land_stream(records, f"{root}/landed", f"{root}/checkpoint", once=True, records_per_file=10_000).awaitTermination()
    kinds = "value string, year string, month string, day string, hour string"
    landed = spark.read.schema(kinds).format("text").load(f"{root}/landed")
    return landed.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("records"), F.count_if(F.try_parse_json("value").isNotNull()).alias("decodable")
    )


@query
def sample_of_records(spark, sf_dir):
    """A sample of raw texts: as many as asked for, all decodable, all of them among the texts."""
    root = shared_folder(spark, "sample-query")
    texts = raw_texts(_events(spark, sf_dir)).where("value IS NOT NULL").select("value")
    texts.write.text(f"{root}/texts")
    save_sample(sample_records(spark, f"{root}/texts", 25), f"{root}/sample")
    sample = spark.read.text(f"{root}/sample")
    known = sample.join(texts.distinct(), "value", "left_semi").agg(F.count("*").alias("known")).first()[0]
    return sample.agg(
        F.count("*").alias("taken"),
        F.count_if(F.try_parse_json("value").isNotNull()).alias("decodable"),
        F.lit(known).cast("bigint").alias("known"),
    )


@query
def landing_partitions(spark, sf_dir):
    """Records per landing folder (hours of Central European time)."""
    records = edit_records(_events(spark, sf_dir)).select(F.col("ingestion_timestamp").alias("timestamp"))
    return with_landing_folders(records).groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("records")
    )


# Ingest. -------------------------------------------------------------------------------


def _routed(spark, sf_dir):
    now = F.lit(NOW)
    return ingest.route_events(raw_texts(_events(spark, sf_dir)), default_allowlist(), now=now)


@query
def ingest_routes(spark, sf_dir):
    """The route, key and page of every record."""
    return _routed(spark, sf_dir).select("rid", "route", "key", "canonical_entity", "error")


@query
def ingest_counters(spark, sf_dir):
    return ingest.route_counters(_routed(spark, sf_dir))


@query
def ingest_counters_observed(spark, sf_dir):
    """The counters as the job that writes the messages observes them."""
    warehouse = Warehouse(spark, shared_folder(spark, "ingest-query"))
    store_ingest(warehouse, raw_texts(_events(spark, sf_dir)), default_allowlist(), "all", now=F.lit(NOW))
    return warehouse.read("ingest_counters").select("processed", "filtered", "sent", "errors")


@query
def topics_read_back(spark, sf_dir):
    """Messages per topic and key, read from the tables of two committed batches."""
    warehouse = Warehouse(spark, shared_folder(spark, "topics-query"))
    texts = raw_texts(_events(spark, sf_dir))
    for part in range(2):
        store_ingest(warehouse, texts.filter(F.col("rid") % 2 == part), default_allowlist(), f"part_{part}", now=F.lit(NOW))
    read = (read_topic(warehouse, name) for name in (ingest.RAW_TOPIC, ingest.CLEANED_TOPIC, ingest.DLQ_TOPIC))
    found = reduce(DataFrame.unionByName, read)
    page = F.get_json_object("value", "$._metadata.canonical_entity")
    return found.withColumn("page", page).groupBy("topic", "key", "page").agg(
        F.count("*").alias("messages"), F.count(F.get_json_object("value", "$.title")).alias("titled")
    )


@query
def ingest_messages(spark, sf_dir):
    """Messages sent per topic and key, with the pages named inside the enriched texts."""
    sent = ingest.queue_records(_routed(spark, sf_dir), now=F.lit(NOW))
    named = F.get_json_object("value", "$._metadata.canonical_entity")
    stamped = F.get_json_object("value", "$._metadata.ingestion_timestamp")
    return (
        sent.withColumns({"page": named, "stamp": stamped})
        .groupBy("topic", "key", "page", "stamp")
        .agg(F.count("*").alias("messages"), F.count(F.get_json_object("value", "$.title")).alias("titled"))
    )


@query
def dlq_records(spark, sf_dir):
    """Dead letters: the original text, the reason and the time."""
    routed = _routed(spark, sf_dir).filter(F.col("route") == ingest.DLQ)
    letter = ingest.dlq_record(F.col("value"), F.col("error"), F.lit(NOW))
    return routed.select("rid", letter.alias("_letter")).select(
        "rid",
        F.get_json_object("_letter", "$.error").alias("error"),
        F.get_json_object("_letter", "$.timestamp").alias("timestamp"),
        F.get_json_object("_letter", "$.original_event.id").alias("original_id"),
    )


@query
def unfiltered_messages(spark, sf_dir):
    """Every decodable object, keyed by its id."""
    sent = ingest.unfiltered_records(raw_texts(_events(spark, sf_dir)), now=F.lit(NOW))
    return sent.select(
        "topic", "key", F.get_json_object("value", "$._ingestion_timestamp").alias("stamp")
    )


def _matched(spark, sf_dir, strategy):
    names = edit_records(_events(spark, sf_dir)).select("rid", "wiki", "title")
    return matching.match_entity(names, default_allowlist(), strategy=strategy)


@query
def allowlist_match(spark, sf_dir):
    """The monitored page of every record, list broadcast."""
    return _matched(spark, sf_dir, "broadcast")


@query
def allowlist_match_shuffled(spark, sf_dir):
    """The same through the plan for lists too long to broadcast."""
    return _matched(spark, sf_dir, "grams")


@query
def alias_matches(spark, sf_dir):
    """Every title and alias of the monitored pages, written in another way, and the page it leads to."""
    texts = sorted((n.raw, n.wiki) for n in default_allowlist())
    numbered = spark.createDataFrame([(at, *text) for at, text in enumerate(texts)], "at bigint, raw string, wiki string")
    events = _events(spark, sf_dir).select((F.col("event_id") % len(texts)).alias("at"), "event_id")
    titles = events.join(F.broadcast(numbered), "at").select(
        F.col("event_id").alias("rid"), "wiki", F.concat(F.upper(F.translate("raw", " ", "_")), F.lit(" "), "event_id").alias("title")
    )
    return matching.match_entity(titles, default_allowlist()).select("rid", "canonical_entity")


@query
def match_tables_shuffled(spark, sf_dir):
    """Part names and page addresses against needle lists made from the tables themselves."""
    parts = table(spark, sf_dir, "part").select(
        F.lit("part").alias("wiki"), F.col("p_name").alias("title"), F.col("p_partkey").alias("rid")
    )
    pages = table(spark, sf_dir, "pages").select(F.lit("page").alias("wiki"), F.col("url").alias("title"), F.col("page_id").alias("rid"))
    texts = {
        ("part", 0): parts.select(F.substring_index("title", " ", -1)),
        ("page", 0): pages.select(F.regexp_extract("title", "://([^/]*)", 1)),
        ("page", 1): pages.select(F.regexp_extract("title", "(/[a-z][a-z]/)", 1)),
    }
    lists = [
        text.toDF("raw").where("raw <> ''").distinct().select(F.lit(wiki).alias("wiki"), "raw", F.lit(kind).alias("kind"))
        for (wiki, kind), text in texts.items()
    ]
    needles = lists[0].unionByName(lists[1]).unionByName(lists[2]).select(
        "*",
        # Where several needles of a kind fit, the longest comes first, then by text.
        F.struct((-F.length("raw")).alias("length"), "raw").alias("position"),
        F.concat("wiki", F.lit(":"), "raw").alias("canonical"),
        matching.normalize_title(F.col("raw")).alias("needle"),
    )
    return matching.match_entity(parts.unionByName(pages), needles)


# Cleaned layer. ------------------------------------------------------------------------

DERIVED = (
    "bytes_changed",
    "is_revert",
    "is_anonymous",
    "event_hour",
    "processing_lag_seconds",
    "has_comment",
    "is_large_edit",
    "is_bot_consistent",
    "is_allowlisted",
    "event_date",
)


@query
def silver_derived(spark, sf_dir):
    return _derived(spark, sf_dir).select("rid", *DERIVED)


@query
def silver_dedup_batch(spark, sf_dir):
    """The first copy of every record."""
    return silver.drop_replays(_derived(spark, sf_dir)).select("rid", "meta_id", "ingestion_timestamp")


@query
def json_roundtrip(spark, sf_dir):
    """Records through JSON text, the raw layer and back: all Silver columns but the text."""
    records = queue_shaped(_events(spark, sf_dir))
    bronze = to_bronze(records, now=F.col("timestamp"))
    return silver.to_silver(silver.derive(silver.parse_events(bronze))).drop("event_data")


@query
def json_roundtrip_shredded(spark, sf_dir):
    """The same from records parsed once and stored by their members; the text is not read."""
    records = queue_shaped(_events(spark, sf_dir))
    warehouse = Warehouse(spark, shared_folder(spark, "shredded-query"))
    warehouse.append(silver.shredded(to_bronze(records, now=F.col("timestamp"))), SHREDDED_TABLE, "b_0")
    bronze = warehouse.read(SHREDDED_TABLE).drop("event_data")
    return silver.to_silver(silver.derive(silver.parse_shredded(bronze)))


@query
def json_document_comments(spark, sf_dir):
    """Whole document texts as edit comments: escaping and parsing of long texts."""
    record = F.to_json(
        F.struct(
            F.col("doc_id").alias("id"),
            F.col("source").alias("title"),
            F.col("lang").alias("wiki"),
            F.col("text").alias("comment"),
            F.struct(F.lit(0).alias("old"), F.col("n_chars").alias("new")).alias("length"),
        )
    )
    bronze = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("event_id"),
        record.alias("event_data"),
        F.lit(NOW).alias("ingestion_timestamp"),
    )
    cleaned = silver.derive(silver.parse_events(bronze))
    return cleaned.select(
        "wikimedia_id",
        "title",
        "wiki",
        F.md5("comment").alias("comment_md5"),
        F.length("comment").alias("comment_length"),
        "bytes_changed",
        "is_large_edit",
        "has_comment",
    )


# Quality. ------------------------------------------------------------------------------


@query
def gate_bronze_flags(spark, sf_dir):
    bronze = to_bronze(queue_shaped(_events(spark, sf_dir)), now=F.col("timestamp"))
    flagged = quality.bronze_gate().flag(bronze)
    return flagged.select("kafka_partition", "kafka_offset", quality.PASS_FLAG)


@query
def gate_silver_flags(spark, sf_dir):
    rules = quality.silver_rules(())
    flagged = quality.silver_helper_flags(quality.flag_rows(_derived(spark, sf_dir), rules), F.lit(NOW))
    return flagged.select(
        "rid",
        quality.PASS_FLAG,
        F.array_join(quality.REASONS, ", ").alias("reasons"),
        "has_schema_violations",
        "is_valid_type",
        "is_fresh",
        "is_temporal_valid",
    )


@query
def gate_silver_split_counts(spark, sf_dir):
    """Rows on each side of the gate per date, and the pass rate."""
    flagged = quality.silver_gate().flag(_derived(spark, sf_dir))
    passed = F.count_if(F.col(quality.PASS_FLAG))
    return flagged.groupBy("event_date").agg(
        F.count("*").alias("total_count"),
        passed.alias("passed_count"),
        (F.count("*") - passed).alias("failed_count"),
        (passed / F.count("*")).alias("pass_rate"),
    )


@query
def gate_gold_flags(spark, sf_dir):
    """The Gold gate on metrics with unknown pages, from rows the Silver gate has not seen."""
    unnamed = F.when(F.col("meta_id").isNotNull(), F.col("title"))
    rows = _derived(spark, sf_dir).withColumn("title", unnamed)
    metrics = gold.entity_metrics(rows, "1 day", exact_distinct=True)
    return quality.gold_gate().flag(metrics).select(
        "window_start", "entity", "wiki", "total_events", quality.PASS_FLAG
    )


@query
def quarantine_rows(spark, sf_dir):
    """Failed records in the quarantine format; the original is read back from its JSON."""
    failed = quality.silver_gate().flag(_derived(spark, sf_dir)).filter(~F.col(quality.PASS_FLAG))
    rows = quality.quarantine_rows(failed, "silver_0", ["SizeConstraint"], now=F.lit(NOW))
    return rows.select(
        "quarantine_reason",
        "quarantine_batch_id",
        "failed_checks",
        F.get_json_object("original_record", "$.rid").cast("bigint").alias("rid"),
        F.get_json_object("original_record", "$.title").alias("title"),
        "event_date",
    )


def _quarantined(spark, sf_dir):
    failed = quality.silver_gate().flag(_derived(spark, sf_dir)).filter(~F.col(quality.PASS_FLAG))
    return quality.quarantine_rows(failed, "silver_0", now=F.lit(NOW))


@query
def quarantine_reasons(spark, sf_dir):
    return serving.quarantine_counts(_quarantined(spark, sf_dir))


@query
def quarantine_staging(spark, sf_dir):
    """Quarantined rows per date whose reason speaks of freshness."""
    chosen = serving.quarantine_selection(_quarantined(spark, sf_dir), None, "%freshness%")
    return chosen.groupBy("event_date").agg(F.count("*").alias("rows"))


@query
def quarantine_reprocess(spark, sf_dir):
    """Rows that pass after repair: late rows get a higher limit, a missing key is filled."""

    def fix(rows: DataFrame) -> DataFrame:
        return rows.withColumn("event_id", F.coalesce("event_id", F.concat("wiki", F.lit(":"), "title")))

    rows = recovery.repaired(_quarantined(spark, sf_dir), fix)
    passed = quality.silver_gate(max_lag_seconds=7200).flag(rows).filter(quality.PASS_FLAG)
    return passed.select(
        "wikimedia_id", "event_id", "meta_id", "processing_lag_seconds", "bytes_changed", "event_date"
    )


@query
def quarantine_staged_repair(spark, sf_dir):
    """Late rows staged in a bucketed table, repaired with a higher limit, and the staging cleared."""
    root = shared_folder(spark, "staging-query")
    warehouse = Warehouse(spark, root)
    warehouse.append(_quarantined(spark, sf_dir), "silver_quarantine", "q_0")
    staging = QuarantineStaging(warehouse, f"staging_{root[-32:]}")
    try:
        staging.stage(serving.quarantine_selection(warehouse.read("silver_quarantine"), None, "%freshness%"))
        staging.repair(gate=quality.silver_gate(max_lag_seconds=7200))
        once = warehouse.read(SILVER_TABLE).count()
        staging.repair(gate=quality.silver_gate(max_lag_seconds=7200))
        left = staging.rows().count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging.name}")
    return warehouse.read(SILVER_TABLE).groupBy("event_date").agg(
        F.count("*").alias("repaired"), F.lit(left).alias("left_staged")
    ).withColumn("second_run_added", F.lit(warehouse.read(SILVER_TABLE).count() - once))


def _suite(df, constraints, keys=()):
    return quality.run_suite(df, constraints, keys)


@query
def constraint_suite_edits(spark, sf_dir):
    return _suite(_derived(spark, sf_dir), quality.silver_constraints())


@query
def constraint_suite_bronze(spark, sf_dir):
    """The raw layer's constraints over queue records of all events."""
    return _suite(bronze_projection(spark, sf_dir), quality.bronze_constraints())


@query
def constraint_suite_gold(spark, sf_dir):
    """The metric layer's constraints over hourly page metrics."""
    return _suite(_entity(spark, sf_dir, "1 hour"), quality.gold_constraints())


@query
def quarantine_counts_checks(spark, sf_dir):
    """Quarantined rows per reason and failed constraints, of two batches that failed different ones."""
    failed = quality.silver_gate().flag(_derived(spark, sf_dir)).filter(~F.col(quality.PASS_FLAG))
    early = F.col("event_date") < F.lit(REPLAY_FROM)
    first = quality.quarantine_rows(failed.filter(early), "silver_0", ["SizeConstraint"], now=F.lit(NOW))
    second = quality.quarantine_rows(
        failed.filter(~early), "silver_1", ["SizeConstraint", "CompletenessConstraint(title)"], now=F.lit(NOW)
    )
    return serving.quarantine_counts(first.unionByName(second), with_checks=True)


@query
def backlog_levels(spark, sf_dir):
    """Alarm level of each query's newest progress; an event stands for a progress report."""
    progress = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("query_name"),
        F.struct("ts", "event_id").alias("progress_time"),
        (F.col("user_id") * 1000).alias("offsets_behind"),
    )
    return serving.backlog_watch(progress)


@query
def lag_level(spark, sf_dir):
    """Alarm level of the raw layer's lag."""
    return serving.lag_watch(edit_records(_events(spark, sf_dir)), now=F.lit(NOW))


@query
def constraint_suite_orders(spark, sf_dir):
    constraints = [
        quality.has_size(1),
        quality.is_complete("o_orderkey"),
        quality.is_complete("o_custkey"),
        quality.is_positive("o_custkey"),
        quality.is_contained_in("o_orderstatus", ["F", "O"]),
        quality.satisfies("o_totalprice > 0", "price above zero"),
    ]
    return _suite(table(spark, sf_dir, "orders"), constraints)


@query
def constraint_suite_lineitem(spark, sf_dir):
    constraints = [
        quality.has_size(1),
        *map(quality.is_complete, ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")),
        quality.is_positive("l_quantity"),
        quality.is_non_negative("l_discount"),
        quality.is_contained_in("l_returnflag", ["A", "N", "R"]),
        quality.satisfies("l_discount <= 0.05", "small discounts"),
    ]
    return _suite(table(spark, sf_dir, "lineitem"), constraints)


def _daily(spark, sf_dir):
    """Per date: pass rate and failed constraints, as a gate run per date would find.

    The row gate is one more counted condition, so the table is read once.
    """
    rows = quality.silver_gate().flag(_derived(spark, sf_dir))
    gate = quality.Constraint("row gate", F.col(quality.PASS_FLAG))
    is_gate = F.col("constraint") == gate.name
    failed = ~is_gate & (F.col("constraint_status") == quality.FAILURE)
    return (
        _suite(rows, [*quality.silver_constraints(), gate], ["event_date"])
        .groupBy("event_date")
        .agg(
            F.max("rows").alias("total_count"),
            F.max(F.when(is_gate, F.col("rows_passing"))).alias("passed_count"),
            F.collect_list(F.when(failed, F.col("constraint"))).alias("_failed"),
        )
        .withColumn("pass_rate", F.col("passed_count") / F.col("total_count"))
    )


def _gated_batches(spark, sf_dir):
    """Three batches through the gate, each with rows of all dates, and what is recorded of them."""
    warehouse = Warehouse(spark, shared_folder(spark, "gated-query"))
    gate = quality.silver_gate()
    rows = _derived(spark, sf_dir)
    for part in range(3):
        result = gate.run(rows.filter(F.col("rid") % 3 == part), f"part_{part}", keep=False)
        record_metrics(warehouse, result)
    return warehouse


@query
def batches_stored(spark, sf_dir):
    """Rows per table and batch after gated batches, one of them empty, and one without a gate.

    Silver holds what passes, quarantine what fails; the empty batch leaves nothing at all.
    """
    warehouse = Warehouse(spark, shared_folder(spark, "layers-query"))
    rows = silver.to_silver(_derived(spark, sf_dir).withColumn("event_data", F.col("rid").cast("string")))
    part = F.col("wikimedia_id") % 3
    for name, chosen in {"part_0": part == 0, "part_1": part == 1, "empty": F.lit(False)}.items():
        write_batch(warehouse, SILVER_TABLE, rows.filter(chosen), name, quality.silver_gate(), keep=False)
    write_batch(warehouse, SILVER_TABLE, rows.filter(part == 2), "ungated", None, keep=False)
    counted = [
        warehouse.read(name).withColumn("batch", F.col("event_data") if batch is None else F.col(batch))
        for name, batch in ((SILVER_TABLE, None), ("silver_quarantine", "quarantine_batch_id"))
    ]
    # A stored Silver row does not name its batch; the record's number does.
    number = F.col("batch").cast("bigint") + 1
    stored = counted[0].withColumn("batch", F.when(number % 3 == 2, "ungated").otherwise(F.concat(F.lit("part_"), number % 3)))
    commits = warehouse.commits(SILVER_TABLE).select(F.lit("commits").alias("table_name"), F.col("batch_id").alias("batch"))
    return (
        stored.select(F.lit(SILVER_TABLE).alias("table_name"), "batch")
        .unionAll(counted[1].select(F.lit("silver_quarantine"), "batch"))
        .unionAll(commits)
        .groupBy("table_name", "batch")
        .agg(F.count("*").alias("rows"))
    )


@query
def quarantined_columns(spark, sf_dir):
    """Members of the quarantined originals: no flag or clock of the gate is among them."""
    record = F.explode(F.json_object_keys("original_record")).alias("member")
    return _quarantined(spark, sf_dir).select(record).groupBy("member").agg(F.count("*").alias("rows"))


@query
def suite_verdict_merged(spark, sf_dir):
    """The suite over a table, from the counts its batches left."""
    states = _gated_batches(spark, sf_dir).read("constraint_states")
    return quality.combined_verdict(states, quality.silver_constraints())


@query
def severity_merged_daily(spark, sf_dir):
    """Verdict per date from the counts of batches that each held a third of it."""
    states = _gated_batches(spark, sf_dir).read("constraint_states")
    daily = quality.combined_quality(states, quality.silver_constraints(), ["event_date"])
    return daily.withColumn("failed_constraints", F.size("failed_checks")).drop("failed_checks")


@query
def quality_metrics_recorded(spark, sf_dir):
    """What the gate records of each batch."""
    return _gated_batches(spark, sf_dir).read("quality_metrics").select(
        "batch_id", "layer", "total_count", "passed_count", "failed_count", "pass_rate", "failed_checks"
    )


@query
def alerts_recorded(spark, sf_dir):
    """The alerts those batches raise."""
    return _gated_batches(spark, sf_dir).read("alerts").select(
        "batch_id", "layer", "severity", F.array_join("channels", ",").alias("channels"), "title", "message"
    )


@query
def severity_history(spark, sf_dir):
    return _daily(spark, sf_dir).select(
        "event_date",
        "total_count",
        "passed_count",
        "pass_rate",
        F.size("_failed").alias("failed_constraints"),
        quality.severity_column(F.col("pass_rate"), F.col("_failed")).alias("severity"),
    )


@query
def threshold_watch(spark, sf_dir):
    """Alarm levels of the daily pass rates and of the raw layer's lag."""
    metrics = _daily(spark, sf_dir).select(
        F.lit("silver").alias("layer"), F.col("event_date").cast("string").alias("batch_id"), "pass_rate"
    )
    rates = serving.pass_rate_watch(metrics).select(
        F.lit("pass_rate").alias("watch"), F.col("batch_id").alias("subject"), "level"
    )
    lag = serving.lag_watch(edit_records(_events(spark, sf_dir)), now=F.lit(NOW)).select(
        F.lit("lag").alias("watch"), F.col("layer").alias("subject"), "level"
    )
    return rates.unionByName(lag)


# Metrics. ------------------------------------------------------------------------------


@query
def entity_metrics(spark, sf_dir):
    return _entity(spark, sf_dir, "1 day")


@query
def entity_metrics_10min(spark, sf_dir):
    """The default window."""
    return _entity(spark, sf_dir, "10 minutes")


@query
def entity_risk_score(spark, sf_dir):
    return _entity(spark, sf_dir, "1 hour").select(
        "window_start", "entity", "wiki", "events_zscore", "revert_ratio", "anonymous_ratio",
        "is_anomaly", "risk_score", "severity",
    )


@query
def entity_explanations(spark, sf_dir):
    return _entity(spark, sf_dir, "6 hours").select(
        "window_start", "entity", "wiki", "anomaly_types", "anomaly_explanation"
    )


@query
def user_metrics(spark, sf_dir):
    return _user(spark, sf_dir, "1 day")


@query
def user_metrics_10min(spark, sf_dir):
    return _user(spark, sf_dir, "10 minutes")


@query
def user_risk_score(spark, sf_dir):
    return _user(spark, sf_dir, "2 days").select(
        "window_start", "user_name", "is_bot", "is_anonymous", "user_type", "edits_zscore",
        "entities_zscore", "anomaly_types", "user_risk_score", "severity", "anomaly_explanation",
    )


@query
def global_metrics(spark, sf_dir):
    return _global(spark, sf_dir, "12 hours")


@query
def global_metrics_10min(spark, sf_dir):
    return _global(spark, sf_dir, "10 minutes")


@query
def global_health(spark, sf_dir):
    return _global(spark, sf_dir, "1 day").select(
        "window_start", "platform_health", "events_per_user", "events_per_entity",
        "health_score", "health_explanation",
    )


@query
def entity_metrics_approx(spark, sf_dir):
    """The default, sketch-based distinct counts (no exact oracle)."""
    return gold.entity_metrics(_cleaned(spark, sf_dir), "1 day").drop(CLOCK)


@query
def user_metrics_approx(spark, sf_dir):
    return gold.user_metrics(_cleaned(spark, sf_dir), "1 day").drop(CLOCK)


@query
def global_metrics_approx(spark, sf_dir):
    return gold.global_metrics(_cleaned(spark, sf_dir), "12 hours").drop(CLOCK)


#: Relative error of the distinct sketches, and how many times it a count may be off.
SKETCH_ERROR, SKETCH_TIMES = 0.05, 4


def _within(build, rows, window, keys, counts):
    """Per group: is each sketched distinct count near the exact one?"""
    exact = build(rows, window, exact_distinct=True).select(*keys, *(F.col(c).alias(f"exact_{c}") for c in counts))
    sketched = build(rows, window).select(*(F.col(k).alias(f"k_{k}") for k in keys), *counts)
    same = [F.col(k).eqNullSafe(F.col(f"k_{k}")) for k in keys]
    near = (
        (
            F.abs(F.col(c) - F.col(f"exact_{c}"))
            <= F.greatest(F.lit(1.0), SKETCH_TIMES * SKETCH_ERROR * F.col(f"exact_{c}"))
        ).alias(f"{c}_near")
        for c in counts
    )
    return exact.join(sketched, same).select(*keys, *near)


@query
def entity_sketch_bounds(spark, sf_dir):
    keys, counts = ("window_start", "entity", "wiki"), ("unique_editors", "unique_anonymous_editors")
    return _within(gold.entity_metrics, _cleaned(spark, sf_dir), "1 day", keys, counts)


@query
def user_sketch_bounds(spark, sf_dir):
    keys = ("window_start", "user_name", "is_bot", "is_anonymous")
    return _within(gold.user_metrics, _cleaned(spark, sf_dir), "1 day", keys, ("entities_edited", "wikis_touched"))


@query
def global_sketch_bounds(spark, sf_dir):
    counts = ("unique_users", "unique_entities", "unique_wikis")
    return _within(gold.global_metrics, _cleaned(spark, sf_dir), "12 hours", ("window_start",), counts)


@query
def quantile_bounds_lineitem(spark, sf_dir):
    """Is each quantile of the profile within its accuracy by rank? A row per numeric column."""
    rows = table(spark, sf_dir, "lineitem")
    return _ranks_near(rows, profile.column_profile(rows), 2 / 1_000)  # the profile's accuracy, on either side


def _ranks_near(rows, profiled, slack):
    """For each profiled quantile: is its rank among ``rows`` within ``slack``?"""
    found = profiled.where("quantiles IS NOT NULL").select("column_name", "quantiles").collect()

    def near(name, at, value):
        below = F.count_if(F.col(name).cast("double") < value) / F.count(name)
        up_to = F.count_if(F.col(name).cast("double") <= value) / F.count(name)
        return (below <= at + slack) & (up_to >= at - slack)

    checks = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.array(*(near(name, at, v) for at, v in zip(profile.QUANTILES, values))).alias("near"),
        )
        for name, values in found
    ]
    return rows.agg(F.array(*checks).alias("checks")).select(F.inline("checks")).select(
        "column_name", F.array_join(F.col("near").cast("array<string>"), ",").alias("near")
    )


# Baselines from history. ----------------------------------------------------------------


@query
def entity_history(spark, sf_dir):
    """Pages judged by their own trailing week instead of fixed values."""
    hours = _entity(spark, sf_dir, "1 hour")
    return history.entity_metrics(hours, hours).drop(CLOCK)


@query
def user_history(spark, sf_dir):
    hours = _user(spark, sf_dir, "1 hour")
    return history.user_metrics(hours, hours).drop(CLOCK)


@query
def global_history(spark, sf_dir):
    hours = _global(spark, sf_dir, "1 hour")
    return history.global_metrics(hours, hours).drop(CLOCK)


# Mergeable states: one pass for three families, longer windows from stored ones. --------


@query
def one_pass_pages(spark, sf_dir):
    """Page metrics of the pass that measures all three families."""
    return states.page_metrics(states.metric_states(_cleaned(spark, sf_dir))).drop(CLOCK)


@query
def one_pass_users(spark, sf_dir):
    return states.user_metrics(states.metric_states(_cleaned(spark, sf_dir))).drop(CLOCK)


@query
def one_pass_site(spark, sf_dir):
    return states.site_metrics(states.metric_states(_cleaned(spark, sf_dir))).drop(CLOCK)


def _stored_states(spark, sf_dir):
    """Ten-minute states as a table of two batches; what reads it does not read Silver."""
    warehouse = Warehouse(spark, shared_folder(spark, "states-query"))
    early = F.col("event_date") < F.lit(REPLAY_FROM)
    rows = _cleaned(spark, sf_dir)
    for name, part in (("states-1", rows.filter(early)), ("states-2", rows.filter(~early))):
        warehouse.append(states.metric_states(part), STATES_TABLE, name)
    return warehouse.read(STATES_TABLE)


@query
def page_rollup_hour(spark, sf_dir):
    """Hours from stored ten-minute states."""
    return states.page_metrics(states.roll_up(_stored_states(spark, sf_dir), "1 hour")).drop(CLOCK)


@query
def page_rollup_day(spark, sf_dir):
    """Days from hours from stored ten-minute states."""
    hours = states.roll_up(_stored_states(spark, sf_dir), "1 hour")
    return states.page_metrics(states.roll_up(hours, "1 day", base="1 hour")).drop(CLOCK)


@query
def user_rollup_day(spark, sf_dir):
    return states.user_metrics(states.roll_up(_stored_states(spark, sf_dir), "1 day")).drop(CLOCK)


@query
def site_rollup_half_day(spark, sf_dir):
    return states.site_metrics(states.roll_up(_stored_states(spark, sf_dir), "12 hours")).drop(CLOCK)


@query
def site_rollup_bounds(spark, sf_dir):
    """Are sketched counts of many values near the exact ones after days were merged to years?

    Orders stand for users, parts for pages and suppliers for wikis.
    """
    moment = F.col("l_shipdate").cast("timestamp")
    rows = table(spark, sf_dir, "lineitem").select(
        moment.alias("ingestion_timestamp"),
        F.concat(F.lit("u"), "l_orderkey").alias("user_name"),
        F.concat(F.lit("p"), "l_partkey").alias("title"),
        F.concat(F.lit("s"), "l_suppkey").alias("wiki"),
        F.lit("edit").alias("event_type"),
        F.lit(None).cast("string").alias("canonical_entity"),
        *(F.lit(False).alias(c) for c in ("is_revert", "is_anonymous", "is_bot", "is_large_edit", "has_comment")),
        *(F.lit(0).cast(kind).alias(c) for c, kind in (("bytes_changed", "int"), ("processing_lag_seconds", "bigint"), ("event_timestamp", "bigint"))),
    )
    years = states.roll_up(states.metric_states(rows, "1 day"), "365 days", base="1 day")
    found = states.site_metrics(years).select("window_start", "total_events", "unique_users", "unique_entities", "unique_wikis")
    exact = rows.groupBy(F.window("ingestion_timestamp", "365 days").start.alias("window_start")).agg(
        *(F.count_distinct(c).alias(f"exact_{c}") for c in ("user_name", "title", "wiki"))
    )

    def near(sketched: str, column: str):
        slack = F.greatest(F.lit(1.0), 4 * 0.016 * F.col(f"exact_{column}"))
        return F.abs(F.col(sketched) - F.col(f"exact_{column}")) <= slack

    return found.join(exact, "window_start").select(
        "window_start",
        "total_events",
        near("unique_users", "user_name").alias("users_near"),
        near("unique_entities", "title").alias("entities_near"),
        near("unique_wikis", "wiki").alias("wikis_near"),
    )


# Serving. ------------------------------------------------------------------------------


@query
def entity_risk_top100(spark, sf_dir):
    return serving.entity_risk_summary(_entity(spark, sf_dir, "1 hour"), as_of=F.lit(TODAY))


@query
def user_anomalies_top100(spark, sf_dir):
    return serving.user_anomalies(_user(spark, sf_dir, "6 hours"), as_of=F.lit(TODAY))


@query
def global_trend(spark, sf_dir):
    return serving.global_trend(_global(spark, sf_dir, "1 hour"), as_of=F.lit(TODAY))


@query
def freshness_by_layer(spark, sf_dir):
    layers = {"bronze": edit_records(_events(spark, sf_dir)), "silver": _cleaned(spark, sf_dir)}
    return serving.freshness(layers, now=F.lit(NOW)).select("layer", "latest", "lag_seconds")


@query
def latest_silver_event(spark, sf_dir):
    return serving.latest_arrival(_cleaned(spark, sf_dir))


# Recovery. -----------------------------------------------------------------------------


def _stored(spark, sf_dir):
    """Silver columns of the cleaned records; the text is the record in JSON."""
    rows = _cleaned(spark, sf_dir)
    return silver.to_silver(rows.withColumn("event_data", F.to_json(F.struct("rid", "title"))))


@query
def replay_from_date(spark, sf_dir):
    """Metrics of stored Silver rows, computed again from a date and put in place."""
    warehouse = Warehouse(spark, shared_folder(spark, "replay-query"))
    warehouse.append(_stored(spark, sf_dir), SILVER_TABLE, "first")
    stale = gold.entity_metrics(warehouse.read(SILVER_TABLE), "1 day", exact_distinct=True)
    warehouse.append(stale.withColumn("risk_score", F.lit(-1)), GOLD_ENTITY_TABLE, "stale")
    recovery.replay_gold(warehouse, REPLAY_FROM, families=("entity",), window="1 day", exact_distinct=True)
    return warehouse.read(GOLD_ENTITY_TABLE).select(
        "window_start", "entity", "wiki", "total_events", "unique_editors", "risk_score"
    )


@query
def as_of_read(spark, sf_dir):
    """A table as it was after its first batch, after the second, and after a rollback."""
    warehouse = Warehouse(spark, shared_folder(spark, "as-of-query"))
    rows = _stored(spark, sf_dir)
    early = F.col("event_date") < F.lit(REPLAY_FROM)
    warehouse.append(rows.filter(early), SILVER_TABLE, "batch-1")
    first = utc_now()
    warehouse.append(rows.filter(~early), SILVER_TABLE, "batch-2")
    second = utc_now()
    warehouse.rollback(SILVER_TABLE, first)

    def seen(label, as_of):
        return warehouse.read(SILVER_TABLE, as_of=as_of).groupBy(F.lit(label).alias("read"), "event_date").agg(
            F.count("*").alias("rows")
        )

    return seen("first", first).unionByName(seen("second", second)).unionByName(seen("now", None))


# Profile. ------------------------------------------------------------------------------


@query
def column_profile_orders(spark, sf_dir):
    found = profile.column_profile(table(spark, sf_dir, "orders"), exact_distinct=True, quantiles=())
    return found.select(
        "column_name", "rows", "present", "missing", "distinct_values", "min_value", "max_value",
        F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev"),
    )


@query
def column_profile_lineitem(spark, sf_dir):
    """The one-pass form with sketches and quantiles (no exact oracle)."""
    return profile.column_profile(table(spark, sf_dir, "lineitem"))


@query
def top_values_orders(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "orders"), k=5)


def _stored_profile(rows, by):
    """Profile states of each part of a table, as stored, to be merged."""
    kept = written_once(profile_states.profile_states(rows.withColumn("_part", by), rows.columns, ["_part"]), "profile")
    return kept.drop("_part")


@query
def profile_merged_orders(spark, sf_dir):
    """The profile merged from one state per month, against the whole table's."""
    rows = table(spark, sf_dir, "orders")
    found = profile_states.profile(_stored_profile(rows, F.date_format("o_orderdate", "yyyy-MM")))
    exact = profile.column_profile(rows, exact_distinct=True, quantiles=()).select(
        "column_name", F.col("distinct_values").alias("exact")
    )
    slack = F.greatest(F.lit(1.0), 4 * profile_states.DISTINCT_ERROR * F.col("exact"))
    return found.join(exact, "column_name").select(
        "column_name", "rows", "present", "missing", "min_value", "max_value",
        F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev"),
        (F.abs(F.col("distinct_values") - F.col("exact")) <= slack).alias("distinct_near"),
    )


@query
def quantile_bounds_merged(spark, sf_dir):
    """Are quantiles of merged sketches, one for each of seven parts, within their rank error?"""
    rows = table(spark, sf_dir, "lineitem")
    merged = _stored_profile(rows, F.col("l_linenumber").cast("string"))
    return _ranks_near(rows, profile_states.profile(merged), 2 * profile_states.RANK_ERROR)


@query
def frequent_values_lineitem(spark, sf_dir):
    """Values that hold a twentieth of a column, from merged sketches."""
    merged = _stored_profile(table(spark, sf_dir, "lineitem"), F.date_format("l_shipdate", "yyyy"))
    return profile_states.frequent_values(merged, 0.05)


# Streams. ------------------------------------------------------------------------------


def _drained(spark, stream, name, table_name) -> DataFrame:
    """Run a stream over all there is, storing its batches, and read them back."""
    warehouse = Warehouse(spark, shared_folder(spark, name))
    schema = stream.schema

    def write(batch: DataFrame, number: int) -> None:
        warehouse.append(batch, table_name, f"{name}_{number}")

    start(stream, write, f"{warehouse.root}/checkpoint", "0 seconds", name, once=True).awaitTermination()
    return warehouse.read(table_name, schema)


STREAMED_ENTITY = (
    "window_start", "window_end", "entity", "wiki", "total_events", "edit_count", "revert_count",
    "anonymous_edit_count", "total_bytes_changed", "revert_ratio", "anonymous_ratio",
    "anomaly_types", "risk_score", "severity", "anomaly_explanation", "event_date",
)
STREAMED_USER = (
    "window_start", "user_name", "is_bot", "is_anonymous", "total_events", "edit_count",
    "revert_count", "total_bytes_changed", "large_edit_count", "edits_with_comment",
    "revert_ratio", "edits_zscore", "event_date",
)
STREAMED_GLOBAL = (
    "window_start", "window_end", "total_events", "total_edits", "total_reverts",
    "total_anonymous", "avg_processing_lag", "max_processing_lag", "revert_ratio",
    "platform_health", "health_score", "health_explanation", "event_date",
)


def _stream_rows(spark, sf_dir):
    return silver.derive(edit_records(follow_events(spark, sf_dir)))


@query
def stream_entity_metrics(spark, sf_dir):
    """Windows a stream has closed by the end of the table; sketch columns left out."""
    metrics = gold.entity_metrics(_stream_rows(spark, sf_dir), "1 hour").select(*STREAMED_ENTITY)
    return _drained(spark, metrics, "stream-entity", "entity_windows")


@query
def stream_late_rows(spark, sf_dir):
    """What a windowed stream takes in and gives out: windows closed, and rows too late for theirs.

    The last file repeats the rows of the first, which are late by then.
    """
    rows = edit_records(follow_events(spark, sf_dir)).select("rid", "ingestion_timestamp")
    marked = rows.withWatermark("ingestion_timestamp", gold.WATERMARK)
    windows = marked.groupBy(F.window("ingestion_timestamp", "1 hour")).agg(F.count("*").alias("rows"))
    root = shared_folder(spark, "stream-late")

    def write(batch: DataFrame, number: int) -> None:
        mark = late.late_watermark(spark, f"{root}/checkpoint", number)
        _, closed, too_late = late.split(batch, mark, "1 hour")
        closed.select("window.start", "rows").write.mode("overwrite").parquet(f"{root}/windows/batch={number}")
        too_late.write.mode("overwrite").parquet(f"{root}/late/batch={number}")

    start(late.beside(windows, marked), write, f"{root}/checkpoint", "0 seconds", "late", once=True).awaitTermination()
    seen = spark.read.schema("rid bigint, ingestion_timestamp timestamp, late_reason string").parquet(f"{root}/late")
    in_time = spark.read.schema("start timestamp, rows bigint").parquet(f"{root}/windows")
    first = edit_records(_events(spark, sf_dir)).select("rid", "ingestion_timestamp")
    repeated = seen.join(first, ["rid", "ingestion_timestamp"], "left_semi")
    # Late are the rows of the first file, all of them: those up to the last of them.
    expected = first.where(F.col("ingestion_timestamp") <= F.lit(seen.agg(F.max("ingestion_timestamp")).first()[0]))
    parts = (
        in_time.select(F.lit("windowed").alias("part"), "rows"),
        seen.select(F.when(F.col("late_reason") == late.BEHIND, "late").otherwise("other").alias("part"), F.lit(1)),
        repeated.select(F.lit("repeated"), F.lit(1)),
        expected.select(F.lit("expected"), F.lit(1)),
    )

    def total(part: str):
        return F.coalesce(F.sum(F.when(F.col("part") == part, F.col("rows"))), F.lit(0))

    return reduce(DataFrame.unionAll, parts).agg(
        total("windowed").alias("windowed"),
        (total("late") > 0).alias("some_late"),
        total("other").alias("other_reasons"),
        ((total("late") == total("repeated")) & (total("late") == total("expected"))).alias("all_of_the_first_file"),
    )


@query
def stream_after_rollback(spark, sf_dir):
    """Rows per date that a stream takes up from a table whose second of three batches was rolled back.

    The third batch has the rows of the second again, without those of bots.
    """
    warehouse = Warehouse(spark, shared_folder(spark, "rolled-back"))
    rows = _stored(spark, sf_dir)
    early = F.col("event_date") < F.lit(REPLAY_FROM)
    warehouse.append(rows.filter(early), SILVER_TABLE, "batch-1")
    first = utc_now()
    warehouse.append(rows.filter(~early), SILVER_TABLE, "batch-2")
    warehouse.rollback(SILVER_TABLE, first)
    warehouse.append(rows.filter(~early & ~F.coalesce("is_bot", F.lit(False))), SILVER_TABLE, "batch-3")
    followed = follow_silver(spark, warehouse.root, once_per_record=False)
    taken = _drained(spark, followed.select("event_date", "is_bot"), "stream-rolled-back", "taken")
    return taken.groupBy("event_date").agg(F.count("*").alias("rows"), F.count_if("is_bot").alias("bot_rows"))


@query
def stream_user_metrics(spark, sf_dir):
    metrics = gold.user_metrics(_stream_rows(spark, sf_dir), "1 hour").select(*STREAMED_USER)
    return _drained(spark, metrics, "stream-user", "user_windows")


@query
def stream_global_metrics(spark, sf_dir):
    metrics = gold.global_metrics(_stream_rows(spark, sf_dir), "1 hour").select(*STREAMED_GLOBAL)
    return _drained(spark, metrics, "stream-global", "global_windows")


@query
def stream_silver_dedup(spark, sf_dir):
    """Ids that come out of the streaming replay filter; rows without id all do."""
    kept = silver.drop_replays(_stream_rows(spark, sf_dir), within="1 hour")
    kept = kept.select("meta_id", "event_date")
    return _drained(spark, kept, "stream-dedup", "kept").select("meta_id")
