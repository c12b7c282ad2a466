"""Column contracts of every layer table.

The column lists are the data model: they fix names, order and types, and each
writer projects onto them, so a drifting column fails loudly instead of being
stored under a new schema.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
    VariantType,
)

_TYPES = {
    "STRING": StringType(),
    "BINARY": BinaryType(),
    "INT": IntegerType(),
    "BIGINT": LongType(),
    "DOUBLE": DoubleType(),
    "BOOLEAN": BooleanType(),
    "DATE": DateType(),
    "TIMESTAMP": TimestampType(),
    "ARRAY<STRING>": ArrayType(StringType()),
    "VARIANT": VariantType(),
}


def _columns(text: str) -> StructType:
    """``name TYPE, ...`` as a schema, without needing a session."""
    schema = StructType()
    for column in text.split(","):
        name, kind = column.split()
        schema.add(name, _TYPES[kind])
    return schema


#: One edit record as it arrives, JSON encoded (fields we do not use are ignored).
EVENT = (
    _columns(
        """
        id BIGINT, type STRING, namespace INT, title STRING, title_url STRING,
        comment STRING, timestamp BIGINT, user STRING, bot BOOLEAN, minor BOOLEAN,
        wiki STRING, server_url STRING, notify_url STRING
        """
    )
    .add("length", _columns("old INT, new INT"))
    .add("revision", _columns("old BIGINT, new BIGINT"))
    .add("meta", _columns("uri STRING, id STRING, dt STRING, domain STRING"))
    .add("_metadata", _columns("ingestion_timestamp STRING, canonical_entity STRING"))
)

#: What a queue source delivers.
KAFKA = _columns(
    """
    key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT,
    timestamp TIMESTAMP, timestampType INT
    """
)

BRONZE = _columns(
    """
    event_id STRING, event_data STRING, kafka_topic STRING, kafka_partition INT,
    kafka_offset BIGINT, ingestion_timestamp TIMESTAMP, event_date DATE
    """
)

#: The raw layer with each record parsed once, stored path by path beside its text.
BRONZE_SHREDDED = StructType([*BRONZE.fields, *_columns("event VARIANT").fields])

SILVER = _columns(
    """
    event_id STRING, event_data STRING, wikimedia_id BIGINT, meta_id STRING,
    event_type STRING, namespace INT, title STRING, title_url STRING,
    comment STRING, event_timestamp BIGINT, user_name STRING, is_bot BOOLEAN,
    is_minor BOOLEAN, wiki STRING, server_url STRING, notify_url STRING,
    canonical_entity STRING, length_old INT, length_new INT,
    revision_old BIGINT, revision_new BIGINT, kafka_topic STRING,
    kafka_partition INT, kafka_offset BIGINT, ingestion_timestamp TIMESTAMP,
    bytes_changed INT, is_revert BOOLEAN, is_anonymous BOOLEAN, event_hour INT,
    processing_lag_seconds BIGINT, has_comment BOOLEAN, is_large_edit BOOLEAN,
    is_bot_consistent BOOLEAN, is_allowlisted BOOLEAN, event_date DATE
    """
)

#: Rows that came too late for their window, and the watermark that closed it.
SILVER_LATE = StructType([*SILVER.fields, *_columns("late_reason STRING, late_watermark TIMESTAMP").fields])

GOLD_ENTITY = _columns(
    """
    entity STRING, wiki STRING, total_events BIGINT, edit_count BIGINT,
    new_page_count BIGINT, categorize_count BIGINT, revert_count BIGINT,
    anonymous_edit_count BIGINT, bot_edit_count BIGINT,
    total_bytes_changed BIGINT, avg_bytes_changed DOUBLE,
    min_bytes_changed INT, max_bytes_changed INT, large_edit_count BIGINT,
    quality_passed_count BIGINT, quality_failed_count INT,
    unique_editors BIGINT, unique_anonymous_editors BIGINT,
    avg_processing_lag_seconds DOUBLE, max_processing_lag_seconds BIGINT,
    edits_with_comment BIGINT, first_event_timestamp BIGINT,
    last_event_timestamp BIGINT, window_start TIMESTAMP, window_end TIMESTAMP,
    revert_ratio DOUBLE, anonymous_ratio DOUBLE, bot_ratio DOUBLE,
    quality_ratio DOUBLE, baseline_events_avg DOUBLE,
    baseline_events_stddev DOUBLE, baseline_revert_ratio DOUBLE,
    baseline_anonymous_ratio DOUBLE, events_zscore DOUBLE,
    revert_deviation DOUBLE, anonymous_deviation DOUBLE,
    is_burst_activity BOOLEAN, is_high_revert_rate BOOLEAN,
    is_anonymous_surge BOOLEAN, is_large_content_change BOOLEAN,
    anomaly_types STRING, is_anomaly BOOLEAN, risk_score INT, severity STRING,
    anomaly_explanation STRING, aggregation_timestamp TIMESTAMP, event_date DATE
    """
)

GOLD_USER = _columns(
    """
    user_name STRING, is_bot BOOLEAN, is_anonymous BOOLEAN,
    total_events BIGINT, edit_count BIGINT, new_page_count BIGINT,
    revert_count BIGINT, total_bytes_changed BIGINT, avg_bytes_changed DOUBLE,
    large_edit_count BIGINT, entities_edited BIGINT, wikis_touched BIGINT,
    quality_failed_count INT, edits_with_comment BIGINT,
    window_start TIMESTAMP, window_end TIMESTAMP, revert_ratio DOUBLE,
    baseline_edits_avg DOUBLE, baseline_edits_stddev DOUBLE,
    baseline_entities_avg DOUBLE, baseline_revert_ratio DOUBLE,
    edits_zscore DOUBLE, entities_zscore DOUBLE, is_new_user_blitz BOOLEAN,
    is_mass_reverter BOOLEAN, is_cross_wiki_active BOOLEAN,
    is_high_revert_user BOOLEAN, anomaly_types STRING, is_anomaly BOOLEAN,
    user_risk_score INT, severity STRING, user_type STRING,
    anomaly_explanation STRING, aggregation_timestamp TIMESTAMP, event_date DATE
    """
)

GOLD_GLOBAL = _columns(
    """
    total_events BIGINT, total_edits BIGINT, total_new_pages BIGINT,
    total_categorize BIGINT, total_log BIGINT, total_reverts BIGINT,
    total_anonymous BIGINT, total_bot BIGINT, total_large_edits BIGINT,
    total_bytes_changed BIGINT, avg_bytes_changed DOUBLE,
    total_quality_failed INT, unique_users BIGINT, unique_entities BIGINT,
    unique_wikis BIGINT, avg_processing_lag DOUBLE, max_processing_lag BIGINT,
    window_start TIMESTAMP, window_end TIMESTAMP, revert_ratio DOUBLE,
    anonymous_ratio DOUBLE, bot_ratio DOUBLE, baseline_events_avg DOUBLE,
    baseline_events_stddev DOUBLE, baseline_revert_ratio DOUBLE,
    baseline_anonymous_ratio DOUBLE, events_zscore DOUBLE,
    revert_deviation DOUBLE, anonymous_deviation DOUBLE, platform_health STRING,
    events_per_user DOUBLE, events_per_entity DOUBLE, health_score INT,
    health_explanation STRING, aggregation_timestamp TIMESTAMP, event_date DATE
    """
)

METRIC_STATES = _columns(
    """
    family STRING, window_start TIMESTAMP, window_end TIMESTAMP, entity STRING, wiki STRING,
    user_name STRING, is_bot BOOLEAN, is_anonymous BOOLEAN, total_events BIGINT,
    edit_count BIGINT, new_count BIGINT, categorize_count BIGINT, log_count BIGINT,
    revert_count BIGINT, anonymous_count BIGINT, bot_count BIGINT, large_count BIGINT,
    comment_count BIGINT, bytes_sum BIGINT, bytes_min INT, bytes_max INT, lag_sum BIGINT,
    lag_count BIGINT, lag_max BIGINT, first_event BIGINT, last_event BIGINT, users BINARY,
    anonymous_users BINARY, entities BINARY, wikis BINARY, event_date DATE
    """
)

QUARANTINE = _columns(
    """
    quarantine_timestamp TIMESTAMP, quarantine_reason STRING,
    quarantine_batch_id STRING, failed_checks STRING, original_record STRING,
    event_date DATE
    """
)

QUALITY_METRICS = _columns(
    """
    batch_id STRING, layer STRING, total_count BIGINT, passed_count BIGINT,
    failed_count BIGINT, pass_rate DOUBLE, failed_checks STRING,
    check_timestamp TIMESTAMP, event_date DATE
    """
)

CONSTRAINT_STATES = _columns(
    """
    layer STRING, constraint STRING, rows BIGINT, rows_passing BIGINT, event_date DATE
    """
)

ALERTS = _columns(
    """
    batch_id STRING, layer STRING, severity STRING, channels ARRAY<STRING>,
    title STRING, message STRING, alert_timestamp TIMESTAMP, event_date DATE
    """
)

#: Queue messages of all topics; the topic is the leading partition column.
TOPICS = _columns("topic STRING, key STRING, value STRING, event_date DATE")

INGEST_COUNTERS = _columns(
    "processed BIGINT, filtered BIGINT, sent BIGINT, errors BIGINT, event_date DATE"
)

COMMITS = _columns(
    """
    table_name STRING, batch_id STRING, action STRING, from_date DATE,
    restored_to TIMESTAMP, row_count BIGINT, committed_at TIMESTAMP
    """
)

PROGRESS = _columns(
    """
    query_name STRING, query_id STRING, batch_id BIGINT, progress_time STRING,
    num_input_rows BIGINT, input_rows_per_second DOUBLE,
    processed_rows_per_second DOUBLE, offsets_behind BIGINT, watermark STRING,
    rows_dropped_late BIGINT, observed STRING, event_date DATE
    """
)

#: Table names a pipeline run creates below its root.
BRONZE_TABLE = "bronze_events"
SILVER_TABLE = "silver_events"
GOLD_ENTITY_TABLE = "gold_entity_metrics_10min"
GOLD_USER_TABLE = "gold_user_metrics_10min"
GOLD_GLOBAL_TABLE = "gold_global_metrics_10min"
STATES_TABLE = "metric_states_10min"
TOPICS_TABLE = "topics"
LATE_TABLE = "silver_late"
SHREDDED_TABLE = "bronze_shredded"

TABLES = {
    BRONZE_TABLE: BRONZE,
    SILVER_TABLE: SILVER,
    GOLD_ENTITY_TABLE: GOLD_ENTITY,
    GOLD_USER_TABLE: GOLD_USER,
    GOLD_GLOBAL_TABLE: GOLD_GLOBAL,
    SHREDDED_TABLE: BRONZE_SHREDDED,
    STATES_TABLE: METRIC_STATES,
    LATE_TABLE: SILVER_LATE,
    "bronze_quarantine": QUARANTINE,
    "silver_quarantine": QUARANTINE,
    "gold_quarantine": QUARANTINE,
    "quality_metrics": QUALITY_METRICS,
    "alerts": ALERTS,
    "constraint_states": CONSTRAINT_STATES,
    "ingest_counters": INGEST_COUNTERS,
    TOPICS_TABLE: TOPICS,
}
