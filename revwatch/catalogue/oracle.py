"""ANSI SQL for the registered queries, written from the rules, not from our plans.

Every threshold is spelled out again here; only the map from ``events`` to edit
records is shared with the Spark side.
"""

from __future__ import annotations

import re

from revwatch.catalogue.records import FAULTS, RECORD_COLUMNS
from revwatch.sources.allowlist import DEFAULT_PAGES

ADDRESS = r"^(\d{1,3}\.){3}\d{1,3}$|^([0-9a-fA-F]{0,4}:){2,7}[0-9a-fA-F]{0,4}$"

_EPOCH = "CAST(floor(epoch(ts)) AS BIGINT)"
_RECORDS = ",\n ".join(f"{sql.format(epoch=_EPOCH)} AS {name}" for name, sql in RECORD_COLUMNS.items())


def _double(value: float) -> str:
    return f"CAST({value} AS DOUBLE)"


BASE = f"""
WITH mapped AS (
 SELECT {_RECORDS}
 FROM events
), records AS (
 SELECT *, event_timestamp + lag_s AS arrival,
  make_timestamp((event_timestamp + lag_s) * 1000000) AS ingestion_timestamp
 FROM mapped
), derived AS (
 SELECT *,
  CAST(coalesce(length_new, 0) - coalesce(length_old, 0) AS INT) AS bytes_changed,
  coalesce(length_new, 0) - coalesce(length_old, 0) < 0 AS is_revert,
  regexp_matches(user_name, '{ADDRESS}') AS is_anonymous,
  CAST(hour(make_timestamp(event_timestamp * 1000000)) AS INT) AS event_hour,
  arrival - event_timestamp AS processing_lag_seconds,
  coalesce(length(comment), 0) > 0 AS has_comment,
  abs(coalesce(length_new, 0) - coalesce(length_old, 0)) > 10240 AS is_large_edit,
  CASE WHEN is_bot THEN regexp_matches(user_name, '(?i)bot')
       ELSE NOT regexp_matches(user_name, '(?i)bot') END AS is_bot_consistent,
  canonical_entity IS NOT NULL AS is_allowlisted,
  CAST(ingestion_timestamp AS DATE) AS event_date
 FROM records
), ranked AS (
 SELECT *, row_number() OVER (PARTITION BY coalesce(meta_id, '#' || rid)
   ORDER BY ingestion_timestamp, kafka_topic, kafka_partition, kafka_offset) AS copy
 FROM derived
), judged AS (
 SELECT *,
  coalesce(event_id IS NOT NULL AND meta_id IS NOT NULL AND wikimedia_id > 0
   AND event_type IN ('edit', 'new', 'log', 'categorize')
   AND title IS NOT NULL AND user_name IS NOT NULL AND wiki IS NOT NULL AND namespace >= 0
   AND processing_lag_seconds BETWEEN 0 AND 3600 AND event_timestamp > 1640995200, FALSE) AS ok
 FROM ranked
), cleaned AS (
 SELECT * FROM judged WHERE copy = 1 AND ok
)"""

REASONS = """concat_ws(', ',
  CASE WHEN event_id IS NULL THEN 'missing:event_id' END,
  CASE WHEN meta_id IS NULL THEN 'missing:meta_id' END,
  CASE WHEN wikimedia_id IS NULL THEN 'missing:wikimedia_id' END,
  CASE WHEN wikimedia_id IS NULL OR wikimedia_id <= 0 THEN 'range:wikimedia_id' END,
  CASE WHEN event_type IS NULL OR event_type NOT IN ('edit', 'new', 'log', 'categorize')
   THEN 'valid_type:event_type' END,
  CASE WHEN title IS NULL THEN 'missing:title' END,
  CASE WHEN user_name IS NULL THEN 'missing:user_name' END,
  CASE WHEN wiki IS NULL THEN 'missing:wiki' END,
  CASE WHEN namespace IS NULL OR namespace < 0 THEN 'range:namespace' END,
  CASE WHEN processing_lag_seconds < 0 OR processing_lag_seconds > 3600
   THEN 'freshness:processing_lag_seconds' END,
  CASE WHEN event_timestamp <= 1640995200 THEN 'temporal:event_timestamp' END)"""

TEN_MINUTES, HOUR, DAY = 600, 3600, 86400


def _window(width: int) -> str:
    return f"make_timestamp((arrival - arrival % {width}) * 1000000)"


def _window_end(width: int) -> str:
    return f"make_timestamp((arrival - arrival % {width} + {width}) * 1000000)"


def _count(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


def _cases(value: str, steps, default=0) -> str:
    arms = " ".join(f"WHEN {value} > {_double(bound)} THEN {score}" for bound, score in steps)
    return f"CASE {arms} ELSE {default} END"


def _grade(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 50 THEN 'CRITICAL' WHEN {score} >= 30 THEN 'HIGH'"
        f" WHEN {score} >= 15 THEN 'MEDIUM' WHEN {score} > 0 THEN 'LOW' ELSE 'NORMAL' END"
    )


def _pct(value: str) -> str:
    return f"round({value} * 100, 1) || '%'"


def _entity(width: int, source: str = "cleaned") -> str:
    """CTE ``entity`` after ``BASE``."""
    return f"""{BASE}, counted AS (
 SELECT coalesce(canonical_entity, title) AS entity, wiki,
  {_window(width)} AS window_start, {_window_end(width)} AS window_end,
  count(*) AS total_events,
  {_count("event_type = 'edit'")} AS edit_count,
  {_count("event_type = 'new'")} AS new_page_count,
  {_count("event_type = 'categorize'")} AS categorize_count,
  {_count("is_revert")} AS revert_count,
  {_count("is_anonymous")} AS anonymous_edit_count,
  {_count("is_bot")} AS bot_edit_count,
  CAST(sum(coalesce(bytes_changed, 0)) AS BIGINT) AS total_bytes_changed,
  avg(coalesce(bytes_changed, 0)) AS avg_bytes_changed,
  min(bytes_changed) AS min_bytes_changed, max(bytes_changed) AS max_bytes_changed,
  {_count("is_large_edit")} AS large_edit_count,
  count(*) AS quality_passed_count, CAST(0 AS INT) AS quality_failed_count,
  count(DISTINCT user_name) AS unique_editors,
  count(DISTINCT CASE WHEN is_anonymous THEN user_name END) AS unique_anonymous_editors,
  avg(processing_lag_seconds) AS avg_processing_lag_seconds,
  max(processing_lag_seconds) AS max_processing_lag_seconds,
  {_count("has_comment")} AS edits_with_comment,
  min(event_timestamp) AS first_event_timestamp, max(event_timestamp) AS last_event_timestamp
 FROM {source} GROUP BY 1, 2, 3, 4
), rated AS (
 SELECT *,
  CASE WHEN edit_count > 0 THEN revert_count / edit_count ELSE {_double(0)} END AS revert_ratio,
  anonymous_edit_count / total_events AS anonymous_ratio,
  bot_edit_count / total_events AS bot_ratio,
  quality_passed_count / total_events AS quality_ratio,
  {_double(5.0)} AS baseline_events_avg, {_double(3.0)} AS baseline_events_stddev,
  {_double(0.12)} AS baseline_revert_ratio, {_double(0.25)} AS baseline_anonymous_ratio
 FROM counted
), compared AS (
 SELECT *, (total_events - baseline_events_avg) / baseline_events_stddev AS events_zscore,
  revert_ratio - baseline_revert_ratio AS revert_deviation,
  anonymous_ratio - baseline_anonymous_ratio AS anonymous_deviation
 FROM rated
), flagged AS (
 SELECT *, events_zscore > 2 AS is_burst_activity,
  revert_ratio > baseline_revert_ratio * {_double(2.5)} AS is_high_revert_rate,
  anonymous_ratio > baseline_anonymous_ratio * {_double(2.0)} AS is_anonymous_surge,
  abs(total_bytes_changed) > 51200 AS is_large_content_change
 FROM compared
), scored AS (
 SELECT *,
  concat_ws(', ', CASE WHEN is_burst_activity THEN 'BURST' END,
   CASE WHEN is_high_revert_rate THEN 'HIGH_REVERT' END,
   CASE WHEN is_anonymous_surge THEN 'ANON_SURGE' END,
   CASE WHEN is_large_content_change THEN 'LARGE_CHANGE' END) AS anomaly_types,
  is_burst_activity OR is_high_revert_rate OR is_anonymous_surge OR is_large_content_change
   AS is_anomaly,
  CAST({_cases("events_zscore", ((3, 25), (2, 15), (1, 5)))}
   + {_cases("revert_ratio", ((0.5, 30), (0.3, 20), (0.2, 10)))}
   + {_cases("anonymous_ratio", ((0.7, 25), (0.5, 15), (0.35, 5)))}
   + CASE WHEN is_large_content_change THEN 15 ELSE 0 END
   + CASE WHEN quality_ratio < {_double(0.9)} THEN 5 ELSE 0 END AS INT) AS risk_score
 FROM flagged
), entity AS (
 SELECT *, {_grade("risk_score")} AS severity,
  CASE WHEN NOT is_anomaly THEN 'Normal activity' ELSE concat_ws(' | ',
   CASE WHEN is_burst_activity
    THEN 'Events: ' || total_events || ' (' || round(events_zscore, 1) || 'σ above normal)' END,
   CASE WHEN is_high_revert_rate THEN 'Revert rate: ' || {_pct("revert_ratio")}
    || ' (baseline: ' || {_pct("baseline_revert_ratio")} || ')' END,
   CASE WHEN is_anonymous_surge THEN 'Anonymous: ' || {_pct("anonymous_ratio")}
    || ' (baseline: ' || {_pct("baseline_anonymous_ratio")} || ')' END,
   CASE WHEN is_large_content_change
    THEN 'Content change: ' || round(abs(total_bytes_changed) / 1024, 1) || 'KB' END) END
   AS anomaly_explanation,
  CAST(window_start AS DATE) AS event_date
 FROM scored
)"""


def _user(width: int, source: str = "cleaned") -> str:
    """CTE ``users`` after ``BASE``."""
    return f"""{BASE}, counted AS (
 SELECT user_name, is_bot, is_anonymous,
  {_window(width)} AS window_start, {_window_end(width)} AS window_end,
  count(*) AS total_events,
  {_count("event_type = 'edit'")} AS edit_count,
  {_count("event_type = 'new'")} AS new_page_count,
  {_count("is_revert")} AS revert_count,
  CAST(sum(coalesce(bytes_changed, 0)) AS BIGINT) AS total_bytes_changed,
  avg(coalesce(bytes_changed, 0)) AS avg_bytes_changed,
  {_count("is_large_edit")} AS large_edit_count,
  count(DISTINCT coalesce(canonical_entity, title)) AS entities_edited,
  count(DISTINCT wiki) AS wikis_touched,
  CAST(0 AS INT) AS quality_failed_count,
  {_count("has_comment")} AS edits_with_comment
 FROM {source} GROUP BY 1, 2, 3, 4, 5
), rated AS (
 SELECT *,
  CASE WHEN edit_count > 0 THEN revert_count / edit_count ELSE {_double(0)} END AS revert_ratio,
  {_double(2.0)} AS baseline_edits_avg, {_double(1.5)} AS baseline_edits_stddev,
  {_double(1.5)} AS baseline_entities_avg, {_double(0.10)} AS baseline_revert_ratio
 FROM counted
), compared AS (
 SELECT *, (edit_count - baseline_edits_avg) / baseline_edits_stddev AS edits_zscore,
  (entities_edited - baseline_entities_avg) / {_double(1.0)} AS entities_zscore
 FROM rated
), flagged AS (
 SELECT *, edits_zscore > 2 AND entities_edited > 3 AS is_new_user_blitz,
  revert_count > 3 AS is_mass_reverter, wikis_touched > 2 AS is_cross_wiki_active,
  revert_ratio > baseline_revert_ratio * {_double(3.0)} AS is_high_revert_user
 FROM compared
), scored AS (
 SELECT *,
  concat_ws(', ', CASE WHEN is_new_user_blitz THEN 'BLITZ' END,
   CASE WHEN is_mass_reverter THEN 'MASS_REVERT' END,
   CASE WHEN is_cross_wiki_active THEN 'CROSS_WIKI' END,
   CASE WHEN is_high_revert_user THEN 'HIGH_REVERT' END) AS anomaly_types,
  is_new_user_blitz OR is_mass_reverter OR is_cross_wiki_active OR is_high_revert_user
   AS is_anomaly,
  CAST(CASE WHEN edits_zscore > 4 THEN 35 WHEN is_new_user_blitz THEN 25
        WHEN edits_zscore > 2 THEN 10 ELSE 0 END
   + CASE WHEN revert_count > 5 THEN 30 WHEN is_mass_reverter THEN 20 ELSE 0 END
   + CASE WHEN wikis_touched > 3 THEN 15 WHEN is_cross_wiki_active THEN 10 ELSE 0 END
   + {_cases("revert_ratio", ((0.5, 20), (0.3, 10)))} AS INT) AS user_risk_score,
  CASE WHEN is_bot THEN 'Bot' WHEN is_anonymous THEN 'Anonymous' ELSE 'Registered' END AS user_type
 FROM flagged
), users AS (
 SELECT *, {_grade("user_risk_score")} AS severity,
  CASE WHEN NOT is_anomaly THEN 'Normal activity' ELSE concat_ws(' | ',
   CASE WHEN is_new_user_blitz THEN 'Edits: ' || edit_count || ' across ' || entities_edited
    || ' entities (' || round(edits_zscore, 1) || 'σ)' END,
   CASE WHEN is_mass_reverter THEN 'Reverts: ' || revert_count || ' in 10min' END,
   CASE WHEN is_cross_wiki_active THEN 'Cross-wiki: ' || wikis_touched || ' wikis' END,
   CASE WHEN is_high_revert_user THEN 'Revert ratio: ' || {_pct("revert_ratio")} END) END
   AS anomaly_explanation,
  CAST(window_start AS DATE) AS event_date
 FROM scored
)"""


def _global(width: int, source: str = "cleaned") -> str:
    """CTE ``site`` after ``BASE``."""
    return f"""{BASE}, counted AS (
 SELECT {_window(width)} AS window_start, {_window_end(width)} AS window_end,
  count(*) AS total_events,
  {_count("event_type = 'edit'")} AS total_edits,
  {_count("event_type = 'new'")} AS total_new_pages,
  {_count("event_type = 'categorize'")} AS total_categorize,
  {_count("event_type = 'log'")} AS total_log,
  {_count("is_revert")} AS total_reverts, {_count("is_anonymous")} AS total_anonymous,
  {_count("is_bot")} AS total_bot, {_count("is_large_edit")} AS total_large_edits,
  CAST(sum(coalesce(bytes_changed, 0)) AS BIGINT) AS total_bytes_changed,
  avg(coalesce(bytes_changed, 0)) AS avg_bytes_changed,
  CAST(0 AS INT) AS total_quality_failed,
  count(DISTINCT user_name) AS unique_users,
  count(DISTINCT coalesce(canonical_entity, title)) AS unique_entities,
  count(DISTINCT wiki) AS unique_wikis,
  avg(processing_lag_seconds) AS avg_processing_lag,
  max(processing_lag_seconds) AS max_processing_lag
 FROM {source} GROUP BY 1, 2
), rated AS (
 SELECT *,
  CASE WHEN total_edits > 0 THEN total_reverts / total_edits ELSE {_double(0)} END AS revert_ratio,
  total_anonymous / total_events AS anonymous_ratio, total_bot / total_events AS bot_ratio,
  {_double(150.0)} AS baseline_events_avg, {_double(50.0)} AS baseline_events_stddev,
  {_double(0.12)} AS baseline_revert_ratio, {_double(0.25)} AS baseline_anonymous_ratio,
  CASE WHEN unique_users > 0 THEN total_events / unique_users ELSE {_double(0)} END
   AS events_per_user,
  CASE WHEN unique_entities > 0 THEN total_events / unique_entities ELSE {_double(0)} END
   AS events_per_entity
 FROM counted
), compared AS (
 SELECT *, (total_events - baseline_events_avg) / baseline_events_stddev AS events_zscore,
  revert_ratio - baseline_revert_ratio AS revert_deviation,
  anonymous_ratio - baseline_anonymous_ratio AS anonymous_deviation
 FROM rated
), graded AS (
 SELECT *,
  CASE WHEN revert_ratio > {_double(0.25)} OR events_zscore > 3 THEN 'CRITICAL'
   WHEN revert_ratio > {_double(0.18)} OR events_zscore > 2 THEN 'WARNING'
   WHEN revert_ratio > {_double(0.15)} OR events_zscore > 1 THEN 'ELEVATED'
   ELSE 'HEALTHY' END AS platform_health,
  CAST(100 - ({_cases("revert_ratio", ((0.25, 30), (0.18, 20), (0.12, 10)))}
   + {_cases("abs(events_zscore)", ((3, 25), (2, 15), (1, 5)))}
   + {_cases("anonymous_ratio", ((0.5, 20), (0.35, 10)))}
   + {_cases("avg_processing_lag", ((300, 15), (120, 5)))}) AS INT) AS health_score
 FROM compared
), site AS (
 SELECT *,
  CASE WHEN platform_health = 'HEALTHY' THEN 'All metrics within normal range'
   ELSE concat_ws(' | ',
    CASE WHEN revert_ratio > {_double(0.15)}
     THEN 'Revert ratio: ' || {_pct("revert_ratio")} || ' (baseline: 12%)' END,
    CASE WHEN abs(events_zscore) > 1
     THEN 'Volume: ' || round(events_zscore, 1) || 'σ from normal' END,
    CASE WHEN anonymous_ratio > {_double(0.35)} THEN 'Anonymous: ' || {_pct("anonymous_ratio")} END)
   END AS health_explanation,
  CAST(window_start AS DATE) AS event_date
 FROM graded
)"""


def _history(sql: str, keys: str, means: dict, ratios: dict, defaults: dict) -> str:
    """A family's CTEs with the fixed baselines replaced by trailing ones.

    The last seven days with windows of the same key, of which the newest has ended.
    """
    on = " AND ".join(f"h.{k} IS NOT DISTINCT FROM c.{k}" for k in keys.split(", ") if k) or "true"
    group = f"{keys}, " if keys else ""
    by = f"PARTITION BY {keys} " if keys else ""
    frame = f"OVER ({by}ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)"
    sums = [f"sum({m}) AS s_{n}, sum({m} * {m}) AS q_{n}" for n, m in means.items()]
    sums += [f"sum({p}) AS p_{n}, sum({w}) AS w_{n}" for n, (p, w) in ratios.items()]
    names = [f"{x}_{n}" for n in means for x in "sq"] + [f"{x}_{n}" for n in ratios for x in "pw"]
    chosen = []
    for name, value in defaults.items():
        what, kind = name.rsplit("_", 1)
        figure = {
            "avg": f"CAST(s_{what} AS DOUBLE) / n",
            "stddev": f"greatest(sqrt(CAST(n * q_{what} - s_{what} * s_{what} AS DOUBLE) / (CAST(n AS DOUBLE) * (n - 1))), {_double(0.5)})",
            "ratio": f"CASE WHEN w_{what} > 0 THEN p_{what} / w_{what} ELSE {_double(0)} END",
        }[kind]
        chosen.append(f"CASE WHEN n >= 12 THEN {figure} ELSE {_double(value)} END AS baseline_{name}")
        sql = re.sub(rf",\s*{re.escape(_double(value))} AS baseline_{name}\b", "", sql, count=1)
    extra = f"""daily AS (
 SELECT {group}CAST(window_start AS DATE) AS day, count(*) AS windows, {", ".join(sums)} FROM counted GROUP BY ALL
), trail AS (
 SELECT {group}day + 1 AS valid_from, sum(windows) {frame} AS n,
  {", ".join(f"sum({n}) {frame} AS {n}" for n in names)} FROM daily
), newest AS (
 SELECT c.*, h.* EXCLUDE ({group}valid_from), row_number() OVER (
   PARTITION BY {"".join(f"c.{k}, " for k in keys.split(", ") if k)}c.window_start ORDER BY h.valid_from DESC NULLS LAST) AS newness
 FROM counted c LEFT JOIN trail h ON {on} AND h.valid_from <= c.window_start
), based AS (
 SELECT * EXCLUDE (n, newness, {", ".join(names)}), {", ".join(chosen)} FROM newest WHERE newness = 1
), rated AS ("""
    head, tail = sql.split("rated AS (", 1)
    return head + extra + tail.replace("FROM counted", "FROM based", 1)


_PAGE_HISTORY = (
    "entity, wiki",
    {"events": "total_events"},
    {"revert": ("revert_count", "edit_count"), "anonymous": ("anonymous_edit_count", "total_events")},
    {"events_avg": 5.0, "events_stddev": 3.0, "revert_ratio": 0.12, "anonymous_ratio": 0.25},
)
_USER_HISTORY = (
    "user_name, is_bot, is_anonymous",
    {"edits": "edit_count", "entities": "entities_edited"},
    {"revert": ("revert_count", "edit_count")},
    {"edits_avg": 2.0, "edits_stddev": 1.5, "entities_avg": 1.5, "entities_stddev": 1.0, "revert_ratio": 0.10},
)
_SITE_HISTORY = (
    "",
    {"events": "total_events"},
    {"revert": ("total_reverts", "total_edits"), "anonymous": ("total_anonymous", "total_events")},
    {"events_avg": 150.0, "events_stddev": 50.0, "revert_ratio": 0.12, "anonymous_ratio": 0.25},
)


def _suite(name: str, rows: str, good: str, size: bool = False) -> str:
    holds = f"{rows} >= 1" if size else f"{rows} > 0 AND {good} = {rows}"
    return (
        f"SELECT '{name}' AS constraint, CASE WHEN {holds} THEN 'Success' ELSE 'Failure' END"
        f" AS constraint_status, {rows} AS rows, {good} AS rows_passing FROM m"
    )


def _suite_sql(prefix: str, source: str, checks: dict[str, str]) -> str:
    """``checks`` maps a constraint name to the condition its rows must meet."""
    counts = ", ".join(f"{_count(cond)} AS g{i}" for i, cond in enumerate(checks.values()))
    parts = [_suite("SizeConstraint(rows >= 1)", "n", "n", size=True)]
    parts += [_suite(name, "n", f"g{i}") for i, name in enumerate(checks)]
    return f"{prefix} m AS (SELECT count(*) AS n, {counts} FROM {source})\n" + "\nUNION ALL ".join(parts)


def _complete(*columns: str) -> dict[str, str]:
    return {f"CompletenessConstraint({c})": f"{c} IS NOT NULL" for c in columns}


def _complies(label: str, condition: str) -> dict[str, str]:
    return {f"ComplianceConstraint({label})": condition}


SILVER_CHECKS = {
    **_complete(
        "event_id", "meta_id", "wikimedia_id", "event_type", "title", "user_name", "wiki",
        "event_timestamp", "processing_lag_seconds",
    ),
    **_complies(
        "event_type contained in edit,new,log,categorize",
        "event_type IS NULL OR event_type IN ('edit', 'new', 'log', 'categorize')",
    ),
    **_complies("namespace is non-negative", "coalesce(namespace, 0) >= 0"),
    **_complies("wikimedia_id is positive", "coalesce(wikimedia_id, 1) > 0"),
    **_complies("Events should not arrive before they happen", "processing_lag_seconds >= 0"),
    **_complies("Events should arrive within 1 hour (freshness)", "processing_lag_seconds <= 3600"),
    **_complies("Events should be after 2022-01-01", "event_timestamp > 1640995200"),
}


def _daily() -> str:
    failures = " + ".join(
        f"CASE WHEN count(*) FILTER (WHERE {cond}) < count(*) THEN 1 ELSE 0 END"
        for cond in SILVER_CHECKS.values()
    )
    critical = " OR ".join(
        f"count(*) FILTER (WHERE {cond}) < count(*)"
        for name, cond in SILVER_CHECKS.items()
        if name.startswith("Completeness")
    )
    return f"""{BASE}, daily AS (
 SELECT event_date, count(*) AS total_count, {_count("ok")} AS passed_count,
  {_count("ok")} / count(*) AS pass_rate,
  CAST({failures} AS INT) AS failed_constraints, ({critical}) AS critical
 FROM judged GROUP BY event_date
)"""


def _batches() -> str:
    """CTE ``batches``: counts and failed constraints of three batches after ``BASE``."""
    failed = ", ".join(
        f"""CASE WHEN count(*) FILTER (WHERE {cond}) < count(*) THEN '"{name}"' END"""
        for name, cond in SILVER_CHECKS.items()
    )
    return f"""{BASE}, batches AS (
 SELECT 'part_' || (rid % 3) AS batch_id, 'silver' AS layer, count(*) AS total_count,
  {_count("ok")} AS passed_count, {_count("NOT ok")} AS failed_count, {_count("ok")} / count(*) AS pass_rate,
  '[' || concat_ws(', ', {failed}) || ']' AS failed_checks
 FROM judged GROUP BY 1
), graded AS (
 SELECT *, {_severity("contains(failed_checks, 'Complete')")} AS severity FROM batches
)"""


def _severity(critical: str) -> str:
    return f"""CASE WHEN pass_rate < {_double(0.8)} THEN 'CRITICAL'
  WHEN pass_rate < {_double(0.95)} AND {critical} THEN 'CRITICAL'
  WHEN pass_rate < {_double(0.95)} OR {critical} THEN 'WARNING' ELSE 'SUCCESS' END"""


# The faulty JSON texts, by what becomes of them.
_BROKEN, _EMPTY, _LIST, _NO_TITLE, _NULL_TITLE, _NO_TEXT = (
    condition.replace("event_id", "rid") for condition, _ in FAULTS
)
_LEVELS = (
    (_BROKEN, "malformed"), (_EMPTY, "skipped"), (_LIST, "list"), (_NO_TITLE, "no_title"),
    (_NULL_TITLE, "null_title"), (_NO_TEXT, "skipped"),
)
_FAULT = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name in _LEVELS) + " ELSE 'good' END"
ROUTED = f"""{BASE}, faults AS (
 SELECT *, {_FAULT} AS fault FROM records
), routed AS (
 SELECT *,
  CASE WHEN fault IN ('malformed', 'skipped') THEN fault WHEN fault <> 'good' THEN 'dlq'
   WHEN canonical_entity IS NULL THEN 'filtered' ELSE 'cleaned' END AS route,
  CASE fault WHEN 'list' THEN 'Record is not a JSON object'
   WHEN 'no_title' THEN 'Missing required fields'
   WHEN 'null_title' THEN 'Title is not a text' END AS error
 FROM faults
)"""

_SHOWN_ENTITY = (
    "entity, wiki, window_start, total_events, edit_count, revert_count, anonymous_edit_count,"
    " risk_score, revert_ratio, anonymous_ratio"
)
_MATCH = f"{BASE} SELECT rid, wiki, title, canonical_entity FROM records"
_WHOLE_DAY = "DATE '2024-01-30' - 1"

# A stream closes the windows that end at or before its watermark.
_CLOSED = "(SELECT make_timestamp((max(arrival) - 600) * 1000000) FROM derived)"
_NOW = "TIMESTAMP '2024-02-01 00:00:00'"


def _all_but(cte: str, *hidden: str) -> str:
    return f"SELECT * EXCLUDE ({', '.join(hidden)}) FROM {cte}" if hidden else f"SELECT * FROM {cte}"


_ORDERS_PROFILE = """
            SELECT 'o_orderkey' AS column_name, count(*) AS rows, count(o_orderkey) AS present,
             count(*) - count(o_orderkey) AS missing, count(DISTINCT o_orderkey) AS distinct_values,
             CAST(min(o_orderkey) AS VARCHAR) AS min_value, CAST(max(o_orderkey) AS VARCHAR) AS max_value,
             round(avg(o_orderkey), 2) AS mean, round(stddev_samp(o_orderkey), 2) AS stddev FROM orders
            UNION ALL
            SELECT 'o_custkey', count(*), count(o_custkey), count(*) - count(o_custkey),
             count(DISTINCT o_custkey), CAST(min(o_custkey) AS VARCHAR), CAST(max(o_custkey) AS VARCHAR),
             round(avg(o_custkey), 2), round(stddev_samp(o_custkey), 2) FROM orders
            UNION ALL
            SELECT 'o_totalprice', count(*), count(o_totalprice), count(*) - count(o_totalprice),
             count(DISTINCT o_totalprice), CAST(min(o_totalprice) AS VARCHAR),
             CAST(max(o_totalprice) AS VARCHAR), round(avg(o_totalprice), 2),
             round(stddev_samp(o_totalprice), 2) FROM orders
            UNION ALL
            SELECT 'o_orderstatus', count(*), count(o_orderstatus), count(*) - count(o_orderstatus),
             count(DISTINCT o_orderstatus), min(o_orderstatus), max(o_orderstatus), NULL, NULL FROM orders
            UNION ALL
            SELECT 'o_orderdate', count(*), count(o_orderdate), count(*) - count(o_orderdate),
             count(DISTINCT o_orderdate), CAST(min(o_orderdate) AS VARCHAR),
             CAST(max(o_orderdate) AS VARCHAR), NULL, NULL FROM orders
            UNION ALL
            SELECT 'o_orderpriority', count(*), count(o_orderpriority),
             count(*) - count(o_orderpriority), count(DISTINCT o_orderpriority),
             min(o_orderpriority), max(o_orderpriority), NULL, NULL FROM orders"""
_LINEITEM_VALUES = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM lineitem WHERE {c} IS NOT NULL"
    for c in (
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
)

_INGEST_COUNTERS = f"""{ROUTED}
            SELECT {_count("route IN ('dlq', 'filtered', 'cleaned')")} AS processed,
             {_count("route = 'filtered'")} AS filtered,
             {_count("route = 'cleaned'")} * 2 + {_count("route = 'dlq'")} AS sent,
             {_count("route = 'malformed'")} + {_count("fault IN ('list', 'null_title')")} AS errors
            FROM routed"""

_QUARANTINED = (*RECORD_COLUMNS, "ingestion_timestamp", "bytes_changed", "is_revert", "is_anonymous", "event_hour",
                "processing_lag_seconds", "has_comment", "is_large_edit", "is_bot_consistent", "is_allowlisted", "event_date")
_QUOTED = [[text.replace("'", "''") for text in (title, *aliases)] for title, aliases in DEFAULT_PAGES]
_NEEDLES = ", ".join(
    f"('{text}', '{names[0]}', {int(text != names[0])}, {place * 100 + i})"
    for place, names in enumerate(_QUOTED)
    for i, text in enumerate(names)
)


def oracle() -> dict[str, str]:
    """SQL per query; the sketch-based ones have none."""
    return {
        "bronze_projection": """
            SELECT CAST(event_id AS VARCHAR) AS event_id, props AS event_data,
             'edits' AS kafka_topic, CAST(event_id % 3 AS INT) AS kafka_partition,
             CAST(floor(event_id / 3) AS BIGINT) AS kafka_offset,
             date_trunc('second', ts) AS ingestion_timestamp, CAST(ts AS DATE) AS event_date
            FROM events""",
        "backfill_bronze": f"""{BASE}
            SELECT CAST(wikimedia_id AS VARCHAR) AS event_id, 'backfill' AS kafka_topic,
             CAST(0 AS INT) AS kafka_partition, CAST(0 AS BIGINT) AS kafka_offset,
             CAST(make_timestamp(event_timestamp * 1000000) AS DATE) AS event_date
            FROM records""",
        # All rows are of January and February, when Central European time is UTC+1.
        "landing_read_back": f"""{BASE}, local AS (
             SELECT ingestion_timestamp + INTERVAL 1 HOUR AS t FROM records)
            SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month, strftime(t, '%d') AS day,
             strftime(t, '%H') AS hour, count(*) AS records, count(*) AS decodable FROM local GROUP BY 1, 2, 3, 4""",
        "sample_of_records": """SELECT CAST(25 AS BIGINT) AS taken, CAST(25 AS BIGINT) AS decodable, CAST(25 AS BIGINT) AS known""",
        "alias_matches": f"""
            WITH needles AS (SELECT raw, page, kind, position, row_number() OVER (ORDER BY raw) - 1 AS at
             FROM (VALUES {_NEEDLES}) n(raw, page, kind, position)),
            titles AS (SELECT event_id AS rid, upper(replace(raw, ' ', '_')) || ' ' || event_id AS title
             FROM events JOIN needles n ON n.at = event_id % (SELECT count(*) FROM needles)),
            plain AS (SELECT rid, lower(replace(title, '_', ' ')) AS t FROM titles),
            fits AS (SELECT rid, page, row_number() OVER (PARTITION BY rid ORDER BY kind, position) AS first
             FROM plain JOIN needles n ON contains(t, lower(n.raw)))
            SELECT rid, 'enwiki:' || page AS canonical_entity FROM fits WHERE first = 1""",
        "landing_partitions": f"""{BASE}, local AS (
             SELECT ingestion_timestamp + INTERVAL 1 HOUR AS t FROM records)
            SELECT strftime(t, '%Y') AS year, strftime(t, '%m') AS month,
             strftime(t, '%d') AS day, strftime(t, '%H') AS hour, count(*) AS records
            FROM local GROUP BY 1, 2, 3, 4""",
        "ingest_routes": f"""{ROUTED}
            SELECT rid, route, CASE WHEN route = 'cleaned' THEN wiki || ':' || title END AS key,
             CASE WHEN fault = 'good' THEN canonical_entity END AS canonical_entity, error
            FROM routed""",
        "ingest_counters": _INGEST_COUNTERS,
        "ingest_counters_observed": _INGEST_COUNTERS,
        "ingest_messages": f"""{ROUTED}, sent AS (
             SELECT 'raw_events' AS topic, wiki || ':' || title AS key, NULL AS page, NULL AS stamp,
              1 AS titled FROM routed WHERE route = 'cleaned'
             UNION ALL
             SELECT 'cleaned_events', wiki || ':' || title, canonical_entity,
              '2024-02-01T00:00:00.000000', 1 FROM routed WHERE route = 'cleaned'
             UNION ALL
             SELECT 'dlq_events', NULL, NULL, NULL, 0 FROM routed WHERE route = 'dlq')
            SELECT topic, key, page, stamp, count(*) AS messages,
             CAST(sum(titled) AS BIGINT) AS titled FROM sent GROUP BY 1, 2, 3, 4""",
        "topics_read_back": f"""{ROUTED}, sent AS (
             SELECT 'raw_events' AS topic, wiki || ':' || title AS key, NULL AS page, NULL AS stamp,
              1 AS titled FROM routed WHERE route = 'cleaned'
             UNION ALL
             SELECT 'cleaned_events', wiki || ':' || title, canonical_entity,
              '2024-02-01T00:00:00.000000', 1 FROM routed WHERE route = 'cleaned'
             UNION ALL
             SELECT 'dlq_events', NULL, NULL, NULL, 0 FROM routed WHERE route = 'dlq')
            SELECT topic, key, page, count(*) AS messages,
             CAST(sum(titled) AS BIGINT) AS titled FROM sent GROUP BY 1, 2, 3""",
        "dlq_records": f"""{ROUTED}
            SELECT rid, error, '2024-02-01T00:00:00.000000' AS timestamp,
             CASE WHEN fault <> 'list' THEN CAST(rid AS VARCHAR) END AS original_id
            FROM routed WHERE route = 'dlq'""",
        "unfiltered_messages": f"""{ROUTED}
            SELECT 'raw_events' AS topic,
             CAST(CASE WHEN fault = 'good' THEN wikimedia_id ELSE rid END AS VARCHAR) AS key,
             '2024-02-01T00:00:00.000000' AS stamp
            FROM routed WHERE fault IN ('good', 'no_title', 'null_title')""",
        "match_tables_shuffled": """
            WITH names AS (SELECT 'part' AS wiki, p_name AS title, p_partkey AS rid FROM part
             UNION ALL SELECT 'page', url, page_id FROM pages),
            lists AS (SELECT DISTINCT 'part' AS wiki, 0 AS kind, string_split(p_name, ' ')[-1] AS raw FROM part
             UNION ALL SELECT DISTINCT 'page', 0, regexp_extract(url, '://([^/]*)', 1) FROM pages
             UNION ALL SELECT DISTINCT 'page', 1, regexp_extract(url, '(/[a-z][a-z]/)', 1) FROM pages),
            needles AS (SELECT *, trim(replace(replace(lower(raw), '_', ' '), '  ', ' ')) AS needle FROM lists WHERE raw <> ''),
            found AS (SELECT n.wiki, title, rid, raw, row_number() OVER (PARTITION BY n.wiki, rid
                ORDER BY raw <> title, kind, -length(raw), raw) AS place
             FROM (SELECT *, trim(replace(replace(lower(title), '_', ' '), '  ', ' ')) AS name FROM names) n
             JOIN needles l ON n.wiki = l.wiki AND (contains(name, needle) OR contains(needle, name)))
            SELECT names.wiki, names.title, rid, names.wiki || ':' || raw AS canonical_entity
            FROM names LEFT JOIN (SELECT * FROM found WHERE place = 1) USING (wiki, rid)""",
        "allowlist_match": _MATCH,
        "allowlist_match_shuffled": _MATCH,
        "silver_derived": f"""{BASE}
            SELECT rid, bytes_changed, is_revert, is_anonymous, event_hour, processing_lag_seconds,
             has_comment, is_large_edit, is_bot_consistent, is_allowlisted, event_date FROM derived""",
        "silver_dedup_batch": f"{BASE} SELECT rid, meta_id, ingestion_timestamp FROM ranked WHERE copy = 1",
        "json_roundtrip": f"""{BASE}
            SELECT event_id, wikimedia_id, meta_id, event_type, namespace, title, title_url, comment,
             event_timestamp, user_name, is_bot, is_minor, wiki, server_url, notify_url,
             canonical_entity, length_old, length_new, revision_old, revision_new, kafka_topic,
             kafka_partition, kafka_offset, ingestion_timestamp, bytes_changed, is_revert,
             is_anonymous, event_hour, processing_lag_seconds, has_comment, is_large_edit,
             is_bot_consistent, is_allowlisted, event_date FROM derived""",
        "json_roundtrip_shredded": f"""{BASE}
            SELECT event_id, wikimedia_id, meta_id, event_type, namespace, title, title_url, comment,
             event_timestamp, user_name, is_bot, is_minor, wiki, server_url, notify_url,
             canonical_entity, length_old, length_new, revision_old, revision_new, kafka_topic,
             kafka_partition, kafka_offset, ingestion_timestamp, bytes_changed, is_revert,
             is_anonymous, event_hour, processing_lag_seconds, has_comment, is_large_edit,
             is_bot_consistent, is_allowlisted, event_date FROM derived""",
        "json_document_comments": """
            SELECT doc_id AS wikimedia_id, source AS title, lang AS wiki, md5(text) AS comment_md5,
             CAST(length(text) AS INT) AS comment_length, CAST(n_chars AS INT) AS bytes_changed,
             n_chars > 10240 AS is_large_edit, length(text) > 0 AS has_comment FROM documents""",
        "gate_bronze_flags": f"""{BASE}
            SELECT kafka_partition, kafka_offset, event_id IS NOT NULL AS is_quality_passed FROM records""",
        "gate_silver_flags": f"""{BASE}
            SELECT rid, ok AS is_quality_passed, {REASONS} AS reasons,
             event_id IS NULL OR meta_id IS NULL AS has_schema_violations,
             event_type IN ('edit', 'new', 'log', 'categorize') AS is_valid_type,
             processing_lag_seconds BETWEEN 0 AND 3600 AS is_fresh,
             event_timestamp > 1640995200 AND event_timestamp < epoch({_NOW}) + 600
              AS is_temporal_valid
            FROM judged""",
        "gate_silver_split_counts": f"""{BASE}
            SELECT event_date, count(*) AS total_count, {_count("ok")} AS passed_count,
             {_count("NOT ok")} AS failed_count, {_count("ok")} / count(*) AS pass_rate
            FROM judged GROUP BY event_date""",
        "gate_gold_flags": f"""{BASE}, grouped AS (
             SELECT {_window(DAY)} AS window_start,
              coalesce(canonical_entity, CASE WHEN meta_id IS NOT NULL THEN title END) AS entity,
              wiki, count(*) AS total_events FROM derived GROUP BY 1, 2, 3)
            SELECT *, entity IS NOT NULL AS is_quality_passed FROM grouped""",
        "quarantine_rows": f"""{BASE}
            SELECT {REASONS} AS quarantine_reason, 'silver_0' AS quarantine_batch_id,
             '["SizeConstraint"]' AS failed_checks, rid, title, event_date
            FROM judged WHERE NOT ok""",
        "quarantine_reasons": f"""{BASE}
            SELECT {REASONS} AS quarantine_reason, count(*) AS rows
            FROM judged WHERE NOT ok GROUP BY 1""",
        "quarantine_staging": f"""{BASE}
            SELECT event_date, count(*) AS rows FROM judged
            WHERE processing_lag_seconds > 3600 GROUP BY 1""",
        "quarantine_reprocess": f"""{BASE}
            SELECT wikimedia_id, coalesce(event_id, wiki || ':' || title) AS event_id, meta_id,
             processing_lag_seconds, bytes_changed, event_date
            FROM judged
            WHERE NOT ok AND meta_id IS NOT NULL AND namespace >= 0
             AND event_type IN ('edit', 'new', 'log', 'categorize')
             AND processing_lag_seconds BETWEEN 0 AND 7200""",
        "constraint_suite_edits": _suite_sql(f"{BASE},", "derived", SILVER_CHECKS),
        "constraint_suite_bronze": _suite_sql(
            "WITH",
            "events",
            {
                **_complete("event_id"),
                "CompletenessConstraint(event_data)": "props IS NOT NULL",
                "CompletenessConstraint(kafka_topic)": "true",
                "CompletenessConstraint(event_date)": "ts IS NOT NULL",
                "CompletenessConstraint(ingestion_timestamp)": "ts IS NOT NULL",
                **_complies("kafka_partition is non-negative", "coalesce(event_id % 3, 0) >= 0"),
                **_complies("kafka_offset is non-negative", "coalesce(floor(event_id / 3), 0) >= 0"),
            },
        ),
        "constraint_suite_gold": _suite_sql(
            f"{_entity(HOUR)},", "entity", _complies("total_events is non-negative", "coalesce(total_events, 0) >= 0")
        ),
        "quarantine_counts_checks": f"""{BASE}
            SELECT {REASONS} AS quarantine_reason,
             CASE WHEN event_date < DATE '2024-01-15' THEN '["SizeConstraint"]'
              ELSE '["SizeConstraint", "CompletenessConstraint(title)"]' END AS failed_checks, count(*) AS rows
            FROM judged WHERE NOT ok GROUP BY 1, 2""",
        "backlog_levels": """
            SELECT query_name, offsets_behind, CASE WHEN offsets_behind > 100000 THEN 'CRITICAL'
             WHEN offsets_behind > 10000 THEN 'WARNING' ELSE 'OK' END AS level
            FROM (SELECT event_type AS query_name, arg_max(user_id * 1000, {'t': ts, 'i': event_id}) AS offsets_behind
                  FROM events GROUP BY 1)""",
        "lag_level": f"""{BASE}, l AS (
             SELECT CAST(epoch({_NOW}) - epoch(max(ingestion_timestamp)) AS BIGINT) AS lag_seconds FROM derived)
            SELECT 'bronze' AS layer, lag_seconds, CASE WHEN lag_seconds > 900 THEN 'CRITICAL'
             WHEN lag_seconds > 300 THEN 'WARNING' ELSE 'OK' END AS level FROM l""",
        "constraint_suite_orders": _suite_sql(
            "WITH",
            "orders",
            {
                **_complete("o_orderkey", "o_custkey"),
                **_complies("o_custkey is positive", "coalesce(o_custkey, 1) > 0"),
                **_complies("o_orderstatus contained in F,O", "coalesce(o_orderstatus, 'F') IN ('F', 'O')"),
                **_complies("price above zero", "o_totalprice > 0"),
            },
        ),
        "constraint_suite_lineitem": _suite_sql(
            "WITH",
            "lineitem",
            {
                **_complete("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate"),
                **_complies("l_quantity is positive", "coalesce(l_quantity, 1) > 0"),
                **_complies("l_discount is non-negative", "coalesce(l_discount, 0) >= 0"),
                **_complies("l_returnflag contained in A,N,R", "coalesce(l_returnflag, 'A') IN ('A', 'N', 'R')"),
                **_complies("small discounts", f"l_discount <= {_double(0.05)}"),
            },
        ),
        "suite_verdict_merged": _suite_sql(f"{BASE},", "derived", SILVER_CHECKS),
        "severity_merged_daily": f"""{_daily()}
            SELECT event_date, total_count, passed_count, pass_rate, failed_constraints,
             {_severity("critical")} AS severity FROM daily""",
        "quality_metrics_recorded": f"{_batches()} SELECT * EXCLUDE (severity) FROM graded",
        "alerts_recorded": f"""{_batches()}
            SELECT batch_id, layer, severity, CASE severity WHEN 'CRITICAL' THEN 'sns,slack' ELSE 'slack' END AS channels,
             'Silver Quality Gate (' || batch_id || ')' AS title,
             '*Pass Rate:* ' || printf('%.1f', pass_rate * 100) || '%' || chr(10) || '*Passed:* ' || passed_count
              || chr(10) || '*Failed:* ' || failed_count AS message
            FROM graded WHERE severity <> 'SUCCESS'""",
        "quarantine_staged_repair": f"""{BASE}
            SELECT event_date, count(*) AS repaired, CAST(0 AS INT) AS left_staged, CAST(0 AS INT) AS second_run_added
            FROM judged WHERE {REASONS} = 'freshness:processing_lag_seconds'
             AND processing_lag_seconds <= 7200 GROUP BY event_date""",
        "batches_stored": f"""{BASE}, placed AS (
             SELECT ok, CASE wikimedia_id % 3 WHEN 2 THEN 'ungated' ELSE 'part_' || (wikimedia_id % 3) END AS batch FROM judged)
            SELECT 'silver_events' AS table_name, batch, count(*) AS rows FROM placed WHERE ok OR batch = 'ungated' GROUP BY 2
            UNION ALL SELECT 'silver_quarantine', batch, count(*) FROM placed
             WHERE NOT ok AND batch <> 'ungated' GROUP BY 2
            UNION ALL SELECT 'commits', unnest(['part_0', 'part_1', 'ungated']), 1""",
        "quarantined_columns": f"""{BASE}, failed AS (SELECT * FROM judged WHERE NOT ok)
            SELECT member, rows FROM ({" UNION ALL ".join(
                f"SELECT '{c}' AS member, count({c}) AS rows FROM failed" for c in _QUARANTINED)}) WHERE rows > 0""",
        "severity_history": f"""{_daily()}
            SELECT event_date, total_count, passed_count, pass_rate, failed_constraints,
             CASE WHEN pass_rate < {_double(0.8)} THEN 'CRITICAL'
              WHEN pass_rate < {_double(0.95)} AND critical THEN 'CRITICAL'
              WHEN pass_rate < {_double(0.95)} OR critical THEN 'WARNING' ELSE 'SUCCESS' END AS severity
            FROM daily""",
        "threshold_watch": f"""{_daily()}
            SELECT 'pass_rate' AS watch, CAST(event_date AS VARCHAR) AS subject,
             CASE WHEN pass_rate < {_double(0.8)} THEN 'CRITICAL'
              WHEN pass_rate < {_double(0.95)} THEN 'WARNING' ELSE 'OK' END AS level FROM daily
            UNION ALL
            SELECT 'lag', 'bronze', CASE WHEN epoch({_NOW}) - max(arrival) > 900 THEN 'CRITICAL'
             WHEN epoch({_NOW}) - max(arrival) > 300 THEN 'WARNING' ELSE 'OK' END FROM records""",
        "entity_metrics": f"{_entity(DAY)} SELECT * FROM entity",
        "entity_sketch_bounds": f"""{_entity(DAY)}
            SELECT window_start, entity, wiki, true AS unique_editors_near,
             true AS unique_anonymous_editors_near FROM entity""",
        "user_sketch_bounds": f"""{_user(DAY)}
            SELECT window_start, user_name, is_bot, is_anonymous, true AS entities_edited_near,
             true AS wikis_touched_near FROM users""",
        "global_sketch_bounds": f"""{_global(12 * HOUR)}
            SELECT window_start, true AS unique_users_near, true AS unique_entities_near,
             true AS unique_wikis_near FROM site""",
        "quantile_bounds_lineitem": """
            SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity',
             'l_extendedprice', 'l_discount', 'l_tax']) AS column_name, 'true,true,true,true,true' AS near""",
        "entity_history": f"{_history(_entity(HOUR), *_PAGE_HISTORY)} SELECT * FROM entity",
        "user_history": f"""{_history(_user(HOUR), *_USER_HISTORY).replace(
                f"baseline_entities_avg) / {_double(1.0)}", "baseline_entities_avg) / baseline_entities_stddev")}
            SELECT * EXCLUDE (baseline_entities_stddev) FROM users""",
        "global_history": f"{_history(_global(HOUR), *_SITE_HISTORY)} SELECT * FROM site",
        "entity_metrics_10min": f"{_entity(TEN_MINUTES)} SELECT * FROM entity",
        # Sketches of few values hold all of them, so these counts are exact.
        "one_pass_pages": f"{_entity(TEN_MINUTES)} SELECT * FROM entity",
        "one_pass_users": f"{_user(TEN_MINUTES)} SELECT * FROM users",
        "one_pass_site": f"{_global(TEN_MINUTES)} SELECT * FROM site",
        "page_rollup_hour": f"{_entity(HOUR)} SELECT * FROM entity",
        "page_rollup_day": f"{_entity(DAY)} SELECT * FROM entity",
        "user_rollup_day": f"{_user(DAY)} SELECT * FROM users",
        "site_rollup_bounds": f"""
            SELECT make_timestamp(CAST(floor(epoch(l_shipdate) / {365 * DAY}) AS BIGINT) * {365 * DAY} * 1000000) AS window_start,
             count(*) AS total_events, true AS users_near, true AS entities_near, true AS wikis_near
            FROM lineitem GROUP BY 1""",
        "site_rollup_half_day": f"{_global(12 * HOUR)} SELECT * FROM site",
        "entity_risk_score": f"""{_entity(HOUR)}
            SELECT window_start, entity, wiki, events_zscore, revert_ratio, anonymous_ratio,
             is_anomaly, risk_score, severity FROM entity""",
        "entity_explanations": f"""{_entity(6 * HOUR)}
            SELECT window_start, entity, wiki, anomaly_types, anomaly_explanation FROM entity""",
        "user_metrics": f"{_user(DAY)} SELECT * FROM users",
        "user_metrics_10min": f"{_user(TEN_MINUTES)} SELECT * FROM users",
        "user_risk_score": f"""{_user(2 * DAY)}
            SELECT window_start, user_name, is_bot, is_anonymous, user_type, edits_zscore,
             entities_zscore, anomaly_types, user_risk_score, severity, anomaly_explanation
            FROM users""",
        "global_metrics": f"{_global(12 * HOUR)} SELECT * FROM site",
        "global_metrics_10min": f"{_global(TEN_MINUTES)} SELECT * FROM site",
        "global_health": f"""{_global(DAY)}
            SELECT window_start, platform_health, events_per_user, events_per_entity, health_score,
             health_explanation FROM site""",
        "entity_risk_top100": f"""{_entity(HOUR)}
            SELECT {_SHOWN_ENTITY} FROM entity
            WHERE event_date >= {_WHOLE_DAY} AND risk_score > 0
            ORDER BY risk_score DESC, total_events DESC, window_start, entity, wiki LIMIT 100""",
        "user_anomalies_top100": f"""{_user(6 * HOUR)}
            SELECT user_name, window_start, total_events, edit_count, revert_count, entities_edited,
             wikis_touched, user_risk_score, is_new_user_blitz, is_mass_reverter, is_cross_wiki_active
            FROM users WHERE event_date >= {_WHOLE_DAY} AND user_risk_score > 0
            ORDER BY user_risk_score DESC, window_start, user_name, is_bot NULLS FIRST, is_anonymous
            LIMIT 100""",
        "global_trend": f"""{_global(HOUR)}
            SELECT window_start, total_events, total_edits, total_reverts, total_anonymous,
             unique_users, unique_entities, revert_ratio, anonymous_ratio, avg_processing_lag
            FROM site WHERE event_date >= {_WHOLE_DAY} ORDER BY window_start DESC""",
        "freshness_by_layer": f"""{BASE}
            SELECT 'bronze' AS layer, max(ingestion_timestamp) AS latest,
             CAST(epoch({_NOW}) - max(arrival) AS BIGINT) AS lag_seconds FROM records
            UNION ALL
            SELECT 'silver', max(ingestion_timestamp),
             CAST(epoch({_NOW}) - max(arrival) AS BIGINT) FROM cleaned""",
        "latest_silver_event": f"{BASE} SELECT max(ingestion_timestamp) AS latest FROM cleaned",
        "replay_from_date": f"""{_entity(DAY)}
            SELECT window_start, entity, wiki, total_events, unique_editors,
             CASE WHEN event_date < DATE '2024-01-15' THEN -1 ELSE risk_score END AS risk_score
            FROM entity""",
        "as_of_read": f"""{BASE}
            SELECT 'first' AS read, event_date, count(*) AS rows FROM cleaned
            WHERE event_date < DATE '2024-01-15' GROUP BY 2
            UNION ALL SELECT 'second', event_date, count(*) FROM cleaned GROUP BY 2
            UNION ALL SELECT 'now', event_date, count(*) FROM cleaned
            WHERE event_date < DATE '2024-01-15' GROUP BY 2""",
        "column_profile_orders": _ORDERS_PROFILE,
        "profile_merged_orders": f"SELECT * EXCLUDE (distinct_values), true AS distinct_near FROM ({_ORDERS_PROFILE})",
        "quantile_bounds_merged": """
            SELECT unnest(['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber', 'l_quantity',
             'l_extendedprice', 'l_discount', 'l_tax']) AS column_name, 'true,true,true,true,true' AS near""",
        "frequent_values_lineitem": f"""
            SELECT column_name, value, count(*) AS n FROM ({_LINEITEM_VALUES})
            GROUP BY 1, 2 HAVING count(*) >= 0.05 * (SELECT count(*) FROM lineitem)""",
        "top_values_orders": """
            WITH v AS (
             SELECT 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS value FROM orders
             UNION ALL SELECT 'o_orderkey', CAST(o_orderkey AS VARCHAR) FROM orders
             UNION ALL SELECT 'o_totalprice', CAST(o_totalprice AS VARCHAR) FROM orders
             UNION ALL SELECT 'o_orderdate', CAST(o_orderdate AS VARCHAR) FROM orders
             UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders
             UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders
            ), c AS (
             SELECT column_name, value, count(*) AS n FROM v WHERE value IS NOT NULL GROUP BY 1, 2
            ), r AS (
             SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS INT)
              AS rank FROM c)
            SELECT * FROM r WHERE rank <= 5""",
        "stream_late_rows": f"""{BASE}
            SELECT {_count(f"{_window_end(HOUR)} <= {_CLOSED}")} AS windowed, true AS some_late,
             CAST(0 AS BIGINT) AS other_reasons, true AS all_of_the_first_file FROM derived""",
        "stream_after_rollback": f"""{BASE}
            SELECT event_date, count(*) AS rows, {_count("is_bot")} AS bot_rows FROM cleaned
            WHERE event_date < DATE '2024-01-15' OR NOT coalesce(is_bot, false) GROUP BY 1""",
        "stream_entity_metrics": f"""{_entity(HOUR, "derived")}
            SELECT window_start, window_end, entity, wiki, total_events, edit_count, revert_count,
             anonymous_edit_count, total_bytes_changed, revert_ratio, anonymous_ratio,
             anomaly_types, risk_score, severity, anomaly_explanation, event_date
            FROM entity WHERE window_end <= {_CLOSED}""",
        "stream_user_metrics": f"""{_user(HOUR, "derived")}
            SELECT window_start, user_name, is_bot, is_anonymous, total_events, edit_count,
             revert_count, total_bytes_changed, large_edit_count, edits_with_comment,
             revert_ratio, edits_zscore, event_date
            FROM users WHERE window_end <= {_CLOSED}""",
        "stream_global_metrics": f"""{_global(HOUR, "derived")}
            SELECT window_start, window_end, total_events, total_edits, total_reverts,
             total_anonymous, avg_processing_lag, max_processing_lag, revert_ratio,
             platform_health, health_score, health_explanation, event_date
            FROM site WHERE window_end <= {_CLOSED}""",
        "stream_silver_dedup": f"""{BASE}
            SELECT DISTINCT meta_id FROM derived WHERE meta_id IS NOT NULL
            UNION ALL SELECT meta_id FROM derived WHERE meta_id IS NULL""",
    }
