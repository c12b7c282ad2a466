"""Quality gates: a constraint suite per batch and pass rules per row.

The suite answers "is this batch sound?", the rules "may this row go on?".
Both are lists of named predicates, so one aggregation over the batch yields
every constraint result, every rule count and the pass rate.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.storagelevel import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revwatch.functions.scoring import first_match

SUCCESS, FAILURE = "Success", "Failure"

# Event types we accept, freshness limit, first valid second
# (2022-01-01), tolerated clock skew.
EVENT_TYPES = ("edit", "new", "log", "categorize")
MAX_LAG_SECONDS = 3600
FIRST_VALID_SECOND = 1640995200
FUTURE_TOLERANCE_SECONDS = 600

# A constraint whose name contains one of these is critical; pass
# rates below these bounds are critical or a warning; who is told.
CRITICAL_WORDS = ("Complete", "Unique", "NotNull", "Size")
CRITICAL_RATE, WARNING_RATE = 0.8, 0.95
CHANNELS = {"CRITICAL": ["sns", "slack"], "WARNING": ["slack"]}

PASS_FLAG = "is_quality_passed"
REASONS = "_failed_rules"
HELPER_FLAGS = (
    "has_schema_violations",
    "is_valid_type",
    "is_fresh",
    "is_temporal_valid",
    "quality_check_timestamp",
)


# Constraints over a whole batch. ------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    """``holds`` judges the number of rows that meet ``counted`` and the batch size, as columns or numbers.

    An empty batch gives nothing to measure: only a size constraint can hold on it.
    """

    name: str
    counted: Column
    holds: Callable[[Column, Column], Column] = field(
        default=lambda good, rows: (rows > 0) & (good == rows)
    )


def has_size(at_least: int = 1) -> Constraint:
    return Constraint(
        f"SizeConstraint(rows >= {at_least})", F.lit(True), lambda good, rows: rows >= at_least
    )


def is_complete(column: str) -> Constraint:
    return Constraint(f"CompletenessConstraint({column})", F.col(column).isNotNull())


def is_non_negative(column: str) -> Constraint:
    return _compliance(f"{column} is non-negative", F.coalesce(F.col(column) >= 0, F.lit(True)))


def is_positive(column: str) -> Constraint:
    return _compliance(f"{column} is positive", F.coalesce(F.col(column) > 0, F.lit(True)))


def is_contained_in(column: str, values: Sequence) -> Constraint:
    listed = ",".join(map(str, values))
    allowed = F.col(column).isNull() | F.col(column).isin(list(values))
    return _compliance(f"{column} contained in {listed}", allowed)


def satisfies(predicate: str, label: str) -> Constraint:
    """Every row must make the SQL ``predicate`` true; an unknown outcome fails."""
    return _compliance(label, F.expr(predicate))


def _compliance(label: str, condition: Column) -> Constraint:
    return Constraint(f"ComplianceConstraint({label})", F.coalesce(condition, F.lit(False)))


def _suite_columns(constraints: Sequence[Constraint]) -> list[Column]:
    return [F.count("*").alias("_rows")] + [
        F.count_if(c.counted).alias(f"_good_{i}") for i, c in enumerate(constraints)
    ]


def run_suite(df: DataFrame, constraints: Sequence[Constraint], keys: Sequence[str] = ()) -> DataFrame:
    """One row per constraint (and key): ``constraint``, ``constraint_status``, counts.

    All constraints are evaluated in a single aggregation. With ``keys`` the suite
    is run for each group, for instance for each date or batch of a history.
    """
    measured = df.groupBy(*keys).agg(*_suite_columns(constraints))
    results = []
    for i, constraint in enumerate(constraints):
        good = F.col(f"_good_{i}")
        holds = constraint.holds(good, F.col("_rows"))
        results.append(
            F.struct(
                F.lit(constraint.name).alias("constraint"),
                F.when(holds, SUCCESS).otherwise(FAILURE).alias("constraint_status"),
                F.col("_rows").alias("rows"),
                good.alias("rows_passing"),
            )
        )
    return measured.select(*keys, F.inline(F.array(*results)))


#: The state that counts the rows the row gate lets pass.
ROW_GATE = "RowGate"


def constraint_states(
    df: DataFrame, constraints: Sequence[Constraint], keys: Sequence[str] = ()
) -> DataFrame:
    """Per constraint (and key) the rows measured and those that pass: what can be added up.

    The counts of batches, files or dates are stored and later combined by
    :func:`combined_verdict`; the rows themselves are not read again.
    """
    return run_suite(df, constraints, keys).drop("constraint_status")


def combined_verdict(
    states: DataFrame, constraints: Sequence[Constraint], keys: Sequence[str] = ()
) -> DataFrame:
    """The suite over all that ``states`` (constraint, rows, rows_passing) were counted from.

    As :func:`run_suite`, from one row per constraint and batch; states of constraints that
    are not in the list are left out.
    """
    added = (
        states.filter(F.col("constraint").isin([c.name for c in constraints]))
        .groupBy(*keys, "constraint")
        .agg(F.sum("rows").alias("rows"), F.sum("rows_passing").alias("rows_passing"))
    )
    good, rows = F.col("rows_passing"), F.col("rows")
    holds = F.coalesce(*(F.when(F.col("constraint") == c.name, c.holds(good, rows)) for c in constraints))
    status = F.when(holds, SUCCESS).otherwise(FAILURE)
    return added.select(*keys, "constraint", status.alias("constraint_status"), "rows", "rows_passing")


def combined_quality(states: DataFrame, constraints: Sequence[Constraint], keys: Sequence[str] = ()) -> DataFrame:
    """Counts, pass rate, failed constraints and severity, per key or for the whole table.

    Needs the states of the row gate beside those of the constraints.
    """
    gate = Constraint(ROW_GATE, F.lit(True))
    is_gate = F.col("constraint") == ROW_GATE
    failed = ~is_gate & (F.col("constraint_status") == FAILURE)
    return (
        combined_verdict(states, [*constraints, gate], keys)
        .groupBy(*keys)
        .agg(
            F.max(F.when(is_gate, F.col("rows"))).alias("total_count"),
            F.max(F.when(is_gate, F.col("rows_passing"))).alias("passed_count"),
            F.sort_array(F.collect_list(F.when(failed, F.col("constraint")))).alias("failed_checks"),
        )
        .withColumn("pass_rate", F.coalesce(F.try_divide("passed_count", "total_count"), F.lit(1.0)))
        .withColumn("severity", severity_column(F.col("pass_rate"), F.col("failed_checks")))
    )


def bronze_constraints() -> list[Constraint]:
    complete = ("event_id", "event_data", "kafka_topic", "event_date", "ingestion_timestamp")
    return [
        has_size(1),
        *map(is_complete, complete),
        *map(is_non_negative, ("kafka_partition", "kafka_offset")),
    ]


def silver_constraints() -> list[Constraint]:
    complete = (
        "event_id",
        "meta_id",
        "wikimedia_id",
        "event_type",
        "title",
        "user_name",
        "wiki",
        "event_timestamp",
        "processing_lag_seconds",
    )
    return [
        has_size(1),
        *map(is_complete, complete),
        is_contained_in("event_type", EVENT_TYPES),
        is_non_negative("namespace"),
        is_positive("wikimedia_id"),
        satisfies("processing_lag_seconds >= 0", "Events should not arrive before they happen"),
        satisfies(
            f"processing_lag_seconds <= {MAX_LAG_SECONDS}",
            "Events should arrive within 1 hour (freshness)",
        ),
        satisfies(f"event_timestamp > {FIRST_VALID_SECOND}", "Events should be after 2022-01-01"),
    ]


def gold_constraints() -> list[Constraint]:
    return [has_size(1), is_non_negative("total_events")]


# Rules per row. -----------------------------------------------------------------------

Rule = tuple[str, Column]


def _present(*columns: str) -> list[Rule]:
    return [(f"missing:{name}", F.col(name).isNotNull()) for name in columns]


def bronze_rules(columns: Sequence[str]) -> list[Rule]:
    return _present("event_id", "event_data", "kafka_topic", "kafka_offset", "ingestion_timestamp")


def silver_rules(
    columns: Sequence[str], max_lag_seconds: int = MAX_LAG_SECONDS
) -> list[Rule]:
    lag, epoch = F.col("processing_lag_seconds"), F.col("event_timestamp")
    rules = [
        *_present("event_id", "meta_id", "wikimedia_id"),
        ("range:wikimedia_id", F.col("wikimedia_id") > 0),
        ("valid_type:event_type", F.col("event_type").isin(*EVENT_TYPES)),
        *_present("title", "user_name", "wiki"),
        ("range:namespace", F.col("namespace") >= 0),
        ("freshness:processing_lag_seconds", lag.between(0, max_lag_seconds)),
        ("temporal:event_timestamp", epoch > FIRST_VALID_SECOND),
    ]
    if "event_data" in columns:
        # Decodes again only the rows whose fields all came out null.
        nothing = F.coalesce("wikimedia_id", "event_timestamp", "title", "wiki", "meta_id").isNull()
        broken = nothing & F.col("event_data").isNotNull()
        readable = F.when(broken, F.try_parse_json("event_data").isNotNull()).otherwise(F.lit(True))
        rules.append(("unparseable:event_data", readable))
    return rules


def gold_rules(columns: Sequence[str]) -> list[Rule]:
    named = [name for name in ("entity", "wiki", "user_name") if name in columns]
    return [("range:total_events", F.col("total_events") >= 0), *_present(*named)]


def passes(rules: Sequence[Rule]) -> Column:
    """All rules hold. Null where one is unknown, so use it to filter: each rule is
    then a conjunct of its own that Spark can push towards the scan."""
    result = F.lit(True)
    for _, condition in rules:
        result = result & condition
    return result


def flag_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add the pass flag and the names of the rules a row fails.

    A rule whose outcome is unknown fails. The flag does not depend on the
    names, so they are only computed where somebody reads them.
    """
    unmet = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules]
    return df.withColumns(
        {
            REASONS: F.array_compact(F.array(*unmet)),
            PASS_FLAG: F.coalesce(passes(rules), F.lit(False)),
        }
    )


def silver_helper_flags(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Explanatory flags beside the pass flag; they do not decide on their own."""
    clock = F.current_timestamp() if now is None else now
    keys = ("event_id", "meta_id", "wikimedia_id", "title", "user_name", "wiki")
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    lag, epoch = F.col("processing_lag_seconds"), F.col("event_timestamp")
    limit = F.unix_timestamp(clock) + FUTURE_TOLERANCE_SECONDS

    def known(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False))

    return df.withColumns(
        {
            "has_schema_violations": missing,
            "is_valid_type": known(F.col("event_type").isin(*EVENT_TYPES)),
            "is_fresh": known(lag.between(0, MAX_LAG_SECONDS)),
            "is_temporal_valid": known((epoch > FIRST_VALID_SECOND) & (epoch < limit)),
            "quality_check_timestamp": clock,
        }
    )


# Severity and alerts. -----------------------------------------------------------------


def is_critical_check(name: str) -> bool:
    return any(word in name for word in CRITICAL_WORDS)


def severity(pass_rate: float, failed_checks: Sequence[str]) -> str:
    critical = any(map(is_critical_check, failed_checks))
    if pass_rate < CRITICAL_RATE:
        return "CRITICAL"
    if pass_rate < WARNING_RATE:
        return "CRITICAL" if critical else "WARNING"
    return "WARNING" if critical else "SUCCESS"


def severity_column(pass_rate: Column, failed_checks: Column) -> Column:
    """The same grading for a history; ``failed_checks`` is an array of names."""
    critical = F.exists(failed_checks, lambda name: name.rlike("|".join(CRITICAL_WORDS)))
    low = pass_rate < WARNING_RATE
    return first_match(
        [
            (pass_rate < CRITICAL_RATE, "CRITICAL"),
            (low & critical, "CRITICAL"),
            (low | critical, "WARNING"),
        ],
        "SUCCESS",
    )


# The gate. ----------------------------------------------------------------------------


@dataclass
class GateResult:
    """``passed`` and ``failed`` share ``flagged``, kept until :meth:`release`."""

    flagged: DataFrame
    metrics: dict

    @property
    def passed(self) -> DataFrame:
        return self.flagged.filter(F.col(PASS_FLAG)).drop(PASS_FLAG, REASONS, *HELPER_FLAGS)

    @property
    def failed(self) -> DataFrame:
        return self.flagged.filter(~F.col(PASS_FLAG))

    @property
    def severity(self) -> str:
        return severity(self.metrics["pass_rate"], self.metrics["failed_checks"])

    def release(self) -> None:
        self.flagged.unpersist()

    def alert(self) -> dict | None:
        """The alert this batch raises, if its severity is worth one."""
        if self.severity not in CHANNELS:
            return None
        m = self.metrics
        return {
            "batch_id": m["batch_id"],
            "layer": m["layer"],
            "severity": self.severity,
            "channels": CHANNELS[self.severity],
            "title": f"{m['layer'].title()} Quality Gate ({m['batch_id']})",
            "message": (
                f"*Pass Rate:* {m['pass_rate'] * 100:.1f}%\n"
                f"*Passed:* {m['passed_count']}\n*Failed:* {m['failed_count']}"
            ),
        }


@dataclass(frozen=True)
class QualityGate:
    """The gate of one layer.

    ``rules`` is called with the frame's columns, so a gate adapts to the
    metric families that share the Gold layer. ``suite`` is optional work.
    """

    layer: str
    constraints: Callable[[], list[Constraint]]
    rules: Callable[[Sequence[str]], list[Rule]]
    suite: bool = True
    helper_flags: Callable[[DataFrame], DataFrame] | None = None

    def flag(self, df: DataFrame) -> DataFrame:
        flagged = flag_rows(df, self.rules(df.columns))
        return self.helper_flags(flagged) if self.helper_flags else flagged

    def run(self, df: DataFrame, batch_id: str | None = None, keep: bool = True) -> GateResult:
        """Flag and count a batch in one job and hand back both halves.

        ``keep`` persists the flagged batch, which suits a micro-batch: its source
        is then read once for the statistics and both writes, and a lost block is
        computed again. For a bounded run over a whole table pass ``keep=False``
        with a frame that reads a written table.

        Counts come from an aggregation, not from accumulators, which would count
        twice when an executor is lost and a stage is run again.
        """
        if batch_id is None:
            batch_id = f"{self.layer}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"
        flagged = self.flag(df)
        if keep:
            flagged = flagged.persist(StorageLevel.MEMORY_AND_DISK)
        constraints = self.constraints() if self.suite else []
        # Counts per date, so that verdicts on dates can be put together from batches.
        keys = ["event_date"] if "event_date" in flagged.columns else []
        dated = flagged.groupBy(*keys).agg(
            *_suite_columns(constraints), F.count_if(F.col(PASS_FLAG)).alias("_passed")
        ).collect()
        rows, passed = (sum(r[name] for r in dated) for name in ("_rows", "_passed"))
        good = [sum(r[f"_good_{i}"] for r in dated) for i in range(len(constraints))]
        checks = {
            c.name: SUCCESS if c.holds(n, rows) else FAILURE for c, n in zip(constraints, good, strict=True)
        }
        names = [*(c.name for c in constraints), ROW_GATE]
        states = [
            (self.layer, name, r["_rows"], r[column], r["event_date"] if keys else None)
            for r in dated
            for name, column in zip(names, [*(f"_good_{i}" for i in range(len(constraints))), "_passed"], strict=True)
        ]
        metrics = {
            "batch_id": batch_id,
            "layer": self.layer,
            "checks": checks,
            "total_count": rows,
            "passed_count": passed,
            "failed_count": rows - passed,
            "pass_rate": passed / rows if rows else 1.0,
            "failed_checks": [name for name, status in checks.items() if status == FAILURE],
            "states": states,
        }
        return GateResult(flagged, metrics)


def bronze_gate(suite: bool = True) -> QualityGate:
    return QualityGate("bronze", bronze_constraints, bronze_rules, suite)


def silver_gate(suite: bool = True, max_lag_seconds: int = MAX_LAG_SECONDS) -> QualityGate:
    def rules(columns: Sequence[str]) -> list[Rule]:
        return silver_rules(columns, max_lag_seconds)

    return QualityGate("silver", silver_constraints, rules, suite, silver_helper_flags)


def gold_gate(suite: bool = False) -> QualityGate:
    return QualityGate("gold", gold_constraints, gold_rules, suite)


# Quarantine. --------------------------------------------------------------------------


def quarantine_rows(
    failed: DataFrame, batch_id: str, failed_checks: Sequence[str] = (), now: Column | None = None
) -> DataFrame:
    """Failed rows in the quarantine format: the whole row as JSON plus the reasons.

    ``quarantine_reason`` names the rules this row fails; ``failed_checks`` is
    the batch's list of failed constraints.
    """
    clock = F.current_timestamp() if now is None else now
    dropped = {REASONS, *HELPER_FLAGS}
    kept = [c for c in failed.columns if c not in dropped and not c.startswith("is_quality")]
    dated = F.to_date("ingestion_timestamp") if "ingestion_timestamp" in kept else F.col("event_date")
    return failed.select(
        clock.alias("quarantine_timestamp"),
        F.array_join(REASONS, ", ").alias("quarantine_reason"),
        F.lit(batch_id).alias("quarantine_batch_id"),
        F.lit(json.dumps(list(failed_checks))).alias("failed_checks"),
        F.to_json(F.struct(*kept)).alias("original_record"),
        # A row may be here because it has no arrival time; file it under today.
        F.coalesce(dated, F.to_date(clock)).alias("event_date"),
    )
