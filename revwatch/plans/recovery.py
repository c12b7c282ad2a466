"""Backfill, replay and repair runs over stored layers."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revwatch.functions.columns import computed_once
from revwatch.operators.quality import QualityGate, bronze_gate, silver_gate
from revwatch.operators.silver import bronze_to_silver, derive, to_silver
from revwatch.schemas import BRONZE_TABLE, SILVER, SILVER_TABLE
from revwatch.session import scratch
from revwatch.sinks.layers import record_metrics, write_batch, write_quarantine
from revwatch.sinks.warehouse import Warehouse, utc_now
from revwatch.sources.layers import RECORD_KEY
from revwatch.sources.queue import from_offsets
from revwatch.streaming.pipeline import GOLD_FAMILIES


#: How long the stream remembers ids.
REMEMBERED = timedelta(hours=1)


def run_id(name: str) -> str:
    return f"{name}_{utc_now():%Y%m%dT%H%M%S%f}"


# A bulk run looks at its rows three times (statistics, good rows, bad rows), so they are
# written to the shared folder first: computed once, read column by column, safe if an
# executor is lost, and without the memory a cache would need. The copy goes with the run.


def backfill_bronze(
    warehouse: Warehouse, rows: DataFrame, gate: QualityGate | None = None
) -> dict | None:
    """Gate historic Bronze rows and append them, spread evenly over files."""
    with scratch(warehouse.spark) as keep:
        rows = keep(rows, "backfill")
        return write_batch(
            warehouse, BRONZE_TABLE, rows, run_id("backfill"), gate or bronze_gate(), keep=False
        )


def _not_stored(rows: DataFrame, warehouse: Warehouse) -> DataFrame:
    """Rows whose record Silver does not hold yet."""
    stored = warehouse.read(SILVER_TABLE).select(*(F.col(k).alias(f"_{k}") for k in RECORD_KEY)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in RECORD_KEY]
    return rows.join(stored, same, "left_anti")


def replay_silver(
    warehouse: Warehouse,
    from_date: date,
    offsets: str | dict | None = None,
    gate: QualityGate | None = None,
) -> dict:
    """Compute Silver again from stored Bronze and put it in place of the old rows.

    Bronze is read from a watermark before the date on, as an id first seen then is a
    copy afterwards. ``offsets`` limits the source to queue positions; then only rows
    that Silver does not hold are added and nothing is replaced.
    """
    before = datetime.combine(from_date, datetime.min.time()) - REMEMBERED
    bronze = warehouse.read(BRONZE_TABLE).filter(
        (F.col("event_date") >= F.lit(before.date())) & (F.col("ingestion_timestamp") >= F.lit(before))
    )
    if offsets is not None:
        bronze = bronze.filter(from_offsets(offsets))
    silver = bronze_to_silver(bronze).filter(F.col("event_date") >= F.lit(from_date))
    if offsets is not None:
        silver = _not_stored(silver, warehouse)
    gate = gate or silver_gate()
    with scratch(warehouse.spark) as keep:
        silver = keep(silver, "replay")
        if offsets is not None:
            return write_batch(warehouse, SILVER_TABLE, silver, run_id("repair"), gate, keep=False)
        batch_id = run_id("replay")
        result = gate.run(silver, batch_id, keep=False)
        warehouse.replace_from(result.passed, SILVER_TABLE, batch_id, from_date)
        write_quarantine(warehouse, result)
        record_metrics(warehouse, result)
        return result.metrics


def replay_gold(
    warehouse: Warehouse,
    from_date: date,
    families: Sequence[str] = ("entity", "user", "global"),
    until: datetime | None = None,
    **options,
) -> None:
    """Compute the metric tables again from stored Silver, from a date on.

    Windows do not cross midnight, as their length has to divide a day, so a date of
    Silver rows yields complete windows. Windows that end after ``until`` are left to the
    stream that still holds them open: by default, those after the last one it has stored.
    """
    if "window" in options:
        _divides_a_day(options["window"])
    silver = warehouse.read(SILVER_TABLE).filter(F.col("event_date") >= F.lit(from_date))
    for name, table, build in GOLD_FAMILIES:
        if name not in families:
            continue
        last = until or warehouse.read(table).agg(F.max("window_end")).first()[0]
        metrics = build(silver, **options)
        if last is not None:
            metrics = metrics.filter(F.col("window_end") <= F.lit(last))
        warehouse.replace_from(metrics, table, run_id(f"replay_{name}"), from_date)


def _divides_a_day(window: str) -> None:
    found = re.fullmatch(r"\s*(\d+)\s+(second|minute|hour|day)s?\s*", window)
    seconds = int(found[1]) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[found[2]] if found else 0
    if not seconds or 86400 % seconds:
        raise ValueError(f"windows of {window!r} cross midnight; a replay by date would cut them")


def decode_quarantine(quarantine: DataFrame) -> DataFrame:
    """The original Silver rows of quarantined ones."""
    record = F.from_json("original_record", SILVER)
    return computed_once(quarantine, {"_row": record}).select("_row.*")


def repaired(quarantine: DataFrame, fix: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Decode quarantined Silver rows, apply ``fix`` and derive the features again."""
    rows = decode_quarantine(quarantine)
    if fix is not None:
        rows = fix(rows)
    return to_silver(derive(rows))


def reprocess_quarantine(
    warehouse: Warehouse,
    selection: DataFrame,
    fix: Callable[[DataFrame], DataFrame] | None = None,
    gate: QualityGate | None = None,
) -> dict | None:
    """Repair selected quarantined rows and gate them again.

    Good rows join Silver unless it holds their record already; rows that still fail are
    quarantined again. The batch is named after the rows selected, so a second run over the
    same selection is the same batch and changes nothing.
    """
    with scratch(warehouse.spark) as keep:
        chosen = keep(selection, "selection")
        mark = chosen.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("original_record").cast("decimal(38,0)")), F.lit(0)),
        ).first()
        batch_id = f"reprocess_{mark[0]}_{int(mark[1]) % (1 << 64):016x}"
        rows = keep(_not_stored(repaired(chosen, fix), warehouse), "reprocess")
        return write_batch(warehouse, SILVER_TABLE, rows, batch_id, gate or silver_gate(), keep=False)
