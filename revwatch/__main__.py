"""Jobs for ``spark-submit`` or ``python -m revwatch``.

    bronze   ROOT SERVERS TOPIC [--offsets latest]   queue to raw table
    silver   ROOT                                    raw to cleaned table
    gold     ROOT [--families entity user global]    cleaned table to metrics, a query each
    metrics  ROOT                                    all metrics and their states in one query
    ingest   ROOT SERVERS TOPIC [--allowlist FILE]   route raw records
    land     ROOT SERVERS TOPIC PATH                 raw records as JSON per hour
    backfill ROOT PATH                               JSON files to the raw table
    replay   ROOT FROM_DATE [--layer silver|gold]    compute a layer again
    reprocess ROOT DATE [--reason PATTERN]           repair quarantined rows
    profile  PATH                                    column profile of a Parquet table
    sample   PATH OUTPUT [--max-events N]            a few decodable records
    dashboard ROOT {risk,users,trend,freshness}      serving queries
"""

from __future__ import annotations

import argparse
import logging
from datetime import date

from pyspark.sql import functions as F

from revwatch.operators.profile import column_profile, top_values
from revwatch.plans import recovery, serving
from revwatch.schemas import (
    BRONZE_TABLE,
    GOLD_ENTITY_TABLE,
    GOLD_GLOBAL_TABLE,
    GOLD_USER_TABLE,
    SILVER_TABLE,
)
from revwatch.session import get_spark
from revwatch.sinks.landing import land_stream
from revwatch.sinks.warehouse import Warehouse
from revwatch.sources.allowlist import default_allowlist, load_allowlist
from revwatch.sources.files import read_backfill, sample_records, save_sample
from revwatch.sources.queue import read_queue
from revwatch.streaming.pipeline import (
    await_all,
    start_bronze,
    start_gold,
    start_ingest,
    start_metrics,
    start_silver,
)
from revwatch.streaming.progress import ProgressLog


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="revwatch", description="Edit-stream analytics jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    for name in ("bronze", "ingest"):
        sub = job(name, "root", "servers", "topic")
        sub.add_argument("--offsets", default="latest")
        sub.add_argument("--once", action="store_true")
        if name == "ingest":
            sub.add_argument("--allowlist")
    land = job("land", "root", "servers", "topic", "path")
    land.add_argument("--offsets", default="latest")
    land.add_argument("--once", action="store_true")
    job("silver", "root").add_argument("--once", action="store_true")
    gold = job("gold", "root")
    gold.add_argument("--once", action="store_true")
    gold.add_argument("--families", nargs="+", default=["entity", "user", "global"])
    job("metrics", "root").add_argument("--once", action="store_true")
    job("backfill", "root", "path")
    replay = job("replay", "root", "from_date")
    replay.add_argument("--layer", choices=("silver", "gold"), default="silver")
    replay.add_argument("--offsets")
    job("reprocess", "root", "date").add_argument("--reason", default="%")
    job("profile", "path").add_argument("--output")
    job("sample", "path", "output").add_argument("--max-events", type=int, default=10)
    dashboard = job("dashboard", "root")
    dashboard.add_argument("view", choices=("risk", "users", "trend", "freshness"))
    dashboard.add_argument("--output")
    return parser


def _deliver(df, output: str | None) -> None:
    """All rows as JSON: to a folder, or a line each on the console."""
    if output:
        df.write.mode("errorifexists").json(output)
        return
    for row in df.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(row[0])


def _dashboard(warehouse: Warehouse, view: str):
    if view == "risk":
        return serving.entity_risk_summary(warehouse.read(GOLD_ENTITY_TABLE))
    if view == "users":
        return serving.user_anomalies(warehouse.read(GOLD_USER_TABLE))
    if view == "trend":
        return serving.global_trend(warehouse.read(GOLD_GLOBAL_TABLE))
    layers = {"bronze": warehouse.read(BRONZE_TABLE), "silver": warehouse.read(SILVER_TABLE)}
    return serving.freshness(layers)


def _stream(spark, warehouse: Warehouse, options) -> None:
    checkpoint = f"{warehouse.root}/checkpoints/{options.job}"
    log = ProgressLog(spark, warehouse.path("progress"))
    spark.streams.addListener(log)
    if options.job == "silver":
        queries = [start_silver(warehouse, checkpoint, once=options.once)]
    elif options.job == "gold":
        queries = start_gold(warehouse, checkpoint, once=options.once, families=options.families)
    elif options.job == "metrics":
        queries = [start_metrics(warehouse, checkpoint, once=options.once)]
    else:
        records = read_queue(spark, options.servers, options.topic, options.offsets)
        if options.job == "bronze":
            query = start_bronze(records, warehouse, checkpoint, once=options.once)
        elif options.job == "land":
            query = land_stream(records, options.path, checkpoint, once=options.once)
        else:
            listed = load_allowlist(options.allowlist) if options.allowlist else default_allowlist()
            texts = records.withColumn("value", F.col("value").cast("string"))
            query = start_ingest(texts, listed, warehouse, checkpoint, once=options.once)
        queries = [query]
    try:
        await_all(spark, queries, once=options.once)
    finally:
        log.flush()


def main(arguments: list[str] | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(levelname)s %(message)s")
    options = _parser().parse_args(arguments)
    spark = get_spark(f"revwatch-{options.job}")
    if options.job == "profile":
        table = spark.read.parquet(options.path)
        _deliver(column_profile(table), options.output and f"{options.output}/columns")
        _deliver(top_values(table).orderBy("column_name", "rank"), options.output and f"{options.output}/values")
        return
    if options.job == "sample":
        save_sample(sample_records(spark, options.path, options.max_events), options.output)
        return
    warehouse = Warehouse(spark, options.root)
    warehouse.create_tables()
    if options.job == "backfill":
        recovery.backfill_bronze(warehouse, read_backfill(spark, options.path))
    elif options.job == "replay":
        since = date.fromisoformat(options.from_date)
        if options.layer == "silver":
            recovery.replay_silver(warehouse, since, options.offsets)
        else:
            recovery.replay_gold(warehouse, since)
    elif options.job == "reprocess":
        day = F.lit(date.fromisoformat(options.date))
        quarantine = warehouse.read("silver_quarantine")
        recovery.reprocess_quarantine(
            warehouse, serving.quarantine_selection(quarantine, day, options.reason)
        )
    elif options.job == "dashboard":
        _deliver(_dashboard(warehouse, options.view), options.output)
    else:
        _stream(spark, warehouse, options)


if __name__ == "__main__":
    main()
