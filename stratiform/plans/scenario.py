"""Two overlapping deliveries of the whole test table, landed as JSON and run through all layers.

A delivery is several pulls landed together.  The first ends at noon of a day, so it
holds only the approaches known by then; the second reaches back behind that day.
Together they cover every row.  Lookup answers for some entities come back broken
(not valid JSON), which leaves orphans for the recovery job.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.nested import flatten_lookups
from stratiform.operators.observed import WriteLog
from stratiform.paths import Lake
from stratiform.plans.jobs import ingest_bronze, recover_orphans, run_all, run_gold, run_silver
from stratiform.session import new_scratch_dir
from stratiform.sources.landed import read_feed, read_lookup_documents, read_table
from stratiform.sources.standins import broken_lookup_rule, feed_documents, land_text, load, lookup_documents
from stratiform.sources.window import feed_window
from stratiform.streaming.gold_increment import run_gold_increment
from stratiform.streaming.silver_stream import run_silver_new_files

# fixed values of the scenario
RUN1_UNTIL = "2024-01-17 12:00:00"
RUN2_FROM = "2024-01-14 00:00:00"
RUN2_REF = dt.date(2024, 1, 13)  # last day of the single pull


def delivered(events: DataFrame, run: int) -> DataFrame:
    """The events of delivery 1 or 2; one without a time comes with the first."""
    at = F.lit(RUN1_UNTIL if run == 1 else RUN2_FROM).cast("timestamp_ntz")
    return events.where((F.col("ts") <= at) | F.col("ts").isNull() if run == 1 else F.col("ts") >= at)


def land_delivery(spark: SparkSession, sf: str, root: str, run: int) -> str:
    return land_text(feed_documents(delivered(load(spark, sf, "events"), run)), f"{root}/landing/feed-run{run}")


def land_feed(spark: SparkSession, sf: str, root: str, ref, as_of=None, tag: str = "feed") -> str:
    events = feed_window(load(spark, sf, "events"), "ts", ref, as_of=as_of)
    return land_text(feed_documents(events), f"{root}/landing/{tag}")


def land_lookups(spark: SparkSession, sf: str, root: str, broken: bool, tag: str = "lookups") -> str:
    part = load(spark, sf, "part")
    return land_text(lookup_documents(part, broken_lookup_rule() if broken else None), f"{root}/landing/{tag}")


def catalog_from(spark: SparkSession, path: str) -> DataFrame:
    """The catalog of landed answers.  They are parsed once, into a table: every run measures and joins it several times."""
    parsed, _ = read_lookup_documents(spark, path)
    catalog = flatten_lookups(parsed)
    stored = new_scratch_dir(spark, "catalog")
    catalog.write.parquet(stored)
    return read_table(spark, stored, catalog.schema)


def two_runs(spark: SparkSession, sf: str, tag: str = "two-runs", distinct_lookups: bool = False, log: WriteLog | None = None) -> Lake:
    """Lake after run 1 and run 2 (bronze, silver, gold), built afresh."""
    root = new_scratch_dir(spark, tag)
    lake = Lake(root)
    catalog = catalog_from(spark, land_lookups(spark, sf, root, broken=True))
    for run in (1, 2):
        feed = read_feed(spark, land_delivery(spark, sf, root, run))
        run_all(spark, lake, feed, catalog, distinct_lookups, log)
    return lake


def recovered_by_increment(spark: SparkSession, sf: str, days: list | None = None) -> Lake:
    """Two deliveries, then the orphan recovery, every layer reading only new files; ``days`` takes the days that each step wrote."""
    root = new_scratch_dir(spark, "increments")
    lake, checkpoint = Lake(root), f"{root}/_checkpoints"
    catalog = catalog_from(spark, land_lookups(spark, sf, root, broken=True))

    def follow() -> None:
        run_silver_new_files(spark, lake, checkpoint)
        written = run_gold_increment(spark, lake, checkpoint)
        if days is not None:
            days.append(written)

    for run in (1, 2):
        ingest_bronze(lake, read_feed(spark, land_delivery(spark, sf, root, run)), catalog)
        follow()
    recover_orphans(spark, lake, catalog_from(spark, land_lookups(spark, sf, root, broken=False, tag="lookups-retry")))
    follow()
    return lake


def recovered(spark: SparkSession, sf: str) -> Lake:
    """Two runs, then the orphan recovery with answers that now parse, then silver again."""
    lake = two_runs(spark, sf, tag="two-runs-for-recovery")
    clean = catalog_from(spark, land_lookups(spark, sf, lake.root, broken=False, tag="lookups-retry"))
    recover_orphans(spark, lake, clean)
    run_silver(spark, lake)
    run_gold(spark, lake)
    return lake
