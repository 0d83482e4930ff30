"""Batch jobs: bronze ingest, incremental silver, gold, full reprocess, orphan recovery.

Each job is one lazy plan per table ending in one write.  Layers talk only
through stored tables, which also cuts the lineage between jobs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.operators.aggregates import daily_summary
from stratiform.operators.merge import insert_only_merge, lookup, pending_against, pending_rows
from stratiform.operators.nested import declared_matches, feed_objects, flatten_objects, objects_extent, rejected_objects
from stratiform.operators.observed import WriteLog, observed
from stratiform.operators.quality import integrity_report, orphans_by_key
from stratiform.operators.tables import append_table, write_table
from stratiform.operators.transforms import transform_approaches, transform_metadata
from stratiform.paths import Lake
from stratiform.sources.landed import path_exists, read_table
from stratiform.streaming.gold_increment import run_gold_increment
from stratiform.streaming.silver_stream import run_silver_new_files, silver_integrity


def _append_or_create(df: DataFrame, path: str, partition_by=None, observation: Observation | None = None) -> bool:
    """Add rows to a table that may not exist yet; False when there were none to add."""
    if not path_exists(df.sparkSession, path):
        write_table(df, path, mode="overwrite", partition_by=partition_by, observation=observation)
        return True
    if partition_by:  # an append of no rows adds no file to a partitioned table
        append_table(df, path, partition_by=partition_by, observation=observation)
        return True
    # it would add an empty file to another one: ask first, on rows that the append then takes over
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        some = not df.isEmpty()
        if some:
            append_table(df, path, observation=observation)
        return some
    finally:
        df.unpersist()


def _watch(log: WriteLog | None) -> Observation | None:
    return None if log is None else Observation()


def ingest_bronze(lake: Lake, feed: DataFrame, catalog: DataFrame, distinct_lookups: bool = False, log: WriteLog | None = None):
    """Feed documents -> bronze approaches; their ids -> catalog lookups -> bronze metadata.

    Approaches merge on (id, day) and metadata on id, insert-only.  By default
    every approach row asks for its entity, as a per-request lookup does.
    Objects without a close approach are merged into the rejects table, once each.
    Returns the (first, last) day of the pull, or None for an empty pull.  ``log`` takes the counts of the writes.
    """
    # The parsed batch feeds several jobs (partition range, approach merge, lookups,
    # rejects): parse the documents once.  Lost blocks are rebuilt from the landed files.
    seen = _watch(log)
    documents = feed if log is None else observed(feed.select("element_count", "near_earth_objects"), seen, {"element_count": ~declared_matches()}, columns=())
    objects = feed_objects(documents).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        approaches = flatten_objects(objects)
        rejects = rejected_objects(objects)
        lo, hi, rows, held = objects_extent(objects)
        _note(log, "landed", "feed", seen)
        metadata = lookup(approaches.select("id"), catalog, distinct=distinct_lookups, rows=rows)
        seen = _watch(log)
        insert_only_merge(approaches, lake.bronze_approaches, keys=schemas.BRONZE_APPROACHES_KEY,
                          partition_by=schemas.APPROACHES_PARTITION, prune_on="fecha", prune_bounds=(lo, hi),
                          schema=schemas.BRONZE_APPROACHES, batch_rows=rows, observation=seen)
        _note(log, "bronze", "approaches", seen)
        seen = _watch(log)
        insert_only_merge(metadata, lake.bronze_metadata, keys=schemas.METADATA_KEY, schema=schemas.BRONZE_METADATA,
                          measure_target=True, batch_rows=rows, observation=seen)
        _note(log, "bronze", "metadata", seen)
        if held > rows:  # keeps empty appends out
            insert_only_merge(rejects, lake.bronze_rejects, keys=rejects.columns, null_safe=True, batch_rows=held - rows)
    finally:
        objects.unpersist()
    return None if lo is None else (lo, hi)


def _note(log: WriteLog | None, layer: str, table: str, seen: Observation | None, replaces: bool = False) -> None:
    if log is not None:
        log.take(layer, table, seen, replaces)


def run_silver(spark: SparkSession, lake: Lake, log: WriteLog | None = None) -> DataFrame:
    """Transform only the bronze rows silver does not hold yet, append them, then
    return the integrity report of the complete silver tables (lazy).

    All of bronze is compared with all of silver (key columns only): bronze's day comes
    from another field than silver's, so no range of days bounds what may match, and rows
    that an earlier run left behind are found whenever they are.
    """
    ba = read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES)
    bm = read_table(spark, lake.bronze_metadata, schemas.BRONZE_METADATA)
    # Pending uses the null-safe key; anything it lets through cannot match with
    # plain equality either, so the append needs no second anti join.
    pa = pending_against(spark, ba.transform(transform_approaches), lake.silver_approaches,
                         schemas.SILVER_APPROACHES_KEY, schemas.SILVER_APPROACHES, null_safe=True)
    pm = pending_against(spark, bm.transform(transform_metadata), lake.silver_metadata,
                         schemas.METADATA_KEY, schemas.SILVER_METADATA, null_safe=True, measure_target=True)
    for frame, path, table, parts in ((pa, lake.silver_approaches, "approaches", schemas.APPROACHES_PARTITION),
                                      (pm, lake.silver_metadata, "metadata", None)):
        seen = _watch(log)
        if _append_or_create(frame, path, parts, seen):
            _note(log, "silver", table, seen)
    return integrity_report(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
                            read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA))


def run_gold(spark: SparkSession, lake: Lake, log: WriteLog | None = None) -> None:
    """Recompute the daily summary from the whole silver layer; overwrite gold."""
    summary = daily_summary(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
                            read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA))
    seen = _watch(log)
    write_table(summary, lake.gold_daily_summary, mode="overwrite", replace_schema=True, observation=seen)
    _note(log, "gold", "daily_summary", seen, replaces=True)


def reprocess_silver(spark: SparkSession, source: Lake, target: Lake | None = None) -> DataFrame:
    """Rebuild silver from all of bronze (no pending filter), replacing schema and rows.

    Returns the integrity report of the rebuilt tables.  It is read back from
    them (two columns) rather than computed on the frames before the write, which
    would run the whole-history transform a second time; the rows are the same.
    """
    target = target or source
    sa = read_table(spark, source.bronze_approaches, schemas.BRONZE_APPROACHES).transform(transform_approaches)
    sm = read_table(spark, source.bronze_metadata, schemas.BRONZE_METADATA).transform(transform_metadata)
    write_table(sa, target.silver_approaches, mode="overwrite",
                partition_by=schemas.APPROACHES_PARTITION, replace_schema=True)
    write_table(sm, target.silver_metadata, mode="overwrite", replace_schema=True)
    return integrity_report(read_table(spark, target.silver_approaches, schemas.SILVER_APPROACHES),
                            read_table(spark, target.silver_metadata, schemas.SILVER_METADATA))


def recover_orphans(spark: SparkSession, lake: Lake, catalog: DataFrame, ids: DataFrame | None = None) -> None:
    """Look up the entities silver approaches point at but silver metadata lacks
    (or the given ``ids``) and merge them into bronze metadata by id."""
    if ids is None:
        sa = read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)
        sm = read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA)
        # one row per id before the anti join (a hot id collapses map-side)
        ids = orphans_by_key(sa.select("id").distinct(), sm, ["id"])
    wanted = ids.select(F.col("id").cast("string").alias("id"))
    found = lookup(wanted, catalog, distinct=True)
    insert_only_merge(found, lake.bronze_metadata, keys=schemas.METADATA_KEY, schema=schemas.BRONZE_METADATA,
                      measure_target=True)


@dataclass
class RunResult:
    lake: Lake
    integrity: DataFrame


def run_all(spark: SparkSession, lake: Lake, feed: DataFrame, catalog: DataFrame,
            distinct_lookups: bool = False, log: WriteLog | None = None) -> RunResult:
    """bronze -> silver -> gold for one pull; silver also takes up what earlier runs left.  ``log`` takes the counts of all writes."""
    ingest_bronze(lake, feed, catalog, distinct_lookups, log)
    report = run_silver(spark, lake, log)
    run_gold(spark, lake, log)
    return RunResult(lake, report)


def run_all_new(spark: SparkSession, lake: Lake, feed: DataFrame, catalog: DataFrame, checkpoint: str,
                distinct_lookups: bool = False) -> RunResult:
    """bronze -> silver -> gold for one pull, reading only new files of each layer and writing only the days they touch.

    The summary is the table of days (``Lake.gold_by_day``); its rows are those of a full run.
    """
    ingest_bronze(lake, feed, catalog, distinct_lookups)
    run_silver_new_files(spark, lake, checkpoint)
    run_gold_increment(spark, lake, checkpoint)
    return RunResult(lake, silver_integrity(spark, lake))
