"""Registered queries over the shared test tables (stand-in mapping in FIXTURES.md).

Each takes ``(spark, sf_dir)`` and returns a DataFrame over whole tables.
Queries that exercise writes stage their tables under the shared scratch
folder (``spark.checkpoint.dir``) and return a lazy read of the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.functions.expr import (
    FEED_DAY_FORMAT, FEED_TIME_FORMAT, bool_or_false, day_of, hour_of, parse_timestamp,
    round_half_even, to_double, to_id,
)
from stratiform.operators.aggregates import (
    daily_summary, distinct_keys, fanout_left_join, layer_counts, summarize,
)
from stratiform.operators.bucketed import merge_bucketed
from stratiform.operators.clustered import lookup_keys, write_clustered
from stratiform.operators.fingerprints import layer_diff
from stratiform.operators.merge import insert_only_merge, lookup, pending_against
from stratiform.operators.inspect import peek
from stratiform.operators.joins import keys_bound, sized_join
from stratiform.operators.nested import feed_element_check, feed_rejects, flatten_feed, flatten_lookups
from stratiform.operators.observed import WriteLog
from stratiform.operators.quality import (
    duplicate_keys, integrity_report, name_lossless, null_profile, orphans_by_key, orphans_by_null,
)
from stratiform.operators.tables import Move, migrate_layout, write_table
from stratiform.operators.transforms import transform_approaches, transform_metadata
from stratiform.paths import Lake
from stratiform.plans import scenario
from stratiform.plans.jobs import ingest_bronze, reprocess_silver, run_silver
from stratiform.session import new_scratch_dir
from stratiform.sources.landed import literal_ids, quarantined_ids, read_feed, read_lookup_documents, read_table
from stratiform.sources.standins import (
    approaches_from_events, broken_lookup_rule, feed_documents, land_text, load, lookup_documents,
    metadata_from_part,
)
from stratiform.sources.window import feed_window, in_day_window
from stratiform.streaming.dedup_stream import ingest_unrepeated
from stratiform.streaming.feed_stream import ingest_available
from stratiform.streaming.silver_stream import run_silver_new_files


# --- stand-in layers (lazy, whole tables) -----------------------------------

def bronze_approaches(spark: SparkSession, sf: str) -> DataFrame:
    return approaches_from_events(load(spark, sf, "events"))


def bronze_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return metadata_from_part(load(spark, sf, "part"))


def silver_approaches(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_approaches(spark, sf).transform(transform_approaches)


def silver_metadata(spark: SparkSession, sf: str) -> DataFrame:
    return bronze_metadata(spark, sf).transform(transform_metadata)


def _run_events(spark, sf, run: int) -> DataFrame:
    """One of two overlapping deliveries that together hold all events."""
    return scenario.delivered(load(spark, sf, "events"), run)


def _run_bronze(spark, sf, run: int) -> DataFrame:
    return approaches_from_events(_run_events(spark, sf, run))


def _fanout_metadata(spark, sf) -> DataFrame:
    """Metadata as per-request lookups: an entity comes back once per approach."""
    return lookup(bronze_approaches(spark, sf).select("id"), bronze_metadata(spark, sf)).transform(transform_metadata)


def _documents_labels(spark, sf):
    return load(spark, sf, "documents"), load(spark, sf, "labels")


# --- gold -------------------------------------------------------------------

def q_daily_summary(spark, sf):
    return daily_summary(silver_approaches(spark, sf), silver_metadata(spark, sf))


def q_daily_summary_fanout(spark, sf):
    return daily_summary(silver_approaches(spark, sf), _fanout_metadata(spark, sf))


def q_join_left_fanout(spark, sf):
    a = silver_approaches(spark, sf).select("id", "close_approach_date_full", "fecha",
                                           "relative_velocity_km_per_second")
    return fanout_left_join(a, _fanout_metadata(spark, sf))


def _joined(spark, sf):
    m = silver_metadata(spark, sf).select(
        "id", "diameter_max_km", F.col("bajo_seguimiento_riesgo").cast("double").alias("bajo_seguimiento_riesgo"))
    return sized_join(silver_approaches(spark, sf), m, "id", "left")


def q_agg_count(spark, sf):
    return summarize(_joined(spark, sf), "fecha", [("cantidad_aproximaciones", "id", "count")])


def q_agg_mean(spark, sf):
    return summarize(_joined(spark, sf), "fecha", [
        ("velocidad_promedio_km_s", "relative_velocity_km_per_second", "mean"),
        ("distancia_promedio_km", "miss_distance_km", "mean"),
    ], round_cols=("velocidad_promedio_km_s", "distancia_promedio_km"))


def q_agg_min_max(spark, sf):
    return summarize(_joined(spark, sf), "fecha", [
        ("velocidad_maxima_km_s", "relative_velocity_km_per_second", "max"),
        ("distancia_minima_km", "miss_distance_km", "min"),
        ("diametro_maximo_km", "diameter_max_km", "max"),
    ])


def q_agg_flag_sum(spark, sf):
    """Per entity; an entity that the catalog lacks has only NULL flags -> 0.0."""
    catalog = metadata_from_part(load(spark, sf, "part"))
    m = catalog.transform(transform_metadata).select(
        "id", F.col("bajo_seguimiento_riesgo").cast("double").alias("bajo_seguimiento_riesgo"))
    joined = sized_join(silver_approaches(spark, sf), m, "id", "left")
    return summarize(joined, "id", [("cantidad_bajo_seguimiento_riesgo", "bajo_seguimiento_riesgo", "sum")])


def q_agg_typed(spark, sf):
    """Extremes of times, texts and whole numbers, and a count that skips NaN."""
    ev = load(spark, sf, "events").withColumn(
        "reading", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))
    return summarize(ev, "user_id", [
        ("first_ts", "ts", "min"), ("last_ts", "ts", "max"), ("first_type", "event_type", "min"),
        ("last_event_id", "event_id", "max"), ("readings", "reading", "count"),
    ])


def q_agg_null_key(spark, sf):
    docs, labels = _documents_labels(spark, sf)
    joined = sized_join(docs.select("doc_id"), labels.select("doc_id", "quality"), "doc_id", "left")
    return summarize(joined, "quality", [("documents", "doc_id", "count")])


def q_distinct_keys(spark, sf):
    return distinct_keys(silver_approaches(spark, sf), ["id", "fecha"])


# --- silver transforms and scalar functions --------------------------------

def q_silver_approaches(spark, sf):
    return silver_approaches(spark, sf)


def q_silver_metadata(spark, sf):
    return silver_metadata(spark, sf)


def q_cast_timestamp(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select(
        "event_id",
        parse_timestamp(F.date_format("ts", FEED_DAY_FORMAT), FEED_DAY_FORMAT).alias("close_approach_date"),
        parse_timestamp(F.date_format("ts", FEED_TIME_FORMAT), FEED_TIME_FORMAT).alias("close_approach_date_full"),
    )


def q_cast_id(spark, sf):
    return bronze_approaches(spark, sf).select(F.col("id").alias("id_text"), to_id("id").alias("id"))


def q_cast_double(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id",
                     to_double(F.get_json_object("props", "$.k")).alias("k"),
                     to_double(F.col("value").cast("string")).alias("relative_velocity_km_per_second"))


def q_cast_bool(spark, sf):
    docs, labels = _documents_labels(spark, sf)
    j = sized_join(docs.select("doc_id"), labels.select("doc_id", "toxic"), "doc_id", "left")
    return j.select("doc_id", bool_or_false(F.col("toxic") == 1).alias("is_toxic"))


def q_date_hour_split(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", day_of("ts").alias("fecha"), hour_of("ts").alias("hora"))


def q_name_number(spark, sf):
    return silver_metadata(spark, sf).select("id", "numero_oficial")


def q_name_provisional(spark, sf):
    return silver_metadata(spark, sf).select("id", "designacion_provisional")


def q_name_has_number(spark, sf):
    return silver_metadata(spark, sf).select("id", "tiene_designacion_oficial")


def q_diff_range(spark, sf):
    return silver_metadata(spark, sf).select("id", "incertidumbre_diametro_km")


def q_flag_or(spark, sf):
    return silver_metadata(spark, sf).select("id", "bajo_seguimiento_riesgo")


def q_round_half_even(spark, sf):
    ev = load(spark, sf, "events")
    return ev.select("event_id", round_half_even(F.col("value") / F.lit(8.0)).alias("value_eighth"))


# --- quality ------------------------------------------------------------------

def q_orphans_by_null(spark, sf):
    docs, labels = _documents_labels(spark, sf)
    return orphans_by_null(docs, labels, "doc_id", "quality")


def q_orphans_by_key(spark, sf):
    docs, labels = _documents_labels(spark, sf)
    return orphans_by_key(docs.select("doc_id"), labels, ["doc_id"])


def q_dup_keys(spark, sf):
    return duplicate_keys(bronze_approaches(spark, sf), schemas.BRONZE_APPROACHES_KEY)


def q_null_profile(spark, sf):
    return null_profile(silver_metadata(spark, sf))


def q_name_lossless(spark, sf):
    return name_lossless(bronze_metadata(spark, sf))


def q_peek_top5(spark, sf):
    return peek(bronze_approaches(spark, sf), ["close_approach_date_full", "id"], 5)


def q_window_7d(spark, sf):
    return approaches_from_events(feed_window(load(spark, sf, "events"), "ts", scenario.RUN2_REF))


# --- incremental and storage ------------------------------------------------------

def _write_then_read(df: DataFrame, path: str, schema, partition_by=None) -> DataFrame:
    write_table(df, path, mode="overwrite", partition_by=partition_by)
    return read_table(df.sparkSession, path, schema)


def _stage(spark, tag: str) -> str:
    return new_scratch_dir(spark, tag)


def q_pending_by_id(spark, sf):
    root = _stage(spark, "pending-by-id")
    seen = load(spark, sf, "events").select(F.col("user_id").cast("string").alias("id"))
    done = sized_join(bronze_metadata(spark, sf), seen.distinct(), "id", "left_semi",
                      size_bound=keys_bound(seen, "id")).transform(transform_metadata)
    write_table(done, f"{root}/silver_metadata")
    batch = bronze_metadata(spark, sf).withColumn("id", to_id("id"))
    return pending_against(spark, batch, f"{root}/silver_metadata", ["id"], schemas.SILVER_METADATA,
                           measure_target=True)


def q_pending_by_key(spark, sf):
    root = _stage(spark, "pending-by-key")
    write_table(_run_bronze(spark, sf, 1).transform(transform_approaches), f"{root}/silver_approaches",
                partition_by=schemas.APPROACHES_PARTITION)
    batch = _run_bronze(spark, sf, 2).withColumn("id", to_id("id"))
    return pending_against(spark, batch, f"{root}/silver_approaches", schemas.SILVER_APPROACHES_KEY,
                           schemas.SILVER_APPROACHES, null_safe=True)


def q_pending_missing_target(spark, sf):
    root = _stage(spark, "pending-missing")
    batch = bronze_approaches(spark, sf).withColumn("id", to_id("id"))
    return pending_against(spark, batch, f"{root}/never_written", schemas.SILVER_APPROACHES_KEY,
                           schemas.SILVER_APPROACHES, null_safe=True)


def q_merge_create(spark, sf):
    path = f"{_stage(spark, 'merge-create')}/bronze_approaches"
    insert_only_merge(bronze_approaches(spark, sf), path, schemas.BRONZE_APPROACHES_KEY,
                      partition_by=schemas.APPROACHES_PARTITION, schema=schemas.BRONZE_APPROACHES)
    return read_table(spark, path, schemas.BRONZE_APPROACHES)


def q_merge_insert_by_day(spark, sf):
    path = f"{_stage(spark, 'merge-day')}/bronze_approaches"
    write_table(_run_bronze(spark, sf, 1), path, partition_by=schemas.APPROACHES_PARTITION)
    insert_only_merge(_run_bronze(spark, sf, 2), path, schemas.BRONZE_APPROACHES_KEY,
                      partition_by=schemas.APPROACHES_PARTITION, prune_on="fecha",
                      schema=schemas.BRONZE_APPROACHES)
    return read_table(spark, path, schemas.BRONZE_APPROACHES)


def q_merge_insert_by_ts(spark, sf):
    path = f"{_stage(spark, 'merge-ts')}/silver_approaches"
    write_table(_run_bronze(spark, sf, 1).transform(transform_approaches), path,
                partition_by=schemas.APPROACHES_PARTITION)
    insert_only_merge(_run_bronze(spark, sf, 2).transform(transform_approaches), path,
                      schemas.SILVER_APPROACHES_KEY, partition_by=schemas.APPROACHES_PARTITION,
                      prune_on="fecha", schema=schemas.SILVER_APPROACHES)
    return read_table(spark, path, schemas.SILVER_APPROACHES)


def q_merge_insert_dedup(spark, sf):
    """As by day, but a key repeated inside the pull is inserted once (opt-in)."""
    path = f"{_stage(spark, 'merge-dedup')}/bronze_approaches"
    write_table(_run_bronze(spark, sf, 1), path, partition_by=schemas.APPROACHES_PARTITION)
    insert_only_merge(_run_bronze(spark, sf, 2), path, schemas.BRONZE_APPROACHES_KEY,
                      partition_by=schemas.APPROACHES_PARTITION, prune_on="fecha", dedup_source=True,
                      schema=schemas.BRONZE_APPROACHES)
    return read_table(spark, path, schemas.BRONZE_APPROACHES)


def q_merge_insert_by_id(spark, sf):
    """Target: entities seen in run 1 (per request); batch: the whole catalog."""
    path = f"{_stage(spark, 'merge-id')}/bronze_metadata"
    write_table(lookup(_run_bronze(spark, sf, 1).select("id"), bronze_metadata(spark, sf)), path)
    insert_only_merge(bronze_metadata(spark, sf), path, schemas.METADATA_KEY, schema=schemas.BRONZE_METADATA,
                      measure_target=True)
    return read_table(spark, path, schemas.BRONZE_METADATA)


def q_gold_roundtrip(spark, sf):
    path = f"{_stage(spark, 'gold')}/daily_summary"
    summary = q_daily_summary(spark, sf)
    write_table(summary, path)
    write_table(summary, path)  # a second overwrite replaces, never appends
    return read_table(spark, path, schemas.GOLD_DAILY_SUMMARY)


def q_partition_roundtrip(spark, sf):
    path = f"{_stage(spark, 'partitioned')}/silver_approaches"
    write_table(silver_approaches(spark, sf), path, partition_by=schemas.APPROACHES_PARTITION)
    return read_table(spark, path, schemas.SILVER_APPROACHES)


def _migrated(spark, sf) -> tuple[Lake, DataFrame]:
    """The five tables moved from a flat layout to the lake's, and what the migration reports."""
    root = _stage(spark, "migrate")
    old = f"{root}/old"
    write_table(bronze_approaches(spark, sf), f"{old}/bronze_approaches")
    write_table(bronze_metadata(spark, sf), f"{old}/bronze_metadata")
    write_table(silver_approaches(spark, sf), f"{old}/silver_approaches")
    write_table(silver_metadata(spark, sf), f"{old}/silver_metadata")
    write_table(q_daily_summary(spark, sf), f"{old}/daily_summary")
    new = Lake(f"{root}/new")
    return new, migrate_layout(spark, [
        Move("bronze/approaches", f"{old}/bronze_approaches", new.bronze_approaches, ("fecha",)),
        Move("bronze/metadata", f"{old}/bronze_metadata", new.bronze_metadata),
        Move("silver/approaches", f"{old}/silver_approaches", new.silver_approaches, ("fecha",)),
        Move("silver/metadata", f"{old}/silver_metadata", new.silver_metadata),
        Move("gold/daily_summary", f"{old}/daily_summary", new.gold_daily_summary),
    ])


def q_migrate_layout(spark, sf):
    return _migrated(spark, sf)[1]


def q_migrate_layout_rows(spark, sf):
    """Every row of the five migrated tables, side by side; columns that a table lacks are NULL."""
    lake, _ = _migrated(spark, sf)
    bronze = [read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES),
              read_table(spark, lake.bronze_metadata, schemas.BRONZE_METADATA)]
    silver = [read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
              read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA)]
    named = [("bronze/approaches", bronze[0]), ("bronze/metadata", bronze[1]),
             *((n, df.withColumn("id", F.col("id").cast("string"))) for n, df in zip(("silver/approaches", "silver/metadata"), silver)),
             ("gold/daily_summary", read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY))]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("table", F.lit(n)) for n, df in named])


# --- nested sources -----------------------------------------------------------------

def _landed_feed(spark, sf) -> DataFrame:
    path = land_text(feed_documents(load(spark, sf, "events")), f"{_stage(spark, 'feed')}/landing")
    return read_feed(spark, path)


def q_feed_flatten(spark, sf):
    return flatten_feed(_landed_feed(spark, sf))


def q_feed_count_check(spark, sf):
    return feed_element_check(_landed_feed(spark, sf))


def _landed_lookups(spark, sf, broken: bool):
    part = load(spark, sf, "part")
    docs = lookup_documents(part, broken_lookup_rule() if broken else None)
    return read_lookup_documents(spark, land_text(docs, f"{_stage(spark, 'lookups')}/landing"))


def q_lookup_flatten(spark, sf):
    parsed, _ = _landed_lookups(spark, sf, broken=False)
    return flatten_lookups(parsed)


def q_lookup_quarantine(spark, sf):
    _, quarantine = _landed_lookups(spark, sf, broken=True)
    return quarantined_ids(quarantine)


def q_lookup_quarantine_content(spark, sf):
    """Documents that are JSON but wrong: a text for a number or a flag, no object, no id."""
    value = F.col("value")
    kind = F.get_json_object(value, "$.id").cast("bigint") % 5
    wrong = (F.when(kind == 0, F.regexp_replace(value, r'"absolute_magnitude_h":[0-9.]+', '"absolute_magnitude_h":"oops"'))
             .when(kind == 1, F.lit("[]"))
             .when(kind == 2, F.regexp_replace(value, r'"id":"\d+",', ""))
             .when(kind == 3, F.regexp_replace(value, r'"is_sentry_object":(true|false)', '"is_sentry_object":"yes"'))
             .otherwise(value))
    docs = lookup_documents(load(spark, sf, "part")).select(wrong.alias("value"))
    parsed, quarantine = read_lookup_documents(spark, land_text(docs, f"{_stage(spark, 'lookups-wrong')}/landing"))
    return (parsed.select(F.lit("parsed").alias("state"), to_id("id").alias("id"))
            .unionByName(quarantined_ids(quarantine).select(F.lit("quarantined").alias("state"), "id")))


# fixed values: ids named by hand, one of them unknown
LITERAL_IDS = (1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 10**12)


def q_lookup_literal_ids(spark, sf):
    parsed, _ = _landed_lookups(spark, sf, broken=False)
    wanted = literal_ids(spark, LITERAL_IDS).select(F.col("id").cast("string").alias("id"))
    return lookup(wanted, flatten_lookups(parsed), distinct=True)


def q_lookup_semi(spark, sf):
    parsed, _ = _landed_lookups(spark, sf, broken=False)
    return lookup(bronze_approaches(spark, sf).select("id"), flatten_lookups(parsed), distinct=True)


def q_lookup_per_request(spark, sf):
    parsed, _ = _landed_lookups(spark, sf, broken=False)
    return lookup(bronze_approaches(spark, sf).select("id"), flatten_lookups(parsed), distinct=False)


# --- jobs over two landed pulls ---------------------------------------------------------

def q_incremental_two_runs(spark, sf):
    lake = scenario.two_runs(spark, sf)
    return read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)


def q_reprocess_equals_incremental(spark, sf):
    lake = scenario.two_runs(spark, sf)
    out = Lake(new_scratch_dir(spark, "reprocessed"))
    reprocess_silver(spark, lake, out)
    return read_table(spark, out.silver_approaches, schemas.SILVER_APPROACHES)


def q_e2e_daily_summary(spark, sf):
    lake = scenario.two_runs(spark, sf)
    return read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY)


def q_e2e_daily_summary_distinct(spark, sf):
    """The same two pulls with each entity looked up once per pull (no metadata fan-out)."""
    lake = scenario.two_runs(spark, sf, tag="two-runs-distinct", distinct_lookups=True)
    return read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY)


def q_integrity_report(spark, sf):
    lake = scenario.two_runs(spark, sf)
    return integrity_report(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
                            read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA))


def q_orphan_recovery(spark, sf):
    lake = scenario.recovered(spark, sf)
    return read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA)


def q_stream_ingest(spark, sf):
    """Two pulls landed one after the other, each taken by an availableNow run of the stream."""
    root = _stage(spark, "stream")
    lake = Lake(root)
    landing = f"{root}/landing/feed"
    catalog = scenario.catalog_from(spark, scenario.land_lookups(spark, sf, root, broken=True))
    for run in (1, 2):
        feed_documents(_run_events(spark, sf, run)).write.mode("append").text(landing)
        ingest_available(spark, landing, lake, catalog, f"{root}/_checkpoints/feed")
    return read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES)


def q_gold_after_recovery(spark, sf):
    """The daily summary once the orphans of the two deliveries have been looked up again."""
    lake = scenario.recovered(spark, sf)
    return read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY)


def q_silver_rerun_stable(spark, sf):
    """Three silver runs over bronze whose full time is on the day before, or unknown, for some rows."""
    lake = Lake(_stage(spark, "silver-rerun"))
    full = F.col("close_approach_date_full")
    moved = (F.when(F.col("orbiting_body") == "error", F.lit(None))
             .when(F.hour(full) < 6, full - F.expr("INTERVAL 1 DAY")).otherwise(full))
    write_table(bronze_approaches(spark, sf).withColumn("close_approach_date_full", moved), lake.bronze_approaches,
                partition_by=schemas.APPROACHES_PARTITION)
    write_table(bronze_metadata(spark, sf), lake.bronze_metadata)
    for _ in range(3):
        run_silver(spark, lake)
    return read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)


def q_silver_backlog(spark, sf):
    """A silver run, two bronze loads without one, then a silver run that takes up both."""
    lake = Lake(_stage(spark, "silver-backlog"))
    bronze, full = bronze_approaches(spark, sf), F.col("close_approach_date_full")
    first, second = (F.lit(x).cast("timestamp_ntz") for x in (scenario.RUN2_FROM, scenario.RUN1_UNTIL))
    write_table(bronze_metadata(spark, sf), lake.bronze_metadata)
    write_table(bronze.where(full < first), lake.bronze_approaches, partition_by=schemas.APPROACHES_PARTITION)
    run_silver(spark, lake)
    for part in ((full >= first) & (full <= second), full > second):
        write_table(bronze.where(part), lake.bronze_approaches, mode="append", partition_by=schemas.APPROACHES_PARTITION)
    run_silver(spark, lake)
    return read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)


def _feed_with_rejects(spark, sf) -> DataFrame:
    docs = feed_documents(load(spark, sf, "events"), without_approach=F.col("event_type") == "error")
    return read_feed(spark, land_text(docs, f"{_stage(spark, 'feed-rejects')}/landing"))


def q_feed_rejects(spark, sf):
    return feed_rejects(_feed_with_rejects(spark, sf))


def q_rejects_rerun(spark, sf):
    """The rejects table after the same delivery was taken twice."""
    lake, feed = Lake(_stage(spark, "rejects-rerun")), _feed_with_rejects(spark, sf)
    for _ in range(2):
        ingest_bronze(lake, feed, bronze_metadata(spark, sf))
    return read_table(spark, lake.bronze_rejects)


def q_schema_replace_roundtrip(spark, sf):
    path = f"{_stage(spark, 'schema-replace')}/metadata"
    write_table(bronze_metadata(spark, sf), path)
    write_table(silver_metadata(spark, sf), path, replace_schema=True)
    return read_table(spark, path, schemas.SILVER_METADATA)


def q_layer_counts(spark, sf):
    lake = scenario.two_runs(spark, sf)
    return layer_counts({
        ("bronze", "approaches"): read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES),
        ("bronze", "metadata"): read_table(spark, lake.bronze_metadata, schemas.BRONZE_METADATA),
        ("silver", "approaches"): read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
        ("silver", "metadata"): read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA),
        ("gold", "daily_summary"): read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY),
    })


def q_agg_mean_exact(spark, sf):
    """Means per body whose sums do not depend on the order of rows, beside those of values from 1e-9 to 1e12."""
    rows = silver_approaches(spark, sf).withColumn("spread", F.col("miss_distance_km") * F.expr("pow(10.0D, hora - 15)"))
    return summarize(rows, "orbiting_body", [
        ("velocity_mean", "relative_velocity_km_per_second", "mean"), ("distance_mean", "miss_distance_km", "mean"),
        ("spread_mean", "spread", "mean")], round_cols=("velocity_mean", "distance_mean", "spread_mean"))


def q_silver_stream(spark, sf):
    """Silver taken from new bronze files only: one landing, then two at once, then none."""
    root = _stage(spark, "silver-stream")
    lake, checkpoint = Lake(root), f"{root}/_checkpoints"
    bronze, full = bronze_approaches(spark, sf), F.col("close_approach_date_full")
    first, second = (F.lit(x).cast("timestamp_ntz") for x in (scenario.RUN2_FROM, scenario.RUN1_UNTIL))
    write_table(bronze_metadata(spark, sf), lake.bronze_metadata)
    for parts in ((full < first,), ((full >= first) & (full <= second), full > second), ()):
        for part in parts:
            write_table(bronze.where(part), lake.bronze_approaches, mode="append", partition_by=schemas.APPROACHES_PARTITION)
        run_silver_new_files(spark, lake, checkpoint)
    return read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)


def q_gold_incremental(spark, sf):
    """The summary by day after two deliveries and the recovery of the orphans, each run writing only the days it touched."""
    lake = scenario.recovered_by_increment(spark, sf)
    return read_table(spark, lake.gold_by_day, schemas.GOLD_DAILY_SUMMARY)


def q_stream_dedup(spark, sf):
    """Two overlapping landings and, after a restart, the second one landed again."""
    root = _stage(spark, "stream-dedup")
    lake, landing = Lake(root), f"{root}/landing/feed"
    for run in (1, 2, 2):
        feed_documents(_run_events(spark, sf, run)).write.mode("append").text(landing)
        ingest_unrepeated(spark, landing, lake, f"{root}/_checkpoints/feed")
    return read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES)


def q_merge_bucketed(spark, sf):
    """As by id, into a table that is stored in buckets of the id."""
    path = f"{_stage(spark, 'merge-bucketed')}/bronze_metadata"
    name = "bucketed_" + path.split("/")[-2].replace("-", "_")
    for batch in (lookup(_run_bronze(spark, sf, 1).select("id"), bronze_metadata(spark, sf)), bronze_metadata(spark, sf)):
        stored = merge_bucketed(batch, name, path, "id", schemas.BRONZE_METADATA)
    return stored


def q_lookup_clustered(spark, sf):
    """All approaches of a few entities from a table that is ordered by id within its days."""
    path = f"{_stage(spark, 'clustered')}/silver_approaches"
    write_clustered(silver_approaches(spark, sf), path, "id", schemas.APPROACHES_PARTITION)
    return lookup_keys(spark, path, schemas.SILVER_APPROACHES, "id", LITERAL_IDS)


def q_run_report(spark, sf):
    """Rows and NULLs of every layer, from the two runs' writes alone."""
    log = WriteLog()
    scenario.two_runs(spark, sf, tag="two-runs-observed", log=log)
    return log.report(spark)


def q_lookup_quarantine_strict(spark, sf):
    """Lookup lines with two objects, with braces inside a text, cut off, and whole ones."""
    value = F.col("value")
    kind = F.get_json_object(value, "$.id").cast("bigint") % 6
    landed = (F.when(kind == 0, F.concat(value, F.lit(" "), value))
              .when(kind == 1, F.regexp_replace(value, '"name":"', '"name":"} {'))
              .when(kind == 2, F.expr("left(value, length(value) - 1)"))
              .when(kind == 3, F.concat(value, F.lit("] {")))
              .otherwise(value))
    path = f"{_stage(spark, 'lookups-strict')}/landing"
    docs = lookup_documents(load(spark, sf, "part")).select(landed.alias("value"))
    parsed, quarantine = read_lookup_documents(spark, land_text(docs, path))
    bad = quarantine.select("file_path", "reason", F.regexp_extract("_corrupt_record", r'"id":"(\d+)"', 1).cast("bigint").alias("id"))
    return (parsed.select(F.lit("parsed").alias("state"), to_id("id").alias("id"), "name", F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select(F.when(F.col("file_path").contains("/landing/"), "quarantined").alias("state"), "id",
                                    F.lit(None).cast("string").alias("name"), "reason")))


def q_layer_diff(spark, sf):
    """The days on which a copy of silver was altered: a row changed, one doubled, one lost, a day moved to no day."""
    silver = silver_approaches(spark, sf)
    day = F.dayofmonth("fecha")
    bent = F.when((day == 3) & (F.col("hora") == 5), F.col("miss_distance_km") + 0.5).otherwise(F.col("miss_distance_km"))
    copy = (silver.withColumn("miss_distance_km", bent)
            .where(~((day == 9) & (F.col("orbiting_body") == "error")))
            .withColumn("n", F.when((day == 11) & (F.col("hora") == 0), 2).otherwise(1))
            .select(*[c for c in silver.columns if c != "fecha"], F.when(day == 20, F.lit(None)).otherwise(F.col("fecha")).alias("fecha"),
                    F.explode(F.sequence(F.lit(1), F.col("n"))).alias("_copy")).drop("_copy"))
    return layer_diff(silver, copy)


QUERIES = {
    "daily_summary": q_daily_summary,
    "daily_summary_fanout": q_daily_summary_fanout,
    "join_left_fanout": q_join_left_fanout,
    "agg_count": q_agg_count,
    "agg_mean": q_agg_mean,
    "agg_min_max": q_agg_min_max,
    "agg_flag_sum": q_agg_flag_sum,
    "agg_null_key": q_agg_null_key,
    "distinct_keys": q_distinct_keys,
    "silver_approaches": q_silver_approaches,
    "silver_metadata": q_silver_metadata,
    "cast_timestamp": q_cast_timestamp,
    "cast_id": q_cast_id,
    "cast_double": q_cast_double,
    "cast_bool": q_cast_bool,
    "date_hour_split": q_date_hour_split,
    "name_number": q_name_number,
    "name_provisional": q_name_provisional,
    "name_has_number": q_name_has_number,
    "diff_range": q_diff_range,
    "flag_or": q_flag_or,
    "round_half_even": q_round_half_even,
    "orphans_by_null": q_orphans_by_null,
    "orphans_by_key": q_orphans_by_key,
    "dup_keys": q_dup_keys,
    "null_profile": q_null_profile,
    "name_lossless": q_name_lossless,
    "peek_top5": q_peek_top5,
    "window_7d": q_window_7d,
    "pending_by_id": q_pending_by_id,
    "pending_by_key": q_pending_by_key,
    "pending_missing_target": q_pending_missing_target,
    "merge_create": q_merge_create,
    "merge_insert_by_day": q_merge_insert_by_day,
    "merge_insert_by_ts": q_merge_insert_by_ts,
    "merge_insert_by_id": q_merge_insert_by_id,
    "merge_insert_dedup": q_merge_insert_dedup,
    "gold_roundtrip": q_gold_roundtrip,
    "partition_roundtrip": q_partition_roundtrip,
    "migrate_layout": q_migrate_layout,
    "migrate_layout_rows": q_migrate_layout_rows,
    "feed_flatten": q_feed_flatten,
    "feed_count_check": q_feed_count_check,
    "lookup_flatten": q_lookup_flatten,
    "lookup_quarantine": q_lookup_quarantine,
    "lookup_semi": q_lookup_semi,
    "lookup_per_request": q_lookup_per_request,
    "incremental_two_runs": q_incremental_two_runs,
    "reprocess_equals_incremental": q_reprocess_equals_incremental,
    "e2e_daily_summary": q_e2e_daily_summary,
    "e2e_daily_summary_distinct": q_e2e_daily_summary_distinct,
    "integrity_report": q_integrity_report,
    "orphan_recovery": q_orphan_recovery,
    "gold_after_recovery": q_gold_after_recovery,
    "silver_rerun_stable": q_silver_rerun_stable,
    "silver_backlog": q_silver_backlog,
    "feed_rejects": q_feed_rejects,
    "rejects_rerun": q_rejects_rerun,
    "schema_replace_roundtrip": q_schema_replace_roundtrip,
    "lookup_quarantine_content": q_lookup_quarantine_content,
    "lookup_literal_ids": q_lookup_literal_ids,
    "agg_typed": q_agg_typed,
    "layer_counts": q_layer_counts,
    "stream_ingest": q_stream_ingest,
    "agg_mean_exact": q_agg_mean_exact,
    "silver_stream": q_silver_stream,
    "gold_incremental": q_gold_incremental,
    "stream_dedup": q_stream_dedup,
    "merge_bucketed": q_merge_bucketed,
    "lookup_clustered": q_lookup_clustered,
    "run_report": q_run_report,
    "lookup_quarantine_strict": q_lookup_quarantine_strict,
    "layer_diff": q_layer_diff,
}
