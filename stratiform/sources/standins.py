"""Layer inputs derived from the shared test tables.

``events`` plays the approach feed, ``part`` the per-entity lookup catalog,
``documents``/``labels`` a natural pair with missing partners.  All stand-ins
are lazy projections of whole tables; the landing writers turn them into the
JSON documents the real feeds deliver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.functions.expr import FEED_DAY_FORMAT, FEED_TIME_FORMAT, day_of, day_start

# Fixed values of the stand-in mapping (see FIXTURES.md section 4):
#   every third part key carries an official number in its name
#   a part is hazardous when p_size > 40, under watch when p_type = 'PROMO'
#   an approach is flagged hazardous when its event_type = 'error'
#   lookups of parts whose name starts with 'hot ' come back broken
NAME_NUMBER_EVERY = 3
HAZARD_SIZE = 40
SENTRY_TYPE = "PROMO"
HAZARD_EVENT = "error"
BROKEN_LOOKUP_PREFIX = "hot "
FEED_ROWS_PER_DOCUMENT = 100


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _miss_distance(events: DataFrame):
    return events["value"] * F.lit(1000.0) + F.get_json_object(events["props"], "$.k").cast("double")


def approaches_from_events(events: DataFrame) -> DataFrame:
    """Bronze approaches (id as text, as delivered)."""
    return events.select(
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.col("user_id").cast("string"), F.lit(" ("), F.col("event_type"), F.lit(")")).alias("name"),
        day_start("ts").alias("close_approach_date"),
        F.col("ts").alias("close_approach_date_full"),
        F.col("value").alias("relative_velocity_km_per_second"),
        _miss_distance(events).alias("miss_distance_km"),
        F.col("event_type").alias("orbiting_body"),
        (F.col("event_type") == F.lit(HAZARD_EVENT)).alias("is_potentially_hazardous"),
        day_of("ts").alias("fecha"),
    )


def _entity_name():
    key = F.col("p_partkey").cast("string")
    return (F.when(F.col("p_partkey") % NAME_NUMBER_EVERY == 0,
                   F.concat(key, F.lit(" "), F.col("p_name"), F.lit(" ("), F.col("p_brand"), F.lit(")")))
             .otherwise(F.concat(F.lit("("), F.col("p_brand"), F.lit(")"))))


def metadata_from_part(part: DataFrame) -> DataFrame:
    """Bronze metadata (one row per catalog entity)."""
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        _entity_name().alias("name"),
        (F.lit(10.0) + F.col("p_size") / F.lit(2.0)).alias("absolute_magnitude_h"),
        F.col("p_size").cast("double").alias("diameter_min_km"),
        F.col("p_retailprice").cast("double").alias("diameter_max_km"),
        (F.col("p_size") > HAZARD_SIZE).alias("is_potentially_hazardous"),
        (F.col("p_type") == F.lit(SENTRY_TYPE)).alias("is_sentry_object"),
        F.concat(F.lit("catalog/"), F.col("p_partkey").cast("string")).alias("nasa_jpl_url"),
    )


# --- landing writers -----------------------------------------------------------

def feed_documents(events: DataFrame, rows_per_document: int = FEED_ROWS_PER_DOCUMENT, without_approach=None) -> DataFrame:
    """Feed JSON text, one document per line: ``{element_count, near_earth_objects: {day: [..]}}``.

    Documents hold one day and at most ``rows_per_document`` consecutive event
    ids, so no document (and no collect_list group) grows with the data.  Rows matching
    ``without_approach`` get an empty list of close approaches.
    """
    miss = _miss_distance(events)
    approaches = F.lit(1) if without_approach is None else F.when(without_approach, 0).otherwise(1)
    obj = F.struct(
        F.col("user_id").cast("string").alias("id"),
        F.concat(F.col("user_id").cast("string"), F.lit(" ("), F.col("event_type"), F.lit(")")).alias("name"),
        (F.col("event_type") == F.lit(HAZARD_EVENT)).alias("is_potentially_hazardous_asteroid"),
        F.slice(F.array(F.struct(
            F.date_format("ts", FEED_DAY_FORMAT).alias("close_approach_date"),
            F.date_format("ts", FEED_TIME_FORMAT).alias("close_approach_date_full"),
            F.struct(F.col("value").cast("string").alias("kilometers_per_second")).alias("relative_velocity"),
            F.struct(miss.cast("string").alias("kilometers")).alias("miss_distance"),
            F.col("event_type").alias("orbiting_body"),
        )), F.lit(1), approaches).alias("close_approach_data"),
    )
    grouped = (events
               .withColumn("_day", F.date_format("ts", FEED_DAY_FORMAT))
               .withColumn("_doc", F.floor(F.col("event_id") / F.lit(rows_per_document)))
               .groupBy("_day", "_doc")
               .agg(F.collect_list(obj).alias("_objs")))
    doc = F.struct(
        F.size("_objs").cast("bigint").alias("element_count"),
        F.create_map(F.col("_day"), F.col("_objs")).alias("near_earth_objects"),
    )
    return grouped.select(F.to_json(doc).alias("value"))


def lookup_documents(part: DataFrame, broken=None) -> DataFrame:
    """Lookup JSON text, one entity per line.  Rows matching ``broken`` are cut in half (bad JSON)."""
    doc = F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        _entity_name().alias("name"),
        (F.lit(10.0) + F.col("p_size") / F.lit(2.0)).alias("absolute_magnitude_h"),
        F.struct(F.struct(
            F.col("p_size").cast("double").alias("estimated_diameter_min"),
            F.col("p_retailprice").cast("double").alias("estimated_diameter_max"),
        ).alias("kilometers")).alias("estimated_diameter"),
        (F.col("p_size") > HAZARD_SIZE).alias("is_potentially_hazardous_asteroid"),
        (F.col("p_type") == F.lit(SENTRY_TYPE)).alias("is_sentry_object"),
        F.concat(F.lit("catalog/"), F.col("p_partkey").cast("string")).alias("nasa_jpl_url"),
    ))
    if broken is None:
        return part.select(doc.alias("value"))
    cut = F.substring(doc, 1, (F.length(doc) / 2).cast("int"))
    return part.select(F.when(broken, cut).otherwise(doc).alias("value"))


def broken_lookup_rule():
    return F.col("p_name").startswith(BROKEN_LOOKUP_PREFIX)


def land_text(df: DataFrame, path: str) -> str:
    """Write one text line per row (the landing area of a pull)."""
    df.write.mode("overwrite").text(path)
    return path
