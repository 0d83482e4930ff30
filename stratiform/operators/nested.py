"""Nested documents -> flat rows (map entries, array elements, struct paths)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.expr import (
    FEED_DAY_FORMAT, FEED_TIME_FORMAT, bool_or_false, day_of, parse_timestamp, to_double,
)


def feed_objects(feed: DataFrame) -> DataFrame:
    """``(_feed_day, o)``: map entry -> row, then array element -> row (an empty array gives no row)."""
    days = feed.select(F.explode("near_earth_objects").alias("_feed_day", "_objs"))
    return days.select("_feed_day", F.explode("_objs").alias("o"))


def flatten_feed(feed: DataFrame) -> DataFrame:
    """Feed documents -> bronze approaches, one row per object, its first close approach.

    Objects without any close approach are left out here; ``feed_rejects``
    returns them.
    """
    return flatten_objects(feed_objects(feed))


def flatten_objects(objects: DataFrame) -> DataFrame:
    """``feed_objects`` rows -> bronze approaches."""
    first = F.get(F.col("o.close_approach_data"), 0)
    return (objects
            .where(first.isNotNull())
            .select(
                F.col("o.id").alias("id"),
                F.col("o.name").alias("name"),
                parse_timestamp(first["close_approach_date"], FEED_DAY_FORMAT).alias("close_approach_date"),
                parse_timestamp(first["close_approach_date_full"], FEED_TIME_FORMAT).alias("close_approach_date_full"),
                to_double(first["relative_velocity"]["kilometers_per_second"]).alias("relative_velocity_km_per_second"),
                to_double(first["miss_distance"]["kilometers"]).alias("miss_distance_km"),
                first["orbiting_body"].alias("orbiting_body"),
                F.col("o.is_potentially_hazardous_asteroid").alias("is_potentially_hazardous"),
            )
            .withColumn("fecha", day_of("close_approach_date")))


def objects_extent(objects: DataFrame) -> tuple:
    """First and last day, rows that can be flattened, and all objects of a parsed pull, in one pass."""
    first = F.get(F.col("o.close_approach_data"), 0)
    day = day_of(parse_timestamp(first["close_approach_date"], FEED_DAY_FORMAT))
    return tuple(objects.agg(F.min(day), F.max(day), F.count(first), F.count(F.lit(1))).first())


def feed_rejects(feed: DataFrame) -> DataFrame:
    """Objects whose close-approach list is empty or missing (they cannot be flattened)."""
    return rejected_objects(feed_objects(feed))


def rejected_objects(objects: DataFrame) -> DataFrame:
    first = F.get(F.col("o.close_approach_data"), 0)
    return objects.where(first.isNull()).select(
        F.col("_feed_day").alias("feed_day"), F.col("o.id").alias("id"), F.col("o.name").alias("name"))


def _held() -> Column:
    """The objects a feed document holds."""
    return F.aggregate(F.map_values("near_earth_objects"), F.lit(0).cast("bigint"),
                       lambda acc, arr: acc + F.coalesce(F.size(arr), F.lit(0)).cast("bigint"))


def declared_matches() -> Column:
    """Whether a feed document holds as many objects as it declares."""
    return F.col("element_count").eqNullSafe(_held())


def feed_element_check(feed: DataFrame) -> DataFrame:
    """Declared ``element_count`` against the objects each document really holds.

    Computed per document as a row expression (no shuffle), then one global
    partial/final aggregate.
    """
    per_doc = feed.select(F.col("element_count").alias("declared"), _held().alias("actual"))
    return per_doc.agg(
        F.count(F.lit(1)).alias("documents"),
        F.coalesce(F.sum("declared"), F.lit(0)).cast("bigint").alias("declared_total"),
        F.coalesce(F.sum("actual"), F.lit(0)).cast("bigint").alias("flattened_total"),
        F.count(F.when(~F.col("declared").eqNullSafe(F.col("actual")), 1)).alias("mismatched_documents"),
    )


def flatten_lookups(docs: DataFrame) -> DataFrame:
    """Lookup documents -> bronze metadata (eight fields, typed)."""
    km = F.col("estimated_diameter.kilometers")
    return docs.select(
        F.col("id"),
        F.col("name"),
        F.col("absolute_magnitude_h").cast("double").alias("absolute_magnitude_h"),
        km["estimated_diameter_min"].cast("double").alias("diameter_min_km"),
        km["estimated_diameter_max"].cast("double").alias("diameter_max_km"),
        bool_or_false("is_potentially_hazardous_asteroid").alias("is_potentially_hazardous"),
        bool_or_false("is_sentry_object").alias("is_sentry_object"),
        F.col("nasa_jpl_url"),
    )
