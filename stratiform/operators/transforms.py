"""Silver transforms: re-type, derive, drop.  Use with ``df.transform(...)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.expr import (
    bool_or_false, day_of, diameter_uncertainty, has_official_number, hour_of, official_number,
    parse_timestamp, provisional_designation, risk_flag, to_double, to_id,
)


def transform_approaches(bronze: DataFrame, strict_ids: bool = True) -> DataFrame:
    """Bronze approaches -> silver approaches.

    The day and hour come from the full timestamp (the day-only column and the
    entity attributes are dropped).  ``strict_ids=False`` turns a bad id into NULL
    instead of failing the job.
    """
    ts = parse_timestamp("close_approach_date_full")
    return bronze.select(
        to_id("id", strict_ids).alias("id"),
        ts.alias("close_approach_date_full"),
        to_double("relative_velocity_km_per_second").alias("relative_velocity_km_per_second"),
        to_double("miss_distance_km").alias("miss_distance_km"),
        F.col("orbiting_body").cast("string").alias("orbiting_body"),
        day_of(ts).alias("fecha"),
        hour_of(ts).alias("hora"),
    )


def transform_metadata(bronze: DataFrame, strict_ids: bool = True) -> DataFrame:
    """Bronze metadata -> silver metadata (name split into its parts, two derived columns)."""
    hazardous = bool_or_false("is_potentially_hazardous")
    sentry = bool_or_false("is_sentry_object")
    dmin = to_double("diameter_min_km")
    dmax = to_double("diameter_max_km")
    return bronze.select(
        to_id("id", strict_ids).alias("id"),
        to_double("absolute_magnitude_h").alias("absolute_magnitude_h"),
        dmin.alias("diameter_min_km"),
        dmax.alias("diameter_max_km"),
        hazardous.alias("is_potentially_hazardous"),
        sentry.alias("is_sentry_object"),
        official_number("name").alias("numero_oficial"),
        provisional_designation("name").alias("designacion_provisional"),
        has_official_number("name").alias("tiene_designacion_oficial"),
        diameter_uncertainty(dmax, dmin).alias("incertidumbre_diametro_km"),
        risk_flag(hazardous, sentry).alias("bajo_seguimiento_riesgo"),
    )
