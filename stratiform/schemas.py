"""Declared schemas: the landed JSON documents and the layer tables.

Parquet does not enforce a schema, so every read of a layer table passes the
declared one and every write is checked against it (see operators.tables).
"""

from pyspark.sql.types import (
    ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
    MapType, StringType, StructField, StructType, TimestampNTZType,
)

# --- landed feed document: one range query of the approach feed -------------
CLOSE_APPROACH = StructType([
    StructField("close_approach_date", StringType()),
    StructField("close_approach_date_full", StringType()),
    StructField("relative_velocity", StructType([StructField("kilometers_per_second", StringType())])),
    StructField("miss_distance", StructType([StructField("kilometers", StringType())])),
    StructField("orbiting_body", StringType()),
])

FEED_OBJECT = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("is_potentially_hazardous_asteroid", BooleanType()),
    StructField("close_approach_data", ArrayType(CLOSE_APPROACH)),
])

FEED = StructType([
    StructField("element_count", LongType()),
    StructField("near_earth_objects", MapType(StringType(), ArrayType(FEED_OBJECT))),
])

# --- landed lookup document: one entity -------------------------------------
# The field names of both landed documents (feed and lookup) are
# those of the public feed format they come from, including nasa_jpl_url.
LOOKUP = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("absolute_magnitude_h", DoubleType()),
    StructField("estimated_diameter", StructType([
        StructField("kilometers", StructType([
            StructField("estimated_diameter_min", DoubleType()),
            StructField("estimated_diameter_max", DoubleType()),
        ])),
    ])),
    StructField("is_potentially_hazardous_asteroid", BooleanType()),
    StructField("is_sentry_object", BooleanType()),
    StructField("nasa_jpl_url", StringType()),
])

# --- layer tables ------------------------------------------------------------
# The column names of the layer tables.
BRONZE_APPROACHES = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("close_approach_date", TimestampNTZType()),
    StructField("close_approach_date_full", TimestampNTZType()),
    StructField("relative_velocity_km_per_second", DoubleType()),
    StructField("miss_distance_km", DoubleType()),
    StructField("orbiting_body", StringType()),
    StructField("is_potentially_hazardous", BooleanType()),
    StructField("fecha", DateType()),
])

BRONZE_METADATA = StructType([
    StructField("id", StringType()),
    StructField("name", StringType()),
    StructField("absolute_magnitude_h", DoubleType()),
    StructField("diameter_min_km", DoubleType()),
    StructField("diameter_max_km", DoubleType()),
    StructField("is_potentially_hazardous", BooleanType()),
    StructField("is_sentry_object", BooleanType()),
    StructField("nasa_jpl_url", StringType()),
])

SILVER_APPROACHES = StructType([
    StructField("id", LongType()),
    StructField("close_approach_date_full", TimestampNTZType()),
    StructField("relative_velocity_km_per_second", DoubleType()),
    StructField("miss_distance_km", DoubleType()),
    StructField("orbiting_body", StringType()),
    StructField("fecha", DateType()),
    StructField("hora", IntegerType()),
])

SILVER_METADATA = StructType([
    StructField("id", LongType()),
    StructField("absolute_magnitude_h", DoubleType()),
    StructField("diameter_min_km", DoubleType()),
    StructField("diameter_max_km", DoubleType()),
    StructField("is_potentially_hazardous", BooleanType()),
    StructField("is_sentry_object", BooleanType()),
    StructField("numero_oficial", StringType()),
    StructField("designacion_provisional", StringType()),
    StructField("tiene_designacion_oficial", BooleanType()),
    StructField("incertidumbre_diametro_km", DoubleType()),
    StructField("bajo_seguimiento_riesgo", BooleanType()),
])

GOLD_DAILY_SUMMARY = StructType([
    StructField("fecha", DateType()),
    StructField("cantidad_aproximaciones", LongType()),
    StructField("velocidad_promedio_km_s", DoubleType()),
    StructField("velocidad_maxima_km_s", DoubleType()),
    StructField("distancia_minima_km", DoubleType()),
    StructField("distancia_promedio_km", DoubleType()),
    StructField("cantidad_bajo_seguimiento_riesgo", DoubleType()),
    StructField("diametro_maximo_km", DoubleType()),
])

# State of the daily summary: counts, exact sums (see functions.exact) and extremes per (day, id).
GOLD_PARTIALS = StructType([
    StructField("fecha", DateType()),
    StructField("id", LongType()),
    StructField("n_key", LongType()),
    StructField("n_rows", LongType()),
    *[StructField(f"{x}_{p}", DoubleType() if p == "big" else LongType())
      for x in ("v", "d") for p in ("p3", "p2", "p1", "p0", "big", "n")],
    StructField("max_v", DoubleType()),
    StructField("min_d", DoubleType()),
])

# Table keys (conventions, nothing enforces them) and partition columns.
BRONZE_APPROACHES_KEY = ["id", "close_approach_date"]
SILVER_APPROACHES_KEY = ["id", "close_approach_date_full"]
METADATA_KEY = ["id"]
APPROACHES_PARTITION = ["fecha"]
