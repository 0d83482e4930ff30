"""Aggregations with the summary rules: NULL group keys dropped, NaN skipped,
an all-NULL flag sums to 0.0, chosen columns rounded half-to-even."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratiform.functions.exact import exact_mean, exact_partials, exact_sum, merged_mean
from stratiform.functions.expr import nan_to_null, round_half_even
from stratiform.operators.joins import BROADCAST_MAX_BYTES, keys_bound, sized_join

AGG_FUNCTIONS = ("count", "mean", "max", "min", "sum")


def _agg(fn: str, c: Column, kind: str) -> Column:
    if kind in ("float", "double"):  # NaN counts as missing; other types have none
        c = nan_to_null(c)
    if fn == "count":
        return F.count(c)
    if fn == "mean":
        return F.avg(c) if kind.startswith("decimal") else exact_mean(c.cast("double"))
    if fn == "max":
        return F.max(c)
    if fn == "min":
        return F.min(c)
    if fn == "sum":
        # a flag or number summed as double; a group with only NULLs gives 0.0
        total = F.sum(c.cast("double")) if kind == "boolean" else exact_sum(c.cast("double"))
        return F.coalesce(total, F.lit(0.0))
    raise ValueError(f"unknown aggregate {fn!r}; expected one of {AGG_FUNCTIONS}")


def summarize(df: DataFrame, by: str | Sequence[str], spec: Sequence[tuple[str, str, str]],
              round_cols: Sequence[str] = (), scale: int = 2) -> DataFrame:
    """Named aggregation: ``spec`` is ``[(output, input_column, function), ...]``.

    Rows whose group key is NULL are dropped before grouping.
    """
    keys = [by] if isinstance(by, str) else list(by)
    kinds = dict(df.dtypes)
    kept = df
    for k in keys:
        kept = kept.where(F.col(k).isNotNull())
    out = kept.groupBy(*keys).agg(*[_agg(fn, F.col(src), kinds[src]).alias(name) for name, src, fn in spec])
    if round_cols:
        out = out.select(*[round_half_even(c, scale).alias(c) if c in round_cols else F.col(c)
                           for c in out.columns])
    return out


# fixed values: output names of the daily summary
DAILY_COLUMNS = ("fecha", "cantidad_aproximaciones", "velocidad_promedio_km_s", "velocidad_maxima_km_s",
                 "distancia_minima_km", "distancia_promedio_km", "cantidad_bajo_seguimiento_riesgo",
                 "diametro_maximo_km")
DAILY_ROUNDED = ("velocidad_promedio_km_s", "velocidad_maxima_km_s", "distancia_minima_km",
                 "distancia_promedio_km", "diametro_maximo_km")


def _daily_join_first(a: DataFrame, m: DataFrame, key: str, day: str) -> DataFrame:
    joined = sized_join(a, m.select(key, "bajo_seguimiento_riesgo", "diameter_max_km"), key, "left")
    return summarize(joined, day, [
        ("cantidad_aproximaciones", key, "count"),
        ("velocidad_promedio_km_s", "relative_velocity_km_per_second", "mean"),
        ("velocidad_maxima_km_s", "relative_velocity_km_per_second", "max"),
        ("distancia_minima_km", "miss_distance_km", "min"),
        ("distancia_promedio_km", "miss_distance_km", "mean"),
        ("cantidad_bajo_seguimiento_riesgo", "bajo_seguimiento_riesgo", "sum"),
        ("diametro_maximo_km", "diameter_max_km", "max"),
    ], round_cols=DAILY_ROUNDED)


# Per-entity values besides the key: a bigint and two doubles.
ENTITY_VALUE_BYTES = 24


def entity_summary(m: DataFrame, key: str = "id") -> DataFrame:
    """One row per id: ``metadata_rows`` (how many metadata rows carry it), their
    flag sum ``bajo_seguimiento_riesgo`` (double, NULL when all flags are NULL) and
    their largest ``diameter_max_km``.  Partial aggregation collapses a duplicated
    entity map-side."""
    return (m.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("metadata_rows"),
                 F.sum(F.col("bajo_seguimiento_riesgo").cast("double")).alias("bajo_seguimiento_riesgo"),
                 F.max(nan_to_null(F.col("diameter_max_km"))).alias("diameter_max_km")))


def fanout_left_join(approaches: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """Left join of approaches with their metadata, the fan-out carried as a weight.

    Each approach row appears once, with ``metadata_rows`` = how many rows a plain
    left join would have produced for it (0 when it has no partner; it still
    counts as one row then), plus the partners' flag sum and largest diameter.
    Nothing is dropped, and no pairs inside a key group are ever formed.
    """
    # at most one row per metadata row: the key plus three fixed-width values
    joined = sized_join(approaches, entity_summary(metadata, key), key, "left",
                        size_bound=keys_bound(metadata, key, ENTITY_VALUE_BYTES))
    return joined.withColumn("metadata_rows", F.coalesce(F.col("metadata_rows"), F.lit(0)).cast("bigint"))


def _per_entity(m: DataFrame, key: str) -> DataFrame:
    return entity_summary(m, key).select(key, F.col("metadata_rows").alias("_matches"),
                                         F.col("bajo_seguimiento_riesgo").alias("_flags"),
                                         F.col("diameter_max_km").alias("_dmax"))


def _weight() -> Column:
    # the join fan-out, replayed: an approach stands for max(matches, 1) joined rows
    return F.greatest(F.coalesce(F.col("_matches"), F.lit(0)), F.lit(1)).cast("bigint")


def _states(key: str) -> list[Column]:
    """Mergeable aggregates of approaches: counts, exact sums, extremes."""
    v, d = F.col("relative_velocity_km_per_second"), F.col("miss_distance_km")
    return [F.count(F.col(key)).alias("n_key"), F.count(F.lit(1)).alias("n_rows"), *exact_partials(v, "v"), *exact_partials(d, "d"),
            F.max(nan_to_null(v)).alias("max_v"), F.min(nan_to_null(d)).alias("min_d")]


def approach_partials(a: DataFrame, key: str = "id", day: str = "fecha") -> DataFrame:
    """One mergeable row per (day, id); rows without a day are left out."""
    return a.where(F.col(day).isNotNull()).groupBy(day, key).agg(*_states(key))


def _finish(states: DataFrame, day: str) -> DataFrame:
    """Daily rows from states that carry a weight, their flags and their largest diameter."""
    w = F.col("_w")
    out = states.groupBy(day).agg(
        F.sum(F.col("n_key") * w).cast("bigint").alias("cantidad_aproximaciones"),
        merged_mean("v", w).alias("velocidad_promedio_km_s"), F.max("max_v").alias("velocidad_maxima_km_s"),
        F.min("min_d").alias("distancia_minima_km"), merged_mean("d", w).alias("distancia_promedio_km"),
        F.coalesce(F.sum("_flags"), F.lit(0.0)).alias("cantidad_bajo_seguimiento_riesgo"),
        F.max("_dmax").alias("diametro_maximo_km"))
    return out.select(*[round_half_even(c).alias(c) if c in DAILY_ROUNDED else F.col(c) for c in DAILY_COLUMNS])


def _daily_broadcast_entities(a: DataFrame, m: DataFrame, key: str, day: str) -> DataFrame:
    """Approaches stay where they are (no shuffle); the per-entity rows are broadcast.

    Only the metadata is shuffled (to collapse duplicates to one row per id), so
    neither a hot id nor a duplicated entity multiplies work.  Rows are summed per (day, weight)
    first, so that the row-wise sums are whole numbers and the few weighted ones wide decimals.
    """
    j = a.where(F.col(day).isNotNull()).join(F.broadcast(_per_entity(m, key)), key, "left").withColumn("_w", _weight())
    return _finish(j.groupBy(day, "_w").agg(*_states(key), F.sum("_flags").alias("_flags"), F.max("_dmax").alias("_dmax")), day)


def summary_of_partials(partials: DataFrame, m: DataFrame, key: str = "id", day: str = "fecha",
                        max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """The daily summary from ``approach_partials`` and metadata.

    The join moves compact rows, and a hot id or a duplicated entity never lands whole in one task.  The
    join fan-out is replayed as a weight on the sums and counts; max/min are unaffected by it.
    """
    j = sized_join(partials, _per_entity(m, key), key, "left", max_bytes=max_bytes,
                   size_bound=keys_bound(m, key, ENTITY_VALUE_BYTES))
    return _finish(j.withColumn("_w", _weight()).withColumn("_flags", F.col("n_rows") * F.col("_flags")), day)


def _daily_preaggregated(a: DataFrame, m: DataFrame, key: str, day: str) -> DataFrame:
    """Same result, shaped for a metadata side too large to broadcast: approaches collapse to
    one partial row per (day, id) before any shuffle and metadata to one row per id."""
    return summary_of_partials(approach_partials(a, key, day), m, key, day, max_bytes=0)


def daily_summary(approaches: DataFrame, metadata: DataFrame, key: str = "id", day: str = "fecha",
                  strategy: str = "auto", broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Per day: approaches (fan-out of duplicated metadata included), mean/max velocity,
    min/mean distance, flagged approaches (double), largest diameter; rounded to 2.

    Sums are exact whole numbers until the last step, so all plans, partitionings and retries give the same doubles.

    ``auto`` measures the metadata keys first (one scan of the key column): the
    per-entity rows take at most that plus 24 bytes per metadata row.  Under the bound
    the per-entity rows are broadcast and the approaches are never shuffled, so
    a hot id costs nothing; above it the pre-aggregated plan keeps every shuffle
    compact and skew-free.  Forcing ``broadcast`` skips the count: the caller
    vouches for the size.  ``join_first`` is the literal join-then-group form; it
    forms one row per (approach, metadata) pair, so it suits unique metadata and
    comparisons only.
    """
    if strategy == "auto":
        small = keys_bound(metadata, key, ENTITY_VALUE_BYTES)() <= broadcast_max_bytes
        strategy = "broadcast" if small else "preaggregate"
    if strategy == "broadcast":
        return _daily_broadcast_entities(approaches, metadata, key, day)
    if strategy == "preaggregate":
        return _daily_preaggregated(approaches, metadata, key, day)
    if strategy == "join_first":
        return _daily_join_first(approaches, metadata, key, day)
    raise ValueError(f"unknown strategy {strategy!r}")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def layer_counts(frames: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """``(layer, table, rows)`` for each named frame: one partial count per task, one row each."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(table).alias("table"), "rows")
             for (layer, table), df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
