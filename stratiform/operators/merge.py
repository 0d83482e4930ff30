"""Incremental building blocks: pending rows, insert-only merge, id lookups.

Set membership is always an anti/semi join (distributed, key columns only);
no key set is ever collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiform.operators.joins import (
    BROADCAST_MAX_BYTES, HOT_KEY_ROWS, SALTS, fits_broadcast, keys_bound, measured_bytes, sized_join,
    skew_safe_join,
)
from stratiform.operators.tables import append_table, write_table
from stratiform.sources.landed import path_exists, read_table, stored_schema


_NULL_SAFE_DEFAULTS = {
    "bigint": 0, "int": 0, "smallint": 0, "tinyint": 0, "double": 0.0, "float": 0.0,
    "string": "", "boolean": False,
    "date": dt.date(1970, 1, 1), "timestamp_ntz": dt.datetime(1970, 1, 1),
}


def _match_columns(df: DataFrame, keys: list[str], null_safe: bool, prefix: str) -> list:
    """Columns whose plain equality is the wanted key match.

    Null-safe keys become (value or a default, is-null) pairs, the same encoding
    Spark uses for ``<=>``; spelled out here so the de-duplicated target keys are
    already hash-partitioned the way the join needs them (one exchange, not two).
    """
    types = dict(df.dtypes)
    cols = []
    for k in keys:
        if not null_safe:
            cols.append(F.col(k).alias(f"{prefix}{k}"))
            continue
        if types[k] not in _NULL_SAFE_DEFAULTS:
            raise TypeError(f"null-safe key {k!r} of type {types[k]} is not supported")
        default = F.lit(_NULL_SAFE_DEFAULTS[types[k]]).cast(types[k])
        cols.append(F.coalesce(F.col(k), default).alias(f"{prefix}{k}"))
        cols.append(F.col(k).isNull().alias(f"{prefix}{k}__isnull"))
    return cols


def anti_by_keys(batch: DataFrame, target: DataFrame, keys: list[str], null_safe: bool, measure_target: bool = False,
                 hot_key_rows: int = HOT_KEY_ROWS, salts: int = SALTS, batch_rows: int | None = None) -> DataFrame:
    """Rows of ``batch`` with no key match in ``target``.

    Only the key columns of ``target`` are read, and repeated target keys are
    collapsed map-side first (only existence matters), so a key the target holds
    many times never piles up in one task.

    A target that grows with history is left to AQE (broadcast only once its
    shuffle has measured it).  ``measure_target`` is for targets with entity-sized keys:
    their key columns are measured first, as stored and, beyond the bound, without the repeats, and
    broadcast under it, so the batch is neither shuffled nor worked out a second time.  Otherwise a batch key holding more than
    ``hot_key_rows`` rows is salted over ``salts`` tasks (``skew_safe_join``, which counts
    the batch unless ``batch_rows`` says how many rows it has at most).
    """
    left_cols = _match_columns(batch, keys, null_safe, "__b_")
    right = target.select(*_match_columns(target, keys, null_safe, "__t_"))
    left = batch.select("*", *left_cols)
    bnames = [c for c in left.columns if c.startswith("__b_")]
    tnames = [c.replace("__b_", "__t_", 1) for c in bnames]
    if measure_target and (fits_broadcast(right) or fits_broadcast(right.distinct())):
        right = F.broadcast(right.distinct())
        cond = reduce(lambda a, b: a & b, [left[b] == right[t] for b, t in zip(bnames, tnames)])
        return left.join(right, cond, "left_anti").select(*batch.columns)
    return skew_safe_join(left, right.distinct(), bnames, tnames, "left_anti",
                          hot_key_rows, salts, batch_rows).select(*batch.columns)


def pending_rows(batch: DataFrame, target: DataFrame | None, keys: list[str], null_safe: bool = True,
                 measure_target: bool = False, batch_rows: int | None = None) -> DataFrame:
    """Rows not yet present downstream.  NULL keys match each other when ``null_safe``."""
    if target is None:
        return batch
    return anti_by_keys(batch, target, keys, null_safe, measure_target, batch_rows=batch_rows)


def pending_against(spark: SparkSession, batch: DataFrame, target_path: str, keys: list[str],
                    schema: StructType | None = None, null_safe: bool = True,
                    measure_target: bool = False) -> DataFrame:
    """``pending_rows`` against a stored table; a missing table means everything is pending."""
    if not path_exists(spark, target_path):
        return batch
    stored = schema or stored_schema(spark, target_path)
    if stored is None:  # exists but holds no rows yet
        return batch
    return pending_rows(batch, read_table(spark, target_path, stored), keys, null_safe, measure_target)


def first_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest whole row (columns compared in order).

    Deterministic, unlike ``dropDuplicates``, so a replayed batch keeps the same
    row; and an aggregate, so a hot key collapses map-side instead of being
    sorted in one task.  All non-key columns must be orderable (no map columns).
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(c) for c in others])).alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def batch_extent(batch: DataFrame, column: str) -> tuple:
    """(least, largest) of ``column`` and the rows of ``batch``, in one pass."""
    return tuple(batch.agg(F.min(column), F.max(column), F.count(F.lit(1))).first())


def partition_range_filter(batch: DataFrame, target: DataFrame, column: str, bounds=None) -> DataFrame:
    """Restrict ``target`` to the [min, max] of ``column`` in ``batch``.

    One tiny aggregate (two values, or ``bounds`` when the caller has them) turns
    into literal partition filters on the target scan.  Valid only when the merge
    key determines ``column`` the same way on both sides.
    """
    lo, hi = bounds if bounds is not None else batch.agg(F.min(column), F.max(column)).first()
    if lo is None:
        return target.where(F.col(column).isNull())
    # a stored NULL partition may hold null-safe matches
    return target.where(F.col(column).between(F.lit(lo), F.lit(hi)) | F.col(column).isNull())


def insert_only_merge(batch: DataFrame, path: str, keys: list[str], partition_by: list[str] | None = None,
                      null_safe: bool = False, dedup_source: bool = False, prune_on: str | None = None,
                      schema: StructType | None = None, measure_target: bool = False,
                      prune_bounds: tuple | None = None, batch_rows: int | None = None,
                      observation: Observation | None = None) -> str:
    """Append the rows of ``batch`` whose key is not in the table at ``path``.

    Every unmatched source row is inserted, duplicates inside the batch
    included, unless ``dedup_source`` (then one row per key: the smallest).  Keys compare with SQL ``=`` (NULL keys
    never match and are inserted again) unless ``null_safe``.  A missing table is
    created from the whole batch.  ``prune_on`` names a partition column the keys
    determine, so only the target partitions the batch can touch are read.
    ``prune_bounds`` passes that column's (min, max) in the batch when already known, ``batch_rows`` the rows it has at most.
    ``measure_target`` broadcasts an entity-sized target after measuring it.  ``observation`` counts what is written.
    """
    spark = batch.sparkSession
    if dedup_source:
        batch = first_row_per_key(batch, keys)
    if not path_exists(spark, path):
        write_table(batch, path, mode="overwrite", partition_by=partition_by, observation=observation)
        return path
    stored = stored_schema(spark, path)
    target = read_table(spark, path, schema or stored or batch.schema)
    if prune_on is not None:
        if prune_bounds is None:
            *prune_bounds, batch_rows = batch_extent(batch, prune_on)
        target = partition_range_filter(batch, target, prune_on, prune_bounds)
    fresh = anti_by_keys(batch, target, keys, null_safe, measure_target, batch_rows=batch_rows)
    append_table(fresh.select(*batch.columns), path, partition_by=partition_by, observation=observation)  # checks the schema
    return path


def lookup(ids: DataFrame, catalog: DataFrame, key: str = "id", distinct: bool = False,
           max_bytes: int = BROADCAST_MAX_BYTES, hot_key_rows: int = HOT_KEY_ROWS, rows: int | None = None) -> DataFrame:
    """Entities of ``catalog`` for the requested ``ids``.

    ``distinct=False`` answers every request, so an id asked for twice comes
    back twice (the per-request behaviour); ``distinct=True`` answers each id once.
    Ids with no catalog entry are skipped.  An entity the catalog holds more than
    once is answered with its smallest row.  ``rows`` is the number of requests, when known.
    """
    if distinct:
        # a hot id asked for many times collapses map-side before the semi join
        found = sized_join(catalog, ids.select(key).distinct(), key, "left_semi",
                           max_bytes=max_bytes, size_bound=keys_bound(ids, key))
        return first_row_per_key(found, [key])
    # one answer per request: a catalog holding an entity twice must not multiply
    # requests (no pairs inside a key group); the requests may be huge and skewed,
    # so they stay in place when the catalog is small
    answers = first_row_per_key(catalog, [key])
    requests = ids.select(key)
    # the catalog as delivered bounds its de-duplicated form (measured by a scan only)
    if measured_bytes(catalog) <= max_bytes:
        return requests.join(F.broadcast(answers), key, "inner").select(*catalog.columns)
    # too large to broadcast: a shuffle join in which a hot requested id is salted
    renamed = answers.withColumnRenamed(key, "__r_key")
    return skew_safe_join(requests, renamed, [key], ["__r_key"], "inner", hot_key_rows, left_rows=rows).select(
        *[F.col("__r_key").alias(key) if c == key else F.col(c) for c in catalog.columns])
