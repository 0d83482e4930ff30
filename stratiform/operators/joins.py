"""Joins that broadcast a side only after measuring it.

Spark's static broadcast decision trusts file-size estimates, and AQE's runtime
conversion comes after the large side has already been shuffled.  Here the
candidate side is measured first with one small aggregate (exact row count and
exact string bytes), and broadcast only under a fixed byte bound; above it the
join is a normal shuffle join, with AQE skew handling on the left side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType,
    StringType, TimestampNTZType, TimestampType,
)

from stratiform.session import new_scratch_dir

# fixed value: largest side shipped to every task (in-memory bound, bytes)
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16  # row header and null bits, per row
_FIXED = {LongType: 8, DoubleType: 8, TimestampType: 8, TimestampNTZType: 8, DateType: 4, IntegerType: 4,
          FloatType: 4, ShortType: 2, ByteType: 1, BooleanType: 1}
_BROADCASTABLE = {"left": "right", "left_outer": "right", "leftouter": "right", "inner": "right",
                  "left_semi": "right", "leftsemi": "right", "semi": "right",
                  "left_anti": "right", "leftanti": "right", "anti": "right"}


def measured_bytes(df: DataFrame, extra_per_row: int = 0) -> int:
    """Upper bound of the in-memory size of ``df``: one aggregate, one row back.

    Fixed-width columns count their width, strings their real byte length plus a
    pointer; nested columns count their JSON text length (a generous bound).
    ``extra_per_row`` adds fixed-width columns a derived frame will carry (so the
    key columns of a source bound its per-key aggregate).
    """
    fixed = _ROW_OVERHEAD + extra_per_row
    var = []
    for f in df.schema.fields:
        width = next((w for t, w in _FIXED.items() if isinstance(f.dataType, t)), None)
        if width is not None:
            fixed += width
        elif isinstance(f.dataType, StringType):
            fixed += 8
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("bigint"))
        else:
            fixed += 8
            var.append(F.coalesce(F.length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)).cast("bigint"))
    payload = var[0] if len(var) == 1 else (sum(var[1:], var[0]) if var else F.lit(0).cast("bigint"))
    rows, strings = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(payload), F.lit(0))).first()
    return int(rows) * fixed + int(strings)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    return measured_bytes(df) <= max_bytes


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
               max_bytes: int = BROADCAST_MAX_BYTES, size_bound=None) -> DataFrame:
    """``left.join(right, on, how)``, broadcasting ``right`` when it measures under ``max_bytes``.

    ``size_bound`` is a cheaper proven upper bound of ``right``'s size: either a
    byte count or a callable returning one (evaluated only for broadcastable
    join types), e.g. the measure of the frame ``right`` is aggregated or
    de-duplicated from, which needs a scan but no shuffle.  Only join types whose
    right side may be the build side are considered; anything else is a plain join.
    """
    if how.lower() in _BROADCASTABLE:
        if size_bound is None:
            size = measured_bytes(right)
        else:
            size = size_bound() if callable(size_bound) else size_bound
        if size <= max_bytes:
            right = F.broadcast(right)
    return left.join(right, on, how)


def keys_bound(source: DataFrame, keys, extra_per_row: int = 0):
    """A ``size_bound`` for a per-key aggregate or de-duplication of ``source``:
    at most one row per source row, holding the keys plus ``extra_per_row`` bytes
    of fixed-width values.  Measured by a scan of the key columns only."""
    cols = [keys] if isinstance(keys, str) else list(keys)
    return lambda: measured_bytes(source.select(*cols), extra_per_row)


# Left keys holding more rows than this are spread over SALTS tasks in a shuffle
# join (the right side's rows for such a key are replicated once per salt).
HOT_KEY_ROWS = 1_000_000
SALTS = 32


def skew_safe_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str],
                   how: str, hot_key_rows: int = HOT_KEY_ROWS, salts: int = SALTS, left_rows: int | None = None) -> DataFrame:
    """Equi-join ``left[left_keys] == right[right_keys]`` that survives a hot left key.

    A left side of at most ``hot_key_rows`` rows holds no hot key, so its rows are counted first (``left_rows`` when
    the caller knows them).  Beyond that, hot keys are found by a map-side combined count of the left keys (at most
    rows / ``hot_key_rows`` of them).  The list is written once and measured before it is broadcast.  The left rows of a hot
    key are dealt over ``salts`` tasks by their place, and its right rows are replicated once per salt, so every left
    row still meets all its partners and the result is the same.  A place is only a fixed thing in stored files: where
    there is a hot key, ``left`` is written to the shared folder first, so that a task run again deals its rows alike.
    For inner, left outer, left semi and left anti joins.  Without hot keys this is the plain join.
    """
    cond = reduce(lambda a, b: a & b, [left[lk] == right[rk] for lk, rk in zip(left_keys, right_keys)])
    if left_rows is None:
        left_rows = left.count()
    if left_rows <= hot_key_rows:
        return left.join(right, cond, how)
    hot = _stored(left.groupBy(*left_keys).agg(F.count(F.lit(1)).alias("__n"))
                  .where(F.col("__n") > hot_key_rows).select(*left_keys), "hot-keys")
    if hot.isEmpty():
        return left.join(right, cond, how)
    small = F.broadcast if fits_broadcast(hot) else (lambda df: df)  # beyond the bound the list is joined by shuffle
    placed = _stored(left, "hot-rows").withColumn("__place", F.monotonically_increasing_id())
    salted_left = (placed.join(small(hot.withColumn("__hot_l", F.lit(True))), left_keys, "left")
                   .withColumn("__salt_l", F.when(F.col("__hot_l"), F.pmod(F.xxhash64("__place"), F.lit(salts)))
                               .otherwise(F.lit(0)).cast("int"))
                   .select(*[F.col(f"`{c}`") for c in left.columns], "__salt_l"))
    hot_r = small(hot.select(*[F.col(lk).alias(rk) for lk, rk in zip(left_keys, right_keys)])
                        .withColumn("__hot_r", F.lit(True)))
    salted_right = (right.join(hot_r, right_keys, "left")
                    .withColumn("__salt_r", F.explode(F.when(F.col("__hot_r"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                                      .otherwise(F.array(F.lit(0)))))
                    .drop("__hot_r"))
    cond = reduce(lambda a, b: a & b, [salted_left[lk] == salted_right[rk] for lk, rk in zip(left_keys, right_keys)])
    joined = salted_left.join(salted_right, cond & (salted_left["__salt_l"] == salted_right["__salt_r"]), how)
    return joined.drop("__salt_l", "__salt_r")


def _stored(df: DataFrame, tag: str) -> DataFrame:
    path = new_scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
