"""Which days of two tables differ, without joining their rows.

The rows of a day are a multiset; its fingerprint is the number of rows and two sums of row hashes.  Sums do not
depend on the order of rows, count a repeated row each time, and add up over partitions map-side, so each table is
read once and one row a day is shuffled.  A row's hash covers every column by position, NULLs with their
place.  Two different multisets share a fingerprint with a chance of about 2^-128 a day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _hash(columns: Sequence[str], seed: int):
    parts = [F.lit(seed)]
    for i, c in enumerate(columns):  # a NULL leaves a hash as it is, so its place is hashed as well
        parts += [F.coalesce(F.xxhash64(F.lit(i), F.col(f"`{c}`")), F.lit(0)), F.when(F.col(f"`{c}`").isNull(), F.lit(i)).otherwise(F.lit(-1))]
    return F.xxhash64(*parts).cast("decimal(20,0)")


def day_fingerprints(df: DataFrame, by: str = "fecha", columns: Sequence[str] | None = None) -> DataFrame:
    """``(by, rows, print_a, print_b)``: one row per day, a NULL day included.  Mergeable: rows and prints of parts add up."""
    columns = sorted(columns or df.columns)
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), F.sum(_hash(columns, 1)).cast("decimal(38,0)").alias("print_a"),
                              F.sum(_hash(columns, 2)).cast("decimal(38,0)").alias("print_b"))


def layer_diff(left: DataFrame, right: DataFrame, by: str = "fecha", columns: Sequence[str] | None = None) -> DataFrame:
    """``(by, left_rows, right_rows)`` of the days whose rows are not the same multiset; 0 rows where a side lacks the day."""
    columns = columns or left.columns
    named = [day_fingerprints(df, by, columns).select(F.col(by).alias(f"{side}_day"), *[F.col(c).alias(f"{side}_{c}") for c in ("rows", "print_a", "print_b")])
             for side, df in (("left", left), ("right", right))]
    pairs = named[0].join(named[1], F.col("left_day").eqNullSafe(F.col("right_day")), "full")
    same = (F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("left_print_a").eqNullSafe(F.col("right_print_a"))
            & F.col("left_print_b").eqNullSafe(F.col("right_print_b")))
    return pairs.where(~same).select(F.coalesce("left_day", "right_day").alias(by), F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
                                     F.coalesce("right_rows", F.lit(0)).alias("right_rows"))
