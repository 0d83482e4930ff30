"""Sums of doubles that do not depend on the order in which rows are added.

A double is split, without error, into whole numbers of 2^30, 1, 2^-30 and 2^-60
(the lower three from 0 to 2^30 - 1).  Whole numbers add up exactly in any order, so every plan,
partitioning and retried task gives the same four sums, and one fixed formula turns them into the
same double.  Exact for magnitudes below 2^62 down to steps of 2^-60; what a value has below 2^-60 is cut off,
equally in every order.  Values of 2^62 and more, infinities among them, are added as doubles beside the four sums.

The parts of one group stay below 2^63 for eight thousand million rows.  Larger groups are
summed in two steps, by a finer key first; the second step adds wide decimals.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratiform.functions.expr import nan_to_null

STEP = float(1 << 30)
LARGE = float(1 << 62)
PARTS = ("p3", "p2", "p1", "p0")
WIDE = "decimal(38,0)"


def split_double(c: Column) -> dict[str, Column]:
    """The four whole parts of a double, and ``big`` for a value outside their range; NULL and NaN have none."""
    v = nan_to_null(c)
    inside = F.when(F.abs(v) < F.lit(LARGE), v)
    p3 = F.floor(inside / F.lit(STEP))
    rest = inside - p3.cast("double") * F.lit(STEP)  # every difference here is exact
    p2 = F.floor(rest)
    rest = (rest - p2.cast("double")) * F.lit(STEP)
    p1 = F.floor(rest)
    rest = (rest - p1.cast("double")) * F.lit(STEP)
    return {"p3": p3, "p2": p2, "p1": p1, "p0": F.floor(rest), "big": F.when(F.abs(v) >= F.lit(LARGE), v)}


def exact_partials(c: Column, prefix: str) -> list[Column]:
    """Aggregates ``<prefix>_p3`` ... ``_p0``, ``_big`` and ``_n`` of a double column: the mergeable state of its sum and mean."""
    parts = split_double(c)
    return [*[F.coalesce(F.sum(parts[p]), F.lit(0)).cast("bigint").alias(f"{prefix}_{p}") for p in PARTS],
            F.sum(parts["big"]).alias(f"{prefix}_big"), F.count(nan_to_null(c)).alias(f"{prefix}_n")]


def partial_columns(prefix: str) -> list[str]:
    return [f"{prefix}_{p}" for p in (*PARTS, "big", "n")]


def merged_total(prefix: str, weight: Column | None = None) -> Column:
    """The sum over several states, each ``weight`` times, as a double; NULL when none holds a value."""
    w = F.lit(1) if weight is None else weight
    wide = [F.sum(F.col(f"{prefix}_{p}").cast(WIDE) * w.cast("decimal(18,0)")).cast(WIDE) for p in PARTS]
    total = _as_double(wide) + F.coalesce(F.sum(F.col(f"{prefix}_big") * w), F.lit(0.0))
    return F.when(F.sum(F.col(f"{prefix}_n")) > 0, total)


def merged_count(prefix: str, weight: Column | None = None) -> Column:
    w = F.lit(1) if weight is None else weight
    return F.sum(F.col(f"{prefix}_n") * w).cast("bigint")


def merged_mean(prefix: str, weight: Column | None = None) -> Column:
    return F.try_divide(merged_total(prefix, weight), merged_count(prefix, weight).cast("double"))


def _as_double(parts: list[Column]) -> Column:
    """The double next to the four sums: whole part and fraction are brought in order before either is rounded."""
    step, one = (F.lit(Decimal(1 << k)).cast(WIDE) for k in (30, 60))
    p3, p2, p1, p0 = parts
    fraction = (p1 * step).cast(WIDE) + p0  # in 2^-60, may exceed one
    rest = fraction % one
    whole = (p3 * step).cast(WIDE) + p2 + ((fraction - rest) / one).cast(WIDE)
    # below zero the fraction counts downwards, so that nothing cancels
    up = whole.cast("double") + rest.cast("double") / F.lit(float(1 << 60))
    down = (whole + 1).cast("double") - (one - rest).cast("double") / F.lit(float(1 << 60))
    return F.when(whole >= 0, up).otherwise(down)


def exact_sum(c: Column) -> Column:
    """The order-independent sum of a double column, in one aggregation; NULL for a group without values."""
    parts = split_double(c)
    wide = [F.sum(parts[p]).cast(WIDE) for p in PARTS]
    return F.when(F.count(nan_to_null(c)) > 0,
                  F.coalesce(_as_double(wide), F.lit(0.0)) + F.coalesce(F.sum(parts["big"]), F.lit(0.0)))


def exact_mean(c: Column) -> Column:
    """The order-independent mean of a double column; NULL for a group without values."""
    return F.try_divide(exact_sum(c), F.count(nan_to_null(c)).cast("double"))
