"""Column expressions with the null, NaN, cast and rounding rules of the layers.

All of them are built-in Spark expressions (no UDF), so they stay inside
whole-stage codegen.  Each takes and returns a ``Column``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "FEED_DAY_FORMAT", "FEED_TIME_FORMAT", "NAME_NUMBER_PATTERN", "NAME_PROVISIONAL_PATTERN",
    "NAME_HAS_NUMBER_PATTERN", "round_half_even", "nan_to_null", "null_if_empty", "bool_or_false",
    "to_double", "to_id", "parse_timestamp", "day_of", "hour_of", "day_start",
    "official_number", "provisional_designation", "has_official_number", "rebuilt_name",
    "diameter_uncertainty", "risk_flag",
]

# Fixed values (must match the source data formats and the naming rules):
#   feed day text         yyyy-MM-dd          e.g. 2015-09-08
#   feed time text        yyyy-MMM-dd HH:mm   e.g. 2015-Sep-08 20:28
#   leading official number      ^(\d+)\s
#   parenthesised provisional    \((.+)\)     (greedy)
#   has-number test              ^\d+\s
FEED_DAY_FORMAT = "yyyy-MM-dd"
FEED_TIME_FORMAT = "yyyy-MMM-dd HH:mm"
NAME_NUMBER_PATTERN = r"^(\d+)\s"
NAME_PROVISIONAL_PATTERN = r"\((.+)\)"
NAME_HAS_NUMBER_PATTERN = r"^\d+\s"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, scale: int = 2) -> Column:
    """Scale, round half to even, unscale: 0.125 -> 0.12, 1.005 -> 1.0, 2.675 -> 2.68.

    Spark's ``round``/``bround`` work on the decimal expansion; this works on the
    binary double the way a vectorised float rounding does, which is the rule the
    summary tables are defined with.
    """
    factor = float(10 ** scale)
    return F.rint(_c(c) * F.lit(factor)) / F.lit(factor)


def nan_to_null(c) -> Column:
    """NaN -> NULL, so that avg/min/max skip it instead of being poisoned by it."""
    return F.nanvl(_c(c), F.lit(None).cast("double"))


def null_if_empty(c) -> Column:
    return F.nullif(_c(c), F.lit(""))


def bool_or_false(c) -> Column:
    """A JSON boolean that may be absent: NULL -> false."""
    return F.coalesce(_c(c).cast("boolean"), F.lit(False))


def to_double(c) -> Column:
    """Text or number -> double, NaN -> NULL.  Bad text raises under ANSI mode."""
    return nan_to_null(_c(c).cast("double"))


def to_id(c, strict: bool = True) -> Column:
    """Identifier text -> bigint.  ``strict`` raises on bad text, under any session setting; else NULL."""
    value = _c(c).try_cast("bigint")
    if not strict:
        return value
    bad = F.raise_error(F.concat(F.lit("not an identifier: "), _c(c).cast("string"))).cast("bigint")
    return F.when(value.isNull() & _c(c).isNotNull(), bad).otherwise(value)


def parse_timestamp(c, fmt: str | None = None) -> Column:
    """Zone-less timestamp; ``fmt`` for text input, plain cast otherwise."""
    if fmt is None:
        return _c(c).cast("timestamp_ntz")
    return F.to_timestamp_ntz(_c(c), F.lit(fmt))


def day_of(ts) -> Column:
    return F.to_date(_c(ts))


def hour_of(ts) -> Column:
    return F.hour(_c(ts)).cast("int")


def day_start(ts) -> Column:
    """Midnight of the same day, still a zone-less timestamp."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def official_number(name) -> Column:
    return null_if_empty(F.regexp_extract(_c(name), NAME_NUMBER_PATTERN, 1))


def provisional_designation(name) -> Column:
    return null_if_empty(F.regexp_extract(_c(name), NAME_PROVISIONAL_PATTERN, 1))


def has_official_number(name) -> Column:
    return _c(name).rlike(NAME_HAS_NUMBER_PATTERN)


def rebuilt_name(number, provisional) -> Column:
    """Best reconstruction of a name from its two extracted parts."""
    n, p = _c(number), _c(provisional)
    return (F.when(n.isNotNull() & p.isNotNull(), F.concat(n, F.lit(" ("), p, F.lit(")")))
             .when(n.isNotNull(), n)
             .when(p.isNotNull(), F.concat(F.lit("("), p, F.lit(")"))))


def diameter_uncertainty(dmax, dmin) -> Column:
    return _c(dmax) - _c(dmin)


def risk_flag(hazardous, sentry) -> Column:
    return _c(hazardous) | _c(sentry)
