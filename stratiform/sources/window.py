"""The pull window: ``[ref - (days-1), ref]`` inclusive, by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEED_WINDOW_DAYS = 7  # fixed value: widest range one feed pull may ask for


def window_bounds(ref_date: dt.date | str, days: int = FEED_WINDOW_DAYS) -> tuple[dt.date, dt.date]:
    ref = dt.date.fromisoformat(ref_date) if isinstance(ref_date, str) else ref_date
    return ref - dt.timedelta(days=days - 1), ref


def window_text(ref_date, days: int = FEED_WINDOW_DAYS) -> tuple[str, str]:
    """The two bounds as request text (yyyy-MM-dd)."""
    start, end = window_bounds(ref_date, days)
    return start.isoformat(), end.isoformat()


def in_window(ts_col: str, ref_date, days: int = FEED_WINDOW_DAYS, as_of=None) -> Column:
    """Predicate on a timestamp column, written as a plain range so it reaches the scan.

    ``as_of`` cuts the last day at the moment of the pull (rows known by then).
    """
    start, end = window_bounds(ref_date, days)
    # text literals cast to a zone-less timestamp: independent of any time zone
    lo = F.lit(f"{start.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{(end + dt.timedelta(days=1)).isoformat()} 00:00:00").cast("timestamp_ntz")
    pred = (F.col(ts_col) >= lo) & (F.col(ts_col) < hi)
    if as_of is not None:
        text = as_of.isoformat(sep=" ") if isinstance(as_of, dt.datetime) else str(as_of)
        pred = pred & (F.col(ts_col) <= F.lit(text).cast("timestamp_ntz"))
    return pred


def in_day_window(date_col: str, ref_date, days: int = FEED_WINDOW_DAYS) -> Column:
    """Same window on a DATE column (a partition column prunes whole folders)."""
    start, end = window_bounds(ref_date, days)
    return F.col(date_col).between(F.lit(start), F.lit(end))


def feed_window(df: DataFrame, ts_col: str, ref_date, days: int = FEED_WINDOW_DAYS, as_of=None) -> DataFrame:
    return df.where(in_window(ts_col, ref_date, days, as_of))
