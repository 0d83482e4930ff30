"""Inspection helpers (deterministic peeks, column types as data)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def peek(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by ``order_by`` (a top-k: each task keeps n, the driver merges)."""
    return df.orderBy(*order_by).limit(n)


def column_types(df: DataFrame) -> DataFrame:
    """``(column, type)`` of ``df``; the schema is metadata, so this is tiny."""
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")
