"""Gold for the days that changed.

State table ``daily_partials``, partitioned by day: one mergeable row per (day, id) with exact sums, counts and
extremes of the approaches.  New silver files name the days they touch; those days' partials are
computed again from silver (only those partitions are read) and replace the old ones by dynamic partition
overwrite, so a replayed batch leaves the same state.  The days' summaries follow from the partials and
the entity metadata.  New metadata touches the days on which its ids appear, found in the partials; silver approaches are not
read for it.

Both steps run inside their stream's batch, so a batch whose gold was not written is taken again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.operators.aggregates import approach_partials, summary_of_partials
from stratiform.operators.joins import keys_bound, sized_join
from stratiform.operators.tables import replace_partitions
from stratiform.paths import Lake
from stratiform.sources.landed import path_exists, read_table
from stratiform.streaming.silver_stream import take_new_files

DAY = "fecha"


def _days(df: DataFrame) -> list[dt.date]:
    """The days of a frame; one value per partition of the table, so a bounded list."""
    return sorted(r[0] for r in df.where(F.col(DAY).isNotNull()).select(DAY).distinct().collect())


def _of_days(df: DataFrame, days: list[dt.date]) -> DataFrame:
    return df.where(F.col(DAY).isin(days))  # literals: only those partitions are listed and read


def refresh_partials(spark: SparkSession, lake: Lake, days: list[dt.date]) -> None:
    silver = _of_days(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES), days)
    replace_partitions(approach_partials(silver), lake.gold_partials, [DAY])


def refresh_summaries(spark: SparkSession, lake: Lake, days: list[dt.date]) -> None:
    partials = _of_days(read_table(spark, lake.gold_partials, schemas.GOLD_PARTIALS), days)
    metadata = read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA)
    replace_partitions(summary_of_partials(partials, metadata), lake.gold_by_day, [DAY])


def days_of_ids(spark: SparkSession, lake: Lake, ids: DataFrame) -> list[dt.date]:
    """The days on which any of ``ids`` has approaches, from the partials."""
    partials = read_table(spark, lake.gold_partials, schemas.GOLD_PARTIALS).select(DAY, "id")
    return _days(sized_join(partials, ids.select("id").distinct(), "id", "left_semi", size_bound=keys_bound(ids, "id")))


def run_gold_increment(spark: SparkSession, lake: Lake, checkpoint: str) -> list[dt.date]:
    """Bring the per-day summary up to date with silver; returns the days written."""
    written: set[dt.date] = set()

    def approaches(batch: DataFrame, _: int) -> None:
        days = _days(batch)
        if days:
            refresh_partials(spark, lake, days)
            refresh_summaries(spark, lake, days)
            written.update(days)

    def metadata(batch: DataFrame, _: int) -> None:
        if path_exists(spark, lake.gold_partials):
            days = days_of_ids(spark, lake, batch)
            if days:
                refresh_summaries(spark, lake, days)
                written.update(days)

    take_new_files(spark, lake.silver_approaches, schemas.SILVER_APPROACHES, f"{checkpoint}/gold-approaches", approaches)
    take_new_files(spark, lake.silver_metadata, schemas.SILVER_METADATA, f"{checkpoint}/gold-metadata", metadata)
    return sorted(written)
