"""The repeated overlapping pull as a Structured Streaming job.

Landed feed documents are a file source; each micro-batch is ingested into
bronze with the insert-only merge inside ``foreachBatch``.  Run it with
``availableNow`` after each landing: the checkpoint remembers which files were
taken, so a restarted or repeated run takes each file once, and a replayed
micro-batch finds its keys already stored and appends nothing new.

Each micro-batch is treated as one pull (rows repeated inside one batch are all
inserted), so land one pull per trigger or leave ``max_files_per_trigger`` unset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratiform import schemas
from stratiform.paths import Lake
from stratiform.plans.jobs import ingest_bronze


def feed_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.FEED).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir)


def ingest_available(spark: SparkSession, landing_dir: str, lake: Lake, catalog: DataFrame,
                     checkpoint_location: str, distinct_lookups: bool = False,
                     max_files_per_trigger: int | None = None) -> None:
    """Ingest every landed document not taken yet, then stop."""

    def _batch(batch: DataFrame, epoch_id: int) -> None:
        ingest_bronze(lake, batch, catalog, distinct_lookups)  # parses the batch once

    query = (feed_stream(spark, landing_dir, max_files_per_trigger)
             .writeStream
             .foreachBatch(_batch)
             .option("checkpointLocation", checkpoint_location)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
