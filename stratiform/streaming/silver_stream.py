"""Silver from the bronze files that no earlier run has taken.

Bronze is read as a streaming file source: its checkpoint is the list of files already taken, so a
run reads only what has been written since, not the history.  Each run takes all new files as
one batch (``availableNow``).  Rows are transformed, and those whose null-safe key silver holds
already are left out, which makes a replayed batch add nothing.  Silver's day is derived from the key,
so only the silver days that the batch touches are compared, by key columns alone.

A run after a rebuilt or migrated bronze finds files under new names and takes them all once more; the key
comparison keeps them from being added twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stratiform import schemas
from stratiform.operators.merge import batch_extent, partition_range_filter, pending_rows
from stratiform.operators.quality import integrity_report
from stratiform.operators.tables import append_table, write_table
from stratiform.operators.transforms import transform_approaches, transform_metadata
from stratiform.paths import Lake
from stratiform.sources.landed import path_exists, read_table

# A file older than this against the newest one would be passed over by the source; no file is.
MAX_FILE_AGE = "36500d"


@dataclass
class NewFilesRun:
    """The rows that a run read per table, from the stream's own progress; a batch's rows count each time they are read."""
    rows: dict[str, int] = field(default_factory=dict)


def take_new_files(spark: SparkSession, path: str, schema: StructType, checkpoint: str,
                   batch_fn: Callable[[DataFrame, int], None], taken: NewFilesRun | None = None, name: str = "") -> int:
    """Call ``batch_fn`` with the rows of the files under ``path`` that this checkpoint has not seen; returns their number."""
    if not path_exists(spark, path):
        return 0

    query = (spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE).parquet(path)
             .writeStream.foreachBatch(batch_fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    rows = sum(p["numInputRows"] for p in query.recentProgress)
    if taken is not None:
        taken.rows[name] = taken.rows.get(name, 0) + rows
    return rows


def add_approaches(batch: DataFrame, lake: Lake) -> None:
    """Silver approaches from new bronze rows; keys that silver holds already are left out."""
    spark, fresh = batch.sparkSession, batch.transform(transform_approaches)
    if not path_exists(spark, lake.silver_approaches):
        write_table(fresh, lake.silver_approaches, partition_by=schemas.APPROACHES_PARTITION)
        return
    silver = read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)
    lo, hi, rows = batch_extent(fresh, "fecha")
    silver = partition_range_filter(fresh, silver, "fecha", (lo, hi))
    pending = pending_rows(fresh, silver, schemas.SILVER_APPROACHES_KEY, null_safe=True, batch_rows=rows)
    append_table(pending, lake.silver_approaches, partition_by=schemas.APPROACHES_PARTITION)


def add_metadata(batch: DataFrame, lake: Lake) -> None:
    spark, fresh = batch.sparkSession, batch.transform(transform_metadata)
    if not path_exists(spark, lake.silver_metadata):
        write_table(fresh, lake.silver_metadata)
        return
    silver = read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA)
    append_table(pending_rows(fresh, silver, schemas.METADATA_KEY, null_safe=True, measure_target=True), lake.silver_metadata)


def run_silver_new_files(spark: SparkSession, lake: Lake, checkpoint: str) -> NewFilesRun:
    """Take the new bronze files of both tables into silver."""
    taken = NewFilesRun()
    take_new_files(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES, f"{checkpoint}/silver-approaches",
                   lambda batch, _: add_approaches(batch, lake), taken, "approaches")
    take_new_files(spark, lake.bronze_metadata, schemas.BRONZE_METADATA, f"{checkpoint}/silver-metadata",
                   lambda batch, _: add_metadata(batch, lake), taken, "metadata")
    return taken


def silver_integrity(spark: SparkSession, lake: Lake) -> DataFrame:
    """The integrity report of the complete silver tables."""
    return integrity_report(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES),
                            read_table(spark, lake.silver_metadata, schemas.SILVER_METADATA))
