"""Overlapping pulls de-duplicated by stream state before the merge.

A pull repeats what the pulls before it delivered.  The landed feed is read as a stream; a row
delivered again within the watermark delay is dropped by state kept in RocksDB on local disk and in the
checkpoint, so bronze is compared only with rows that are new.  State holds the rows of
the last ``delay`` before the newest one seen, whatever the history.  Each micro-batch is merged insert-only,
which makes a replayed batch add nothing.

A row older than the watermark is passed over by the stateful step.  The stream reports how many; if any,
the landed rows up to the watermark are merged by a batch job, so late rows are taken whenever they arrive.  The delay has to
cover the days that a pull reaches back (seven), else every pull takes that way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform import schemas
from stratiform.operators.merge import insert_only_merge
from stratiform.operators.nested import flatten_feed
from stratiform.paths import Lake
from stratiform.sources.landed import read_feed
from stratiform.streaming.feed_stream import feed_stream

DELAY = "8 days"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass
class DedupRun:
    rows_out: int = 0  # rows that went to the merge
    state_rows: int = 0  # rows held in state at the end
    late_rows: int = 0  # rows older than the watermark, taken by the batch job


def _merge(rows: DataFrame, lake: Lake) -> None:
    insert_only_merge(rows, lake.bronze_approaches, schemas.BRONZE_APPROACHES_KEY, partition_by=schemas.APPROACHES_PARTITION,
                      prune_on="fecha", schema=schemas.BRONZE_APPROACHES)


def unrepeated(approaches: DataFrame, delay: str = DELAY) -> DataFrame:
    """Streamed approaches without the rows that an earlier one within ``delay`` equals in every column.

    The event time is the approach's full time, or its day.
    """
    timed = approaches.withColumn("_event", F.coalesce("close_approach_date_full", "close_approach_date").cast("timestamp"))
    return timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark(approaches.columns).drop("_event")


def ingest_unrepeated(spark: SparkSession, landing_dir: str, lake: Lake, checkpoint: str, delay: str = DELAY) -> DedupRun:
    """Take every landed document not taken yet into bronze approaches, then stop."""
    run = DedupRun()

    def each(batch: DataFrame, _: int) -> None:
        rows = batch.persist()
        try:
            n = rows.count()
            if n:
                run.rows_out += n
                _merge(rows, lake)
        finally:
            rows.unpersist()

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        query = (unrepeated(flatten_feed(feed_stream(spark, landing_dir)), delay)
                 .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)
    progress = query.recentProgress
    states = [s for p in progress for s in p["stateOperators"]]
    run.late_rows = sum(s["numRowsDroppedByWatermark"] for s in states)
    run.state_rows = states[-1]["numRowsTotal"] if states else 0
    if run.late_rows:
        mark = max(p["eventTime"]["watermark"] for p in progress if "watermark" in p.get("eventTime", {}))
        event = F.coalesce("close_approach_date_full", "close_approach_date")
        late = flatten_feed(read_feed(spark, landing_dir)).where(event.isNull() | (event <= F.lit(mark).cast("timestamp").cast("timestamp_ntz")))
        _merge(late.distinct(), lake)
    return run
