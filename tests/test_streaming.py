"""The stream form of the repeated pull survives reruns and a lost checkpoint."""

from conftest import SF_SMALL
from stratiform import queries as Q
from stratiform.paths import Lake
from stratiform.plans import scenario
from stratiform.sources.standins import feed_documents
from stratiform.streaming.feed_stream import ingest_available


def test_stream_rerun_and_lost_checkpoint_add_nothing(spark, scratch):
    root = scratch("stream-t")
    lake = Lake(root)
    landing = f"{root}/landing/feed"
    catalog = scenario.catalog_from(spark, scenario.land_lookups(spark, SF_SMALL, root, broken=False))
    for run in (1, 2):
        feed_documents(Q._run_events(spark, SF_SMALL, run)).write.mode("append").text(landing)
        ingest_available(spark, landing, lake, catalog, f"{root}/_ck/a")
    n_a = spark.read.parquet(lake.bronze_approaches).count()
    n_m = spark.read.parquet(lake.bronze_metadata).count()
    ingest_available(spark, landing, lake, catalog, f"{root}/_ck/a")  # nothing new landed
    ingest_available(spark, landing, lake, catalog, f"{root}/_ck/b")  # checkpoint lost: replay all files
    assert spark.read.parquet(lake.bronze_approaches).count() == n_a
    assert spark.read.parquet(lake.bronze_metadata).count() == n_m
