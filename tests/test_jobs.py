"""Invariants of the layered jobs over two landed pulls (sf0.01)."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE as SF_SMALL  # sf0.001 has no orphans; sf0.01 does
from stratiform import schemas
from stratiform.operators.aggregates import daily_summary
from stratiform.operators.merge import pending_against
from stratiform.operators.quality import orphans_by_key
from stratiform.operators.transforms import transform_approaches
from stratiform.paths import Lake
from stratiform.plans import scenario
from stratiform.plans.jobs import ingest_bronze, reprocess_silver, run_silver
from stratiform.sources.landed import read_feed, read_table


def _bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_same_pull_twice_adds_nothing(spark, scratch):
    root = scratch("twice")
    lake = Lake(root)
    catalog = scenario.catalog_from(spark, scenario.land_lookups(spark, SF_SMALL, root, broken=False))
    feed = read_feed(spark, scenario.land_feed(spark, SF_SMALL, root, scenario.RUN2_REF))
    ingest_bronze(lake, feed, catalog)
    n_a = spark.read.parquet(lake.bronze_approaches).count()
    n_m = spark.read.parquet(lake.bronze_metadata).count()
    ingest_bronze(lake, feed, catalog)
    assert spark.read.parquet(lake.bronze_approaches).count() == n_a
    assert spark.read.parquet(lake.bronze_metadata).count() == n_m
    run_silver(spark, lake)
    n_s = spark.read.parquet(lake.silver_approaches).count()
    run_silver(spark, lake)
    assert spark.read.parquet(lake.silver_approaches).count() == n_s


def test_nothing_pending_after_silver(spark):
    lake = scenario.two_runs(spark, SF_SMALL)
    ba = read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES).transform(transform_approaches)
    assert pending_against(spark, ba, lake.silver_approaches, schemas.SILVER_APPROACHES_KEY).count() == 0


def test_reprocess_equals_incremental(spark, scratch):
    lake = scenario.two_runs(spark, SF_SMALL)
    out = Lake(scratch("re"))
    report = reprocess_silver(spark, lake, out).first()
    assert _bag(spark.read.parquet(out.silver_approaches)) == _bag(spark.read.parquet(lake.silver_approaches))
    assert _bag(spark.read.parquet(out.silver_metadata)) == _bag(spark.read.parquet(lake.silver_metadata))
    assert report.orphan_rows > 0  # the broken lookups left orphans


def test_gold_counts_equal_joined_rows(spark):
    lake = scenario.two_runs(spark, SF_SMALL)
    sa = spark.read.parquet(lake.silver_approaches)
    sm = spark.read.parquet(lake.silver_metadata)
    joined = sa.join(sm.select("id"), "id", "left").where(F.col("fecha").isNotNull()).count()
    gold = spark.read.parquet(lake.gold_daily_summary)
    assert gold.agg(F.sum("cantidad_aproximaciones")).first()[0] == joined
    assert _bag(gold) == _bag(daily_summary(sa, sm))


def test_run1_metadata_survives_run2(spark):
    """Regression: a later pull must never drop entities stored by an earlier one."""
    lake = scenario.two_runs(spark, SF_SMALL)
    bm = spark.read.parquet(lake.bronze_metadata)
    ids_run1 = read_feed(spark, f"{lake.root}/landing/feed-run1").selectExpr(
        "explode(map_values(near_earth_objects)) as objs").selectExpr("explode(objs) as o").select("o.id")
    catalog_ids = scenario.catalog_from(spark, f"{lake.root}/landing/lookups").select("id")
    expected = ids_run1.join(catalog_ids, "id", "left_semi").distinct()
    assert expected.join(bm, "id", "left_anti").count() == 0


def test_orphans_gone_after_recovery(spark):
    before = scenario.two_runs(spark, SF_SMALL)
    sa = spark.read.parquet(before.silver_approaches)
    assert orphans_by_key(sa, spark.read.parquet(before.silver_metadata)).count() > 0
    lake = scenario.recovered(spark, SF_SMALL)
    sa = spark.read.parquet(lake.silver_approaches)
    assert orphans_by_key(sa, spark.read.parquet(lake.silver_metadata)).count() == 0


def test_changed_transform_reaches_old_rows_only_through_reprocess(spark, scratch):
    """Regression: a new silver column is refused by the incremental append and
    applied to every old row by the reprocess (schema replaced)."""
    import pytest

    from stratiform.operators.tables import SchemaMismatch, append_table

    lake = scenario.two_runs(spark, SF_SMALL)
    out = Lake(scratch("schema"))
    reprocess_silver(spark, lake, out)
    old = spark.read.parquet(out.silver_metadata)
    n_old = old.count()
    widened = old.withColumn("diametro_medio_km", (F.col("diameter_min_km") + F.col("diameter_max_km")) / 2)
    with pytest.raises(SchemaMismatch):
        append_table(widened.limit(1), out.silver_metadata)
    from stratiform.operators.tables import write_table
    write_table(widened, out.silver_metadata, mode="overwrite", replace_schema=True)
    again = spark.read.parquet(out.silver_metadata)
    assert "diametro_medio_km" in again.columns and again.count() == n_old
