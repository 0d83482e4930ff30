"""Incremental silver: nothing twice, nothing left behind, whichever days the two layers give a row."""

import datetime as dt

import pytest

from stratiform import schemas
from stratiform.functions.expr import to_id
from stratiform.operators.aggregates import summarize
from stratiform.operators.merge import lookup
from stratiform.operators.tables import SchemaMismatch, append_table, write_table
from stratiform.paths import Lake
from stratiform.plans.jobs import run_silver


def _bronze(spark, lake, rows):
    day = dt.datetime(2024, 1, 4)
    full = [(str(i), "x", day, ts, 1.0, 2.0, "Earth", False, day.date()) for i, ts in rows]
    write_table(spark.createDataFrame(full, schemas.BRONZE_APPROACHES), lake.bronze_approaches, mode="append",
                partition_by=schemas.APPROACHES_PARTITION)


def _lake(spark, scratch):
    lake = Lake(scratch("silver"))
    meta = [("1", "1 a", 1.0, 1.0, 2.0, False, False, "u")]
    write_table(spark.createDataFrame(meta, schemas.BRONZE_METADATA), lake.bronze_metadata)
    return lake


def test_rerun_adds_nothing_when_the_days_differ_or_are_null(spark, scratch):
    lake = _lake(spark, scratch)
    _bronze(spark, lake, [(1, dt.datetime(2024, 1, 3, 23, 50)), (2, dt.datetime(2024, 1, 4, 1, 0)), (3, None)])
    for _ in range(3):
        run_silver(spark, lake)
        assert spark.read.parquet(lake.silver_approaches).count() == 3


def test_backlog_is_taken_up_by_a_later_run(spark, scratch):
    lake = _lake(spark, scratch)
    _bronze(spark, lake, [(1, dt.datetime(2024, 1, 4, 1, 0))])
    run_silver(spark, lake)
    _bronze(spark, lake, [(2, dt.datetime(2024, 1, 20, 1, 0))])
    _bronze(spark, lake, [(3, dt.datetime(2024, 1, 30, 1, 0))])
    run_silver(spark, lake)
    assert sorted(r.id for r in spark.read.parquet(lake.silver_approaches).collect()) == [1, 2, 3]


def test_duplicate_catalog_answers_once(spark):
    catalog = spark.createDataFrame([("1", "b"), ("1", "a")], "id string, name string")
    ids = spark.createDataFrame([("1",), ("1",)], "id string")
    assert [tuple(r) for r in lookup(ids, catalog, distinct=True).collect()] == [("1", "a")]
    assert [tuple(r) for r in lookup(ids, catalog).collect()] == [("1", "a")] * 2


def test_append_without_the_partition_columns_is_refused(spark, scratch):
    path = scratch("layout")
    df = spark.createDataFrame([(1, "a")], "x int, day string")
    write_table(df, path, partition_by=["day"])
    with pytest.raises(SchemaMismatch):
        append_table(df, path)


def test_overwrite_may_read_the_table_it_replaces(spark, scratch):
    path = scratch("self")
    write_table(spark.range(5).toDF("x"), path)
    write_table(spark.read.parquet(path).where("x > 2"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [3, 4]


def test_strict_ids_raise_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not an identifier"):
            spark.createDataFrame([("abc",)], "id string").select(to_id("id")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_summarize_of_other_types(spark):
    df = spark.createDataFrame([(1, "b", 2**60 + 1, float("nan")), (1, "a", 5, 1.0)], "k int, s string, n bigint, d double")
    row = summarize(df, "k", [("lo", "s", "min"), ("hi", "n", "max"), ("c", "d", "count")]).first()
    assert (row.lo, row.hi, row.c) == ("a", 2**60 + 1, 1)
