import json

import pytest

from stratiform.operators.inspect import column_types, peek
from stratiform.paths import Lake, TablePath
from stratiform.sources.landed import literal_ids, read_feed, table_or_empty


def test_table_path_template():
    assert str(TablePath("s3a://bucket/lake", "silver", "neo_feed", "approaches")) == \
        "s3a://bucket/lake/silver/neo_feed/approaches"
    with pytest.raises(ValueError):
        TablePath("/r", "platinum", "s", "t")
    lake = Lake("/r/")
    assert lake.gold_daily_summary == "/r/gold/neo_feed/daily_summary"


def test_feed_read_fails_fast_on_a_broken_document(spark, tmp_path):
    p = tmp_path / "feed"
    p.mkdir()
    (p / "part-0.json").write_text(json.dumps({"element_count": 0, "near_earth_objects": {}}) + "\n{\"element_c\n")
    with pytest.raises(Exception):
        read_feed(spark, str(p)).collect()


def test_literal_ids_and_column_types(spark):
    ids = literal_ids(spark, [3, 1, 2])
    assert ids.dtypes == [("id", "bigint")]
    assert [r.id for r in peek(ids, ["id"], 2).collect()] == [1, 2]
    types = {r.column: r.type for r in column_types(ids).collect()}
    assert types == {"id": "bigint"}


def test_table_or_empty_missing(spark, tmp_path):
    df = table_or_empty(spark, str(tmp_path / "nope"), literal_ids(spark, [1]).schema)
    assert df.count() == 0


def test_recovery_with_literal_ids(spark, scratch):
    from stratiform.paths import Lake
    from stratiform.plans.jobs import recover_orphans
    lake = Lake(scratch("lit"))
    catalog = spark.createDataFrame(
        [("1", "(A)", 1.0, 1.0, 2.0, False, False, "u/1"), ("2", "(B)", 1.0, 1.0, 2.0, True, False, "u/2")],
        "id string, name string, absolute_magnitude_h double, diameter_min_km double, diameter_max_km double, "
        "is_potentially_hazardous boolean, is_sentry_object boolean, nasa_jpl_url string")
    recover_orphans(spark, lake, catalog, ids=literal_ids(spark, [2, 5]))
    assert [r.id for r in spark.read.parquet(lake.bronze_metadata).collect()] == ["2"]
