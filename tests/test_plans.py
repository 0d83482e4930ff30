"""Plan shape: no Python in any plan, scans read only what they need."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from stratiform import queries as Q
from stratiform.plans import jobs, scenario
from stratiform.plans.jobs import run_silver


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_no_python_in_plan(spark, name):
    """No node that hands rows to a Python worker: their names hold Python, Pandas or Arrow."""
    plan = _plan(Q.QUERIES[name](spark, SF_SMALL))
    for marker in ("Python", "Pandas", "InArrow", "ArrowEval"):
        assert marker not in plan, f"{name}: {marker}"


def test_window_filter_reaches_scan(spark):
    plan = _plan(Q.q_window_7d(spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan


def test_pending_reads_only_target_keys(spark):
    plan = _plan(Q.q_pending_by_key(spark, SF_SMALL))
    assert "ReadSchema: struct<id:bigint,close_approach_date_full:timestamp_ntz>" in plan


def test_partitioned_read_prunes_folders(spark):
    """A filter on the day lists and reads the files of those days only."""
    stored = Q.q_partition_roundtrip(spark, SF_SMALL)
    days = stored.where(F.col("fecha").between(dt.date(2024, 1, 3), dt.date(2024, 1, 4)))
    assert "PartitionFilters: [isnotnull(fecha" in _plan(days)
    assert days.count() == stored.where(F.dayofmonth("fecha").isin(3, 4)).count() > 0
    assert {f.split("fecha=")[1][:10] for f in days.select("id", F.input_file_name().alias("f")).toPandas()["f"]} == {"2024-01-03", "2024-01-04"}


def test_silver_run_reads_only_keys_of_silver(spark, monkeypatch):
    """What ``run_silver`` compares: all of bronze with the key columns of silver."""
    lake = scenario.two_runs(spark, SF_SMALL, tag="plan-of-silver")
    plans = []
    monkeypatch.setattr(jobs, "append_table", lambda df, *a, **k: plans.append(_plan(df)))
    monkeypatch.setattr(jobs, "_append_or_create", lambda df, *a, **k: plans.append(_plan(df)))
    run_silver(spark, lake)
    assert "ReadSchema: struct<id:bigint,close_approach_date_full:timestamp_ntz>" in plans[0]
    assert "ReadSchema: struct<id:bigint>" in plans[1]


def test_projection_pruned(spark):
    plan = _plan(Q.q_date_hour_split(spark, SF_SMALL))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "fecha" and df.count() > 0
