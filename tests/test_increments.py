"""Silver and gold that read only new files, and the stream that drops repeated rows."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from stratiform import queries as Q
from stratiform import schemas
from stratiform.operators.tables import write_table
from stratiform.paths import Lake
from stratiform.plans import scenario
from stratiform.plans.jobs import run_all_new, run_gold, run_silver
from stratiform.session import new_scratch_dir
from stratiform.sources.landed import read_feed, read_table
from stratiform.sources.standins import feed_documents, land_text
from stratiform.streaming import gold_increment, silver_stream
from stratiform.streaming.dedup_stream import ingest_unrepeated
from stratiform.streaming.gold_increment import run_gold_increment
from stratiform.streaming.silver_stream import add_approaches, run_silver_new_files


def bag(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def lake_with_bronze(spark, tag):
    root = new_scratch_dir(spark, tag)
    lake = Lake(root)
    write_table(Q.bronze_metadata(spark, SF_SMALL), lake.bronze_metadata)
    return lake, f"{root}/_checkpoints"


def land(spark, lake, condition):
    rows = Q.bronze_approaches(spark, SF_SMALL).where(condition)
    write_table(rows, lake.bronze_approaches, mode="append", partition_by=schemas.APPROACHES_PARTITION)
    return rows.count()


def _taken(checkpoint):
    """The files of all batches, from the checkpoint's log of the source."""
    folder, found = checkpoint.replace("file:", "") + "/sources/0", []
    for name in sorted(os.listdir(folder)):
        if not name.startswith("."):
            with open(f"{folder}/{name}") as f:
                found += [json.loads(line)["path"] for line in f if line.startswith("{")]
    return found


def test_each_run_reads_the_new_files_only(spark):
    lake, checkpoint = lake_with_bronze(spark, "new-files")
    seen = []
    for days in ((1, 10), (11, 12), (13, 31), None):
        n = land(spark, lake, F.dayofmonth("fecha").between(*days)) if days else 0
        run = run_silver_new_files(spark, lake, checkpoint)
        assert run.rows["approaches"] in ((n, 2 * n) if n else (0,))  # the extent of a batch is read first
        files = [f for f in _taken(f"{checkpoint}/silver-approaches") if f not in seen]  # the stream's own list
        assert bool(files) == bool(days)
        assert all(days[0] <= int(f.split("fecha=")[1][8:10]) <= days[1] for f in files)
        seen += files
    assert run.rows["metadata"] == 0
    assert bag(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)) == bag(Q.silver_approaches(spark, SF_SMALL))


def test_a_replayed_batch_adds_nothing(spark):
    lake, checkpoint = lake_with_bronze(spark, "replay")
    land(spark, lake, F.lit(True))
    run_silver_new_files(spark, lake, checkpoint)
    before = bag(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES))
    add_approaches(read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES), lake)
    run_silver_new_files(spark, lake, f"{checkpoint}-lost")  # a lost checkpoint takes all files again
    assert bag(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)) == before


def test_a_batch_that_fails_after_its_append_is_not_added_twice(spark, monkeypatch):
    lake, checkpoint = lake_with_bronze(spark, "failing")
    land(spark, lake, F.dayofmonth("fecha") < 15)
    run_silver_new_files(spark, lake, checkpoint)
    land(spark, lake, F.dayofmonth("fecha") >= 15)
    real = silver_stream.append_table

    def fails(*args, **kw):
        real(*args, **kw)
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(silver_stream, "append_table", fails)
    with pytest.raises(Exception, match="lost before the commit"):
        run_silver_new_files(spark, lake, checkpoint)
    monkeypatch.setattr(silver_stream, "append_table", real)
    run_silver_new_files(spark, lake, checkpoint)
    assert bag(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)) == bag(Q.silver_approaches(spark, SF_SMALL))


def test_rows_of_another_day_and_without_time(spark):
    """Silver's day is not bronze's; rows without a time match each other and are added once."""
    lake, checkpoint = lake_with_bronze(spark, "moved")
    full = F.col("close_approach_date_full")
    moved = F.when(F.col("orbiting_body") == "error", F.lit(None)).otherwise(full - F.expr("INTERVAL 3 DAY"))
    rows = Q.bronze_approaches(spark, SF_SMALL).withColumn("close_approach_date_full", moved)
    for day in (5, 31):
        write_table(rows.where(F.dayofmonth("fecha") <= day), lake.bronze_approaches, mode="append", partition_by=schemas.APPROACHES_PARTITION)
        run_silver_new_files(spark, lake, checkpoint)
    again = Lake(new_scratch_dir(spark, "moved-full"))
    write_table(Q.bronze_metadata(spark, SF_SMALL), again.bronze_metadata)
    for day in (5, 31):
        write_table(rows.where(F.dayofmonth("fecha") <= day), again.bronze_approaches, mode="append", partition_by=schemas.APPROACHES_PARTITION)
        run_silver(spark, again)
    assert bag(read_table(spark, lake.silver_approaches, schemas.SILVER_APPROACHES)) == bag(
        read_table(spark, again.silver_approaches, schemas.SILVER_APPROACHES))


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path.replace("file:", ""))
            for f in fs if f.endswith(".parquet")}


def test_gold_equals_the_full_recompute_and_writes_touched_days_only(spark):
    days = []
    lake = scenario.recovered_by_increment(spark, SF_ORACLE, days)
    run_gold(spark, lake)  # the whole history, from the same silver
    assert bag(read_table(spark, lake.gold_by_day, schemas.GOLD_DAILY_SUMMARY)) == bag(
        read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY))
    first, second, third = days
    assert first == [dt.date(2024, 1, d) for d in range(1, 18)]
    assert max(second) == dt.date(2024, 1, 30) and set(second) >= {dt.date(2024, 1, d) for d in range(18, 31)}
    assert third and set(third) <= set(first) | set(second)  # the days of the entities that were looked up again


def test_gold_leaves_other_days_files_alone(spark):
    lake, checkpoint = lake_with_bronze(spark, "touched")
    land(spark, lake, F.dayofmonth("fecha") <= 20)
    run_silver_new_files(spark, lake, checkpoint)
    assert len(run_gold_increment(spark, lake, checkpoint)) == 20
    before = _files(lake.gold_by_day)
    land(spark, lake, F.dayofmonth("fecha") == 25)
    run_silver_new_files(spark, lake, checkpoint)
    assert run_gold_increment(spark, lake, checkpoint) == [dt.date(2024, 1, 25)]
    after = _files(lake.gold_by_day)
    assert before.items() <= after.items() and all("2024-01-25" in f for f in after.keys() - before.keys())
    assert run_gold_increment(spark, lake, checkpoint) == []


def test_gold_batch_that_fails_is_taken_again(spark, monkeypatch):
    lake, checkpoint = lake_with_bronze(spark, "gold-failing")
    land(spark, lake, F.lit(True))
    run_silver_new_files(spark, lake, checkpoint)
    real = gold_increment.refresh_summaries

    def fails(*args):
        raise RuntimeError("lost before gold")

    monkeypatch.setattr(gold_increment, "refresh_summaries", fails)
    with pytest.raises(Exception, match="lost before gold"):
        run_gold_increment(spark, lake, checkpoint)
    monkeypatch.setattr(gold_increment, "refresh_summaries", real)
    run_gold_increment(spark, lake, checkpoint)
    run_gold(spark, lake)
    assert bag(read_table(spark, lake.gold_by_day, schemas.GOLD_DAILY_SUMMARY)) == bag(
        read_table(spark, lake.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY))


def test_run_all_new_equals_run_all(spark):
    root = new_scratch_dir(spark, "all-new")
    lake = Lake(root)
    catalog = scenario.catalog_from(spark, scenario.land_lookups(spark, SF_SMALL, root, broken=True))
    for run in (1, 2):
        result = run_all_new(spark, lake, read_feed(spark, scenario.land_delivery(spark, SF_SMALL, root, run)), catalog, f"{root}/_checkpoints")
    whole = scenario.two_runs(spark, SF_SMALL, tag="all-full")
    assert bag(read_table(spark, lake.gold_by_day, schemas.GOLD_DAILY_SUMMARY)) == bag(
        read_table(spark, whole.gold_daily_summary, schemas.GOLD_DAILY_SUMMARY))
    assert result.integrity.first() == run_silver(spark, whole).first()


# --- rows repeated by overlapping pulls ------------------------------------------------

def _feed(spark, landing, events):
    feed_documents(events).write.mode("append").text(landing)


def test_state_drops_repeats_across_a_restart_and_stays_bounded(spark):
    root = new_scratch_dir(spark, "dedup")
    lake, landing, checkpoint = Lake(root), f"{root}/landing", f"{root}/_checkpoint"
    events = Q.load(spark, SF_SMALL, "events")
    held, seen = [], []
    for lo, hi in ((1, 7), (4, 10), (7, 13), (10, 16), (24, 30)):  # each pull reaches back
        part = events.where(F.dayofmonth("ts").between(lo, hi))
        _feed(spark, landing, part)
        run = ingest_unrepeated(spark, landing, lake, checkpoint)
        held.append(run.state_rows)
        seen.append((run.rows_out, part.count(), run.late_rows))
    assert seen[0][0] == seen[0][1] and all(out < n for out, n, _ in seen[1:4])
    assert not any(late for *_, late in seen)
    assert held[-1] <= events.where(F.dayofmonth("ts") >= 15).count()  # the delay before the newest row, not the history


def test_late_rows_are_taken_by_the_batch_merge(spark):
    root = new_scratch_dir(spark, "dedup-late")
    lake, landing, checkpoint = Lake(root), f"{root}/landing", f"{root}/_checkpoint"
    events = Q.load(spark, SF_SMALL, "events")
    for lo, hi in ((20, 25), (26, 27), (1, 5)):
        _feed(spark, landing, events.where(F.dayofmonth("ts").between(lo, hi)))
        run = ingest_unrepeated(spark, landing, lake, checkpoint)
    assert run.late_rows > 0
    days = {r[0].day for r in read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES).select("fecha").distinct().collect()}
    assert days == {*range(1, 6), *range(20, 28)}
    stored = read_table(spark, lake.bronze_approaches, schemas.BRONZE_APPROACHES).where(F.dayofmonth("fecha") <= 5)
    assert stored.count() == stored.distinct().count() > 0
