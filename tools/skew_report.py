"""Measure how evenly tasks share the work when one id holds a third of all rows.

Runs the daily summary plans on sf0.1 approaches whose every third event is
re-keyed to one id, with Spark's event log written to a fresh scratch folder,
then reports per plan the largest share of shuffle records read by one task.

Usage: python tools/skew_report.py [sf_dir] > SKEW.md
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from stratiform import queries as Q  # noqa: E402
from stratiform.operators.aggregates import daily_summary, summarize  # noqa: E402
from stratiform.operators.merge import anti_by_keys  # noqa: E402
from stratiform.operators.transforms import transform_approaches  # noqa: E402
from stratiform.session import build_session  # noqa: E402
from stratiform.sources.standins import approaches_from_events, load  # noqa: E402

HOT = 7


def _join_then_group(a, m):
    """The literal form: join every approach with its metadata rows, then group by day."""
    meta = m.select("id", F.col("bajo_seguimiento_riesgo").cast("double").alias("bajo_seguimiento_riesgo"),
                    "diameter_max_km")
    return summarize(a.join(meta, "id", "left"), "fecha", [
        ("cantidad_aproximaciones", "id", "count"),
        ("velocidad_promedio_km_s", "relative_velocity_km_per_second", "mean"),
        ("cantidad_bajo_seguimiento_riesgo", "bajo_seguimiento_riesgo", "sum"),
        ("diametro_maximo_km", "diameter_max_km", "max"),
    ])


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = build_session(extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.eventLog.compress": "false",
                                 "spark.sql.adaptive.coalescePartitions.enabled": "false",
                                 # several input splits, as on a cluster (skew splitting groups map outputs)
                                 "spark.sql.files.maxPartitionBytes": str(256 * 1024),
                                 "spark.sql.shuffle.partitions": "16"})
    ev = load(spark, sf, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")))
    a = approaches_from_events(ev).transform(transform_approaches)
    m = Q._fanout_metadata(spark, sf)
    target = a.where((F.col("fecha") <= "2024-01-10") & (F.col("id") != HOT))
    runs = [
        ("join_then_group (sort-merge, no broadcast)", lambda: _join_then_group(a, m), "-1", {}),
        ("auto (measured broadcast of per-entity rows)", lambda: daily_summary(a, m, strategy="auto"), "32MB", {}),
        ("preaggregate (above the broadcast bound)", lambda: daily_summary(a, m, strategy="preaggregate"), "-1",
         {}),
        # pending/merge anti join keyed by id against a target lacking the hot id
        ("anti join, hot id not salted", lambda: anti_by_keys(a, target, ["id"], False, hot_key_rows=10 ** 12),
         "-1", {}),
        ("anti join, hot id salted (threshold 10k rows, 16 salts)",
         lambda: anti_by_keys(a, target, ["id"], False, hot_key_rows=10_000, salts=16), "-1", {}),
    ]
    for name, fn, threshold, extra in runs:
        saved = {k: spark.conf.get(k) for k in extra}
        for k, v in {**extra, "spark.sql.adaptive.autoBroadcastJoinThreshold": threshold}.items():
            spark.conf.set(k, v)
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
        for k, v in saved.items():
            spark.conf.set(k, v)
    spark.stop()
    _report(log_dir, [r[0] for r in runs])


def _report(log_dir, names):
    stage_group, tasks = {}, defaultdict(list)
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                kind = e.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    if rec:
                        tasks[e["Stage ID"]].append(rec)
    print("# Task balance with one id holding a third of the approaches\n")
    print("Generated by `python tools/skew_report.py` (sf0.1 events, every third event re-keyed to one id,")
    print("per-request metadata; 256 KB input splits; 16 shuffle partitions, not coalesced; Spark event log in a")
    print("fresh scratch folder). For every")
    print("shuffle-reading stage: tasks, records read in total, and the largest share one task read. The")
    print("broadcast threshold is off for the first and third plan so that they run as they would with")
    print("metadata too large to broadcast.\n")
    print("| plan | stage | tasks | records read | largest task share |")
    print("|---|---|---|---|---|")
    for name in names:
        for sid in sorted(s for s, g in stage_group.items() if g == name and s in tasks):
            recs = tasks[sid]
            print(f"| {name} | {sid} | {len(recs)} | {sum(recs)} | {max(recs) / sum(recs):.0%} |")


if __name__ == "__main__":
    main()
