"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]: one warm-up, then the median of 3 timed runs.  Each run
executes the whole plan into the no-op sink (nothing is collected).  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratiform import queries as Q  # noqa: E402
from stratiform.operators.aggregates import daily_summary  # noqa: E402
from stratiform.plans import scenario  # noqa: E402
from stratiform.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _daily_join_first(spark, sf):
    return daily_summary(Q.silver_approaches(spark, sf), Q.silver_metadata(spark, sf), strategy="join_first")


def _daily_preagg(spark, sf):
    return daily_summary(Q.silver_approaches(spark, sf), Q.silver_metadata(spark, sf), strategy="preaggregate")


def _daily_fanout_preagg(spark, sf):
    return daily_summary(Q.silver_approaches(spark, sf), Q._fanout_metadata(spark, sf), strategy="preaggregate")


_fresh = [0]


def _two_run_jobs(spark, sf):
    """The whole job chain (land, bronze, silver, gold for two pulls), fresh each time."""
    _fresh[0] += 1
    lake = scenario.two_runs(spark, sf, tag=f"bench-{_fresh[0]}")
    return spark.read.parquet(lake.gold_daily_summary)


BENCH = {
    "daily_summary": Q.q_daily_summary,
    "daily_summary_join_first": _daily_join_first,
    "daily_summary_preaggregate": _daily_preagg,
    "daily_summary_fanout_preaggregate": _daily_fanout_preagg,
    "daily_summary_fanout": Q.q_daily_summary_fanout,
    "join_left_fanout": Q.q_join_left_fanout,
    "silver_approaches": Q.q_silver_approaches,
    "silver_metadata": Q.q_silver_metadata,
    "dup_keys": Q.q_dup_keys,
    "null_profile": Q.q_null_profile,
    "orphans_by_key": Q.q_orphans_by_key,
    "feed_flatten": Q.q_feed_flatten,
    "lookup_flatten": Q.q_lookup_flatten,
    "pending_by_key": Q.q_pending_by_key,
    "merge_insert_by_day": Q.q_merge_insert_by_day,
    "merge_insert_by_ts": Q.q_merge_insert_by_ts,
    "two_run_jobs": _two_run_jobs,
}


def _run(spark, fn) -> float:
    t0 = time.perf_counter()
    fn(spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g"})
    only = set(sys.argv[1:])
    results = {}
    for name, fn in BENCH.items():
        if only and name not in only:
            continue
        _run(spark, fn)  # warm-up
        results[name] = round(statistics.median(_run(spark, fn) for _ in range(RUNS)), 3)
    spark.stop()
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf}))


if __name__ == "__main__":
    main()
