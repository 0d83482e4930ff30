"""Command-line entry for the jobs (``spark-submit -m``-style or ``python -m stratiform.plans.cli``).

    run        land-to-gold for one pull: bronze ingest, incremental silver, gold; ``--new-files`` reads only
               new files of each layer and writes the days they touch, ``--report`` shows what the writes counted
    follow     take new bronze files into silver and the days they touch into gold, without a pull
    diff       days on which silver approaches differ from those of another lake
    silver     incremental silver only (compares all days)
    gold       recompute the daily summary
    reprocess  rebuild silver from all of bronze, replacing the schema
    recover    look up orphan entities (derived, or ``--ids``) and merge them into bronze
    migrate    copy tables to a new layout: ``--move name=old_path,new_path[,part_col...]``
    inspect    row counts per layer, first rows, column types, integrity
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from stratiform import schemas
from stratiform.operators.aggregates import layer_counts
from stratiform.operators.fingerprints import layer_diff
from stratiform.operators.inspect import column_types, peek
from stratiform.operators.nested import flatten_lookups
from stratiform.operators.observed import WriteLog
from stratiform.operators.quality import integrity_report
from stratiform.operators.tables import Move, migrate_layout
from stratiform.paths import Lake
from stratiform.plans.jobs import recover_orphans, reprocess_silver, run_all, run_all_new, run_gold, run_silver
from stratiform.session import DEFAULT_CONF
from stratiform.sources.landed import literal_ids, read_feed, read_lookup_documents, table_or_empty
from stratiform.streaming.gold_increment import run_gold_increment
from stratiform.streaming.silver_stream import run_silver_new_files

TABLES = {
    ("bronze", "approaches"): ("bronze_approaches", schemas.BRONZE_APPROACHES, ["close_approach_date", "id"]),
    ("bronze", "metadata"): ("bronze_metadata", schemas.BRONZE_METADATA, ["id"]),
    ("silver", "approaches"): ("silver_approaches", schemas.SILVER_APPROACHES, ["close_approach_date_full", "id"]),
    ("silver", "metadata"): ("silver_metadata", schemas.SILVER_METADATA, ["id"]),
    ("gold", "daily_summary"): ("gold_daily_summary", schemas.GOLD_DAILY_SUMMARY, ["fecha"]),
}


def _catalog(spark, path):
    parsed, _ = read_lookup_documents(spark, path)
    return flatten_lookups(parsed)


def _parse_move(text: str) -> Move:
    name, rest = text.split("=", 1)
    old, new, *parts = rest.split(",")
    return Move(name, old, new, tuple(parts) or None)


def main(argv=None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stratiform")
    ap.add_argument("--root", required=True, help="lake root (object-store or file URI)")
    ap.add_argument("--source", default="neo_feed", help="source folder under each layer")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run")
    r.add_argument("--feed", required=True, help="landed feed documents of this pull")
    r.add_argument("--lookups", required=True, help="landed lookup documents")
    r.add_argument("--multi-line", action="store_true", help="one document per file")
    r.add_argument("--distinct-lookups", action="store_true")
    how = r.add_mutually_exclusive_group()
    how.add_argument("--new-files", action="store_true", help="incremental form, checkpoints under the lake root")
    how.add_argument("--report", action="store_true", help="rows and NULLs of every table written")
    sub.add_parser("follow")
    d = sub.add_parser("diff")
    d.add_argument("--other", required=True, help="root of the other lake")
    sub.add_parser("silver")
    sub.add_parser("gold")
    sub.add_parser("reprocess")
    rc = sub.add_parser("recover")
    rc.add_argument("--lookups", required=True)
    rc.add_argument("--ids", help="comma-separated ids; default: orphans found in silver")
    m = sub.add_parser("migrate")
    m.add_argument("--move", action="append", required=True)
    i = sub.add_parser("inspect")
    i.add_argument("--rows", type=int, default=5)
    args = ap.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"stratiform-{args.cmd}").getOrCreate()
    for name, value in DEFAULT_CONF.items():  # a submitted session plans as the library's own
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            spark.conf.set(name, value)
    lake = Lake(args.root, args.source)
    checkpoint = f"{args.root.rstrip('/')}/_checkpoints/{args.source}"
    if args.cmd == "run":
        feed, catalog = read_feed(spark, args.feed, args.multi_line), _catalog(spark, args.lookups)
        log = WriteLog() if args.report else None
        res = (run_all_new(spark, lake, feed, catalog, checkpoint, args.distinct_lookups) if args.new_files
               else run_all(spark, lake, feed, catalog, args.distinct_lookups, log))
        res.integrity.show()
        if log is not None:
            log.report(spark).show(200, truncate=False)
    elif args.cmd == "follow":
        run_silver_new_files(spark, lake, checkpoint)
        print("days written:", *run_gold_increment(spark, lake, checkpoint))
    elif args.cmd == "diff":
        here, there = (table_or_empty(spark, x.silver_approaches, schemas.SILVER_APPROACHES) for x in (lake, Lake(args.other, args.source)))
        layer_diff(here, there).orderBy("fecha").show(200, truncate=False)
    elif args.cmd == "silver":
        run_silver(spark, lake).show()
    elif args.cmd == "gold":
        run_gold(spark, lake)
    elif args.cmd == "reprocess":
        reprocess_silver(spark, lake).show()
    elif args.cmd == "recover":
        ids = literal_ids(spark, [int(x) for x in args.ids.split(",")]) if args.ids else None
        recover_orphans(spark, lake, _catalog(spark, args.lookups), ids)
    elif args.cmd == "migrate":
        migrate_layout(spark, [_parse_move(t) for t in args.move]).show(truncate=False)
    elif args.cmd == "inspect":
        frames = {k: table_or_empty(spark, getattr(lake, attr), schema) for k, (attr, schema, _) in TABLES.items()}
        layer_counts(frames).show(truncate=False)
        for (layer, table), (_, _, order) in TABLES.items():
            print(f"== {layer}/{table}")
            peek(frames[(layer, table)], order, args.rows).show(truncate=False)
            column_types(frames[(layer, table)]).show(truncate=False)
        integrity_report(frames[("silver", "approaches")], frames[("silver", "metadata")]).show()
    return 0


if __name__ == "__main__":
    sys.exit(main())
