"""Results do not depend on session settings (time zone, AQE, ANSI, partitions)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from test_oracles import TABLES, _bag

OTHER = {"spark.sql.session.timeZone": "America/Los_Angeles", "spark.sql.adaptive.enabled": "false",
         "spark.sql.ansi.enabled": "false", "spark.sql.shuffle.partitions": "50"}
NAMES = ["daily_summary", "window_7d", "cast_timestamp", "date_hour_split", "feed_flatten",
         "merge_insert_by_day", "pending_by_key", "partition_roundtrip"]


@pytest.fixture()
def other_session(spark):
    saved = {k: spark.conf.get(k) for k in OTHER}
    for k, v in OTHER.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_same_results_under_other_settings(other_session):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    for name in NAMES:
        df = entry.queries()[name](other_session, SF_SMALL)
        res = con.execute(entry.oracle_sql()[name])
        ocols = [d[0] for d in res.description]
        assert _bag(df.columns, [tuple(r) for r in df.collect()]) == _bag(ocols, res.fetchall()), name
