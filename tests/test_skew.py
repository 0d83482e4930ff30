"""One id holding a third of all rows: results stay exact, hot groups collapse before shuffles."""

from pyspark.sql import functions as F

from conftest import SF_ORACLE
from stratiform import queries as Q
from stratiform.operators.aggregates import daily_summary
from stratiform.operators.quality import duplicate_keys, orphans_by_null
from stratiform.operators.transforms import transform_approaches
from stratiform.sources.standins import approaches_from_events

HOT = 7


def _skewed(spark):
    # test fixture: every third event is re-assigned to one hot id
    ev = Q.load(spark, SF_ORACLE, "events")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")))
    return approaches_from_events(ev).transform(transform_approaches)


def _bag(df):
    return sorted(tuple(r) for r in df.collect())


def test_hot_id_really_holds_a_third(spark):
    a = _skewed(spark)
    n, n_hot = a.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") == HOT, 1))).first()
    assert n_hot * 3 >= n


def test_strategies_agree_under_skew(spark):
    a = _skewed(spark)
    m = Q._fanout_metadata(spark, SF_ORACLE)  # the hot id is also duplicated in the metadata
    ref = _bag(daily_summary(a, m, strategy="join_first"))
    for strategy in ("preaggregate", "broadcast", "auto"):
        assert _bag(daily_summary(a, m, strategy=strategy)) == ref, strategy


def test_preaggregate_combines_before_the_first_shuffle(spark):
    a = _skewed(spark)
    m = Q.silver_metadata(spark, SF_ORACLE)
    plan = daily_summary(a, m, strategy="preaggregate")._jdf.queryExecution().executedPlan().toString()
    first_exchange = plan.rfind("Exchange hashpartitioning(fecha")
    assert "HashAggregate(keys=[fecha" in plan and "partial_count" in plan[first_exchange:]


def test_quality_reports_under_skew(spark):
    a = _skewed(spark)
    dups = duplicate_keys(a, ["id", "fecha"]).where(F.col("id") == HOT).agg(F.sum("n")).first()[0]
    assert dups == a.where(F.col("id") == HOT).count()
    m = Q.silver_metadata(spark, SF_ORACLE).where(F.col("id") != HOT)
    got = orphans_by_null(a, m).where(F.col("id") == HOT).first().orphan_rows
    assert got == a.where(F.col("id") == HOT).count()


def test_anti_join_salts_a_hot_batch_key(spark):
    from stratiform.operators.merge import anti_by_keys
    a = _skewed(spark)
    target = a.where(F.col("fecha") <= "2024-01-10")
    # key id: the hot id is the one hot key
    plain = _bag(anti_by_keys(a, target.where(F.col("id") != HOT), ["id"], False, hot_key_rows=10 ** 12))
    salted = anti_by_keys(a, target.where(F.col("id") != HOT), ["id"], False, hot_key_rows=100, salts=8)
    assert "__salt" in salted._jdf.queryExecution().optimizedPlan().toString()
    got = _bag(salted)
    assert got == plain and sum(1 for r in got if r[0] == HOT) == a.where(F.col("id") == HOT).count()
    # composite null-safe key, every key salted
    keys = ["id", "close_approach_date_full"]
    plain2 = _bag(anti_by_keys(a, target, keys, True, hot_key_rows=10 ** 12))
    assert _bag(anti_by_keys(a, target, keys, True, hot_key_rows=0, salts=4)) == plain2 and len(plain2) > 0


def test_lookup_shuffle_path_salts_a_hot_request(spark):
    from stratiform.operators.merge import lookup
    ids = _skewed(spark).select(F.col("id").cast("string").alias("id"))
    catalog = Q.bronze_metadata(spark, SF_ORACLE)
    broadcast = _bag(lookup(ids, catalog))
    shuffled = lookup(ids, catalog, max_bytes=0, hot_key_rows=100)
    assert "__salt" in shuffled._jdf.queryExecution().optimizedPlan().toString()
    assert _bag(shuffled) == broadcast and len(broadcast) == ids.count()
    assert _bag(lookup(ids, catalog, distinct=True, max_bytes=0)) == _bag(lookup(ids, catalog, distinct=True))
