import datetime as dt

import pytest

from stratiform.operators import merge
from stratiform.operators.joins import fits_broadcast
from stratiform.operators.merge import insert_only_merge, lookup, pending_against, pending_rows
from stratiform.operators.tables import SchemaMismatch, write_table
from stratiform.plans import scenario
from stratiform.sources.landed import read_table, table_or_empty

SCHEMA = "id bigint, ts timestamp_ntz, v double, fecha date"
T = dt.datetime


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _df(spark, rows):
    return spark.createDataFrame([(i, ts, v, ts.date() if ts else None) for i, ts, v in rows], SCHEMA)


def test_merge_creates_then_inserts_only_new_keys(spark, scratch):
    path = f"{scratch('m')}/t"
    base = _df(spark, [(1, T(2024, 1, 1, 1), 1.0), (2, T(2024, 1, 1, 2), 2.0)])
    insert_only_merge(base, path, ["id", "ts"], partition_by=["fecha"])
    batch = _df(spark, [(2, T(2024, 1, 1, 2), 99.0), (3, T(2024, 1, 2, 3), 3.0)])
    insert_only_merge(batch, path, ["id", "ts"], partition_by=["fecha"])
    got = read_table(spark, path, None).select("id", "v").collect()
    assert sorted(tuple(r) for r in got) == [(1, 1.0), (2, 2.0), (3, 3.0)]  # matched row not updated


def test_merge_twice_adds_nothing(spark, scratch):
    path = f"{scratch('m')}/t"
    batch = _df(spark, [(1, T(2024, 1, 1, 1), 1.0), (2, T(2024, 1, 1, 2), 2.0)])
    insert_only_merge(batch, path, ["id", "ts"])
    insert_only_merge(batch, path, ["id", "ts"])
    assert spark.read.parquet(path).count() == 2


def test_merge_inserts_source_duplicates_unless_asked(spark, scratch):
    dup = _df(spark, [(1, T(2024, 1, 1, 1), 1.0), (1, T(2024, 1, 1, 1), 1.0)])
    p1 = f"{scratch('m')}/a"
    insert_only_merge(_df(spark, [(9, T(2024, 1, 1), 0.0)]), p1, ["id", "ts"])
    insert_only_merge(dup, p1, ["id", "ts"])
    assert spark.read.parquet(p1).count() == 3
    p2 = f"{scratch('m')}/b"
    insert_only_merge(_df(spark, [(9, T(2024, 1, 1), 0.0)]), p2, ["id", "ts"])
    insert_only_merge(dup, p2, ["id", "ts"], dedup_source=True)
    assert spark.read.parquet(p2).count() == 2


def test_merge_null_keys_never_match(spark, scratch):
    path = f"{scratch('m')}/t"
    batch = _df(spark, [(1, None, 1.0)])
    insert_only_merge(batch, path, ["id", "ts"])
    insert_only_merge(batch, path, ["id", "ts"])
    assert spark.read.parquet(path).count() == 2  # SQL '=' does not match NULL
    insert_only_merge(batch, path, ["id", "ts"], null_safe=True)
    assert spark.read.parquet(path).count() == 2


def test_merge_with_partition_pruning_same_result(spark, scratch):
    base = _df(spark, [(1, T(2024, 1, 1, 1), 1.0), (2, T(2024, 1, 5, 2), 2.0)])
    batch = _df(spark, [(2, T(2024, 1, 5, 2), 2.0), (3, T(2024, 1, 6, 3), 3.0)])
    outs = []
    for prune in (None, "fecha"):
        path = f"{scratch('m')}/t"
        insert_only_merge(base, path, ["id", "ts"], partition_by=["fecha"])
        insert_only_merge(batch, path, ["id", "ts"], partition_by=["fecha"], prune_on="fecha")
        outs.append(_rows(spark.read.parquet(path).select("id", "ts", "v")))
    assert outs[0] == outs[1] and len(outs[0]) == 3


def test_merge_rejects_changed_schema(spark, scratch):
    path = f"{scratch('m')}/t"
    insert_only_merge(_df(spark, [(1, T(2024, 1, 1), 1.0)]), path, ["id"])
    other = spark.createDataFrame([(1, "x")], "id bigint, v string")
    with pytest.raises(SchemaMismatch):
        insert_only_merge(other, path, ["id"])


def test_overwrite_schema_guard_and_replace(spark, scratch):
    path = f"{scratch('w')}/t"
    write_table(spark.createDataFrame([(1,)], "a bigint"), path)
    with pytest.raises(SchemaMismatch):
        write_table(spark.createDataFrame([(1, 2)], "a bigint, b bigint"), path)
    write_table(spark.createDataFrame([(1, 2)], "a bigint, b bigint"), path, replace_schema=True)
    assert spark.read.parquet(path).columns == ["a", "b"]


def test_pending_is_null_safe(spark):
    batch = _df(spark, [(1, None, 1.0), (2, T(2024, 1, 1), 2.0), (3, T(2024, 1, 1), 3.0)])
    target = _df(spark, [(1, None, 0.0), (2, T(2024, 1, 1), 0.0)])
    assert [r.id for r in pending_rows(batch, target, ["id", "ts"]).collect()] == [3]
    strict = pending_rows(batch, target, ["id", "ts"], null_safe=False)
    assert sorted(r.id for r in strict.collect()) == [1, 3]


def test_pending_against_missing_target_is_everything(spark, scratch):
    batch = _df(spark, [(1, T(2024, 1, 1), 1.0)])
    assert pending_against(spark, batch, f"{scratch('p')}/none", ["id"]).count() == 1
    empty = table_or_empty(spark, f"{scratch('p')}/none", batch.schema)
    assert empty.count() == 0 and empty.schema == batch.schema


def test_lookup_per_request_and_distinct(spark):
    ids = spark.createDataFrame([("1",), ("1",), ("2",), ("3",)], "id string")
    cat = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, name string")
    assert sorted(r.id for r in lookup(ids, cat).collect()) == ["1", "1", "2"]
    assert sorted(r.id for r in lookup(ids, cat, distinct=True).collect()) == ["1", "2"]


def test_empty_batch_creates_table_then_merges(spark, scratch):
    path = f"{scratch('m')}/t"
    insert_only_merge(_df(spark, []), path, ["id", "ts"], partition_by=["fecha"])
    assert pending_against(spark, _df(spark, [(1, T(2024, 1, 1), 1.0)]), path, ["id", "ts"]).count() == 1
    insert_only_merge(_df(spark, [(1, T(2024, 1, 1), 1.0)]), path, ["id", "ts"], partition_by=["fecha"])
    insert_only_merge(_df(spark, [(1, T(2024, 1, 1), 1.0)]), path, ["id", "ts"], partition_by=["fecha"])
    assert spark.read.parquet(path).count() == 1


def test_overwrite_from_itself_is_safe(spark, scratch):
    from pyspark.sql import functions as F
    path = f"{scratch('self')}/t"
    write_table(spark.range(5).withColumn("x", F.col("id") * 2), path)
    df = spark.read.parquet(path)
    write_table(df.withColumn("x", F.col("x") + 1), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 3, 5, 7, 9]


def test_first_row_per_key_is_deterministic(spark):
    from stratiform.operators.merge import first_row_per_key
    df = spark.createDataFrame([(1, "b", 2.0), (1, "a", 9.0), (1, "a", 3.0), (2, None, 1.0)],
                               "k bigint, s string, v double")
    assert sorted(tuple(r) for r in first_row_per_key(df, ["k"]).collect()) == [(1, "a", 3.0), (2, None, 1.0)]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_kv_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 3)), max_size=12)


def _model(base, batch, null_safe, dedup):
    def match(a, b):
        return a == b if null_safe else (a is not None and a == b)
    if dedup:
        seen = {}
        for r in sorted(batch, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
            seen.setdefault(r[0], r)
        batch = list(seen.values())
    return sorted(base + [r for r in batch if not any(match(r[0], t[0]) for t in base)],
                  key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(base=_kv_rows, batch=_kv_rows, null_safe=st.booleans(), dedup=st.booleans())
def test_merge_matches_a_python_model(spark, scratch, base, batch, null_safe, dedup):
    schema = "k bigint, v bigint"
    path = f"{scratch('prop')}/t"
    insert_only_merge(spark.createDataFrame(base, schema), path, ["k"])
    insert_only_merge(spark.createDataFrame(batch, schema), path, ["k"], null_safe=null_safe, dedup_source=dedup)
    got = sorted((tuple(r) for r in spark.read.parquet(path).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == _model(base, batch, null_safe, dedup)


def test_repeated_target_keys_are_measured_once_each(spark, monkeypatch):
    """A target that holds each of a few keys many times is broadcast; its rows are not what is sent."""
    monkeypatch.setattr(merge, "fits_broadcast", lambda df: fits_broadcast(df, 1_000))
    target = spark.createDataFrame([(i % 10, float(i)) for i in range(400)] + [(None, 0.0)], "id bigint, v double")
    batch = spark.createDataFrame([(5, "a"), (11, "b"), (None, "c"), (11, "d")], "id bigint, w string")
    fresh = merge.anti_by_keys(batch, target, ["id"], null_safe=False, measure_target=True)
    assert "BroadcastHashJoin" in fresh._jdf.queryExecution().executedPlan().toString()
    assert _rows(fresh) == [(11, "b"), (11, "d"), (None, "c")]
    assert _rows(merge.anti_by_keys(batch, target, ["id"], null_safe=True, measure_target=True)) == [(11, "b"), (11, "d")]


def test_catalog_is_parsed_once(spark, scratch):
    """What the runs read is the parsed table, broken answers left out."""
    path = f"{scratch('lookups')}/landed"
    spark.createDataFrame([('{"id":"1","name":"one"}',), ('{"id":"2","na',), ('{"id":"3","name":"three"}',)], "value string").write.text(path)
    catalog = scenario.catalog_from(spark, path)
    assert "parse_json" not in catalog._jdf.queryExecution().toString().lower()
    assert [(r["id"], r["name"]) for r in catalog.orderBy("id").collect()] == [("1", "one"), ("3", "three")]
