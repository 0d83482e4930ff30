from stratiform.operators.quality import (
    duplicate_keys, integrity_report, name_lossless, null_profile, orphans_by_key, orphans_by_null,
)


def test_orphans_by_null_counts_rows_and_null_partners(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (3,), (3,), (4,)], "id bigint")
    m = spark.createDataFrame([(1, 5.0), (3, None), (3, None), (3, 1.0), (4, 2.0)],
                              "id bigint, diameter_min_km double")
    # id 2: no partner (1 row); id 3: 2 left rows x 2 partners without the value = 4 joined rows
    assert sorted(tuple(r) for r in orphans_by_null(a, m).collect()) == [(2, 1), (3, 4)]
    a = spark.createDataFrame([(1,), (1,), (2,), (3,)], "id bigint")
    m = spark.createDataFrame([(1, 5.0), (3, None)], "id bigint, diameter_min_km double")
    assert sorted(r.id for r in orphans_by_key(a, m).collect()) == [2]
    r = integrity_report(a, m).first()
    assert (r.orphan_rows, r.orphan_ids) == (2, 2)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "d"), (1, "d"), (2, "d")], "id bigint, day string")
    assert [tuple(r) for r in duplicate_keys(df, ["id", "day"]).collect()] == [(1, "d", 2)]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a bigint, b string")
    got = {r.column: (r.nulls, r.rows) for r in null_profile(df).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}


def test_name_lossless(spark):
    df = spark.createDataFrame([(1, "433 Eros (A898 PA)"), (2, "(2020 AB)"), (3, "2021"), (4, None)],
                               "id bigint, name string")
    assert sorted(r.id for r in name_lossless(df).collect()) == [1, 3]


def test_null_profile_odd_names(spark):
    df = spark.createDataFrame([(None, 1)], "`a.b` bigint, `it's` bigint")
    got = {r.column: r.nulls for r in null_profile(df).collect()}
    assert got == {"a.b": 1, "it's": 0}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=st.lists(st.one_of(st.none(), st.integers(0, 4)), max_size=12),
       right=st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.floats(0, 9, allow_nan=False))),
                      max_size=10))
def test_counts_equal_the_literal_left_merge(spark, left, right):
    import pandas as pd

    from stratiform.operators.aggregates import fanout_left_join
    pl = pd.DataFrame({"id": pd.array(left, dtype="Int64")})
    pr = pd.DataFrame({"id": pd.array([r[0] for r in right], dtype="Int64"),
                       "diameter_min_km": [r[1] for r in right]})
    merged = pl.merge(pr, on="id", how="left")
    exp = merged[merged["diameter_min_km"].isna()].groupby("id", dropna=False).size()
    exp = {(None if pd.isna(k) else int(k)): int(v) for k, v in exp.items()}
    a = spark.createDataFrame([(x,) for x in left], "id bigint")
    m = spark.createDataFrame(right, "id bigint, diameter_min_km double")
    got = {r.id: r.orphan_rows for r in orphans_by_null(a, m).collect()}
    assert got == exp
    # the weight of the fan-out join equals the plain merge's rows per left row
    meta = m.selectExpr("id", "diameter_min_km as diameter_max_km", "true as bajo_seguimiento_riesgo")
    w = sum(max(r.metadata_rows, 1) for r in fanout_left_join(a, meta).collect())
    assert w == len(merged)
