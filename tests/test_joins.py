from pyspark.sql import functions as F

from stratiform.operators.joins import measured_bytes, sized_join, skew_safe_join


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_measured_bytes_counts_fixed_and_string_payload(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None), (3, "cdef")], "id bigint, s string")
    assert measured_bytes(df) == 3 * (16 + 8 + 8) + 6


def test_sized_join_broadcasts_only_under_the_bound(spark):
    big = spark.range(1000).withColumn("k", F.col("id") % 10)
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in _plan(sized_join(big, small, "k", "left"))
    plan = _plan(sized_join(big, small, "k", "left", max_bytes=10))
    assert "BroadcastExchange" not in plan.split("Initial Plan")[0] or "SortMergeJoin" in plan
    assert sized_join(big, small, "k", "left", max_bytes=10).count() == 1000


def test_skew_safe_join_equals_plain_join(spark):
    from stratiform.operators.joins import skew_safe_join
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
                                    F.col("id").alias("v"))
    right = spark.createDataFrame([(7, "hot"), (7, "hot2"), (1, "one"), (99, "none")], "rk bigint, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(tuple(r) for r in left.join(right, left["k"] == right["rk"], how).collect())
        salted_df = skew_safe_join(left, right, ["k"], ["rk"], how, hot_key_rows=100, salts=8)
        assert sorted(tuple(r) for r in salted_df.collect()) == plain, how
        assert "__salt_l" not in salted_df.columns


def test_skew_safe_join_with_map_and_dotted_columns(spark):
    from stratiform.operators.joins import skew_safe_join
    left = spark.range(500).select((F.col("id") % 2).alias("k"), F.create_map(F.lit("a"), F.col("id")).alias("m"),
                                   F.col("id").alias("a.b"))
    right = spark.createDataFrame([(0, "zero")], "rk bigint, name string")
    got = skew_safe_join(left, right, ["k"], ["rk"], "inner", hot_key_rows=10, salts=4)
    assert got.count() == 250


def test_salt_comes_from_a_stored_place(spark):
    """The left side arrives in no fixed order (a shuffle): it is stored before rows are dealt, so that a task
    that runs again deals them alike; equal rows of a hot key are spread as well."""
    left = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "'same' AS v").repartition(7)
    right = spark.range(-1, 2000, 2).selectExpr("id AS r", "id * 2 AS w")
    joined = skew_safe_join(left, right, ["k"], ["r"], "left", hot_key_rows=100, salts=4)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("monotonically_increasing_id"):].splitlines()
    assert "Relation [" in below[1] and "Repartition" not in plan
    plain = left.join(right, left["k"] == right["r"], "left")
    assert sorted(map(tuple, joined.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_a_small_left_side_is_only_counted(spark, monkeypatch):
    from stratiform.operators import joins
    monkeypatch.setattr(joins, "_stored", lambda *a: 1 / 0)  # no hot-key list, nothing written
    left, right = spark.range(50).toDF("k"), spark.range(10).toDF("r")
    assert skew_safe_join(left, right, ["k"], ["r"], "left_anti").count() == 40
    assert skew_safe_join(left, right, ["k"], ["r"], "inner", left_rows=50).count() == 10
