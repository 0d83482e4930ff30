"""Sums and means that do not depend on the order of rows, the partitioning or the plan."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stratiform import queries as Q
from stratiform.functions.exact import exact_mean, exact_partials, exact_sum, merged_mean, merged_total
from stratiform.operators.aggregates import daily_summary


def _values(n=20_000, seed=1):
    rng = random.Random(seed)
    return [rng.choice([-1, 1]) * rng.random() * 10 ** rng.randint(-9, 14) for _ in range(n)] + [0.0, -0.0, None, float("nan")]


@pytest.mark.parametrize("partitions", [1, 8, 211])
def test_sum_is_the_true_sum_in_any_order(spark, partitions):
    values = _values()
    true = sum(Fraction(v) for v in values if v is not None and not math.isnan(v))
    random.Random(partitions).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(partitions)
    s, m = df.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()
    assert abs(Fraction(s) - true) <= abs(true) * Fraction(1, 2**50)
    again = spark.createDataFrame([(v,) for v in sorted(values, key=repr)], "v double").coalesce(1)
    assert again.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first() == (s, m)


def test_cancelling_values(spark):
    df = spark.createDataFrame([(1e17,), (1.25,), (-1e17,), (2**-40,)], "v double").repartition(4)
    assert df.agg(exact_sum(F.col("v"))).first()[0] == 1.25 + 2**-40


def test_states_merge_to_the_same_double(spark):
    df = spark.createDataFrame([(i % 7, v) for i, v in enumerate(_values())], "k int, v double")
    want = df.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()
    states = df.groupBy("k").agg(*exact_partials(F.col("v"), "v"))
    assert states.agg(merged_total("v"), merged_mean("v")).first() == want
    weighted = df.withColumn("n", F.col("k") + 1).select("v", F.explode(F.sequence(F.lit(1), "n")))
    assert (states.agg(merged_total("v", F.col("k") + 1), merged_mean("v", F.col("k") + 1)).first()
            == weighted.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first())


def test_no_values_large_values_and_infinity(spark):
    df = spark.createDataFrame([("none", None), ("nan", float("nan")), ("big", 1e300), ("big", 2.0), ("inf", math.inf), ("inf", 1.0),
                                ("edge", float(2**62)), ("edge", -float(2**62))], "k string, v double")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert got == {"none": None, "nan": None, "big": 1e300, "inf": math.inf, "edge": 0.0}


def test_three_summary_plans_give_the_same_doubles(spark):
    a = Q.silver_approaches(spark, SF_SMALL)
    a = a.withColumn("miss_distance_km", F.col("miss_distance_km") * F.expr("pow(3.0D, hora - 12)"))
    m = Q._fanout_metadata(spark, SF_SMALL)
    results = [sorted(map(tuple, daily_summary(a.repartition(n), m, strategy=s).collect()))
               for s in ("broadcast", "preaggregate", "join_first") for n in (1, 8, 211)]
    assert all(r == results[0] for r in results) and results[0]
